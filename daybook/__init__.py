"""daybook: game-operations KPIs (new, active, paying, returning users, sales,
cumulative users, cohort retention) as Spark DataFrame jobs.

    from daybook import KpiConfig, read_sources, TableStore, daily, weekly, runner
"""

from daybook.config import FIXTURE_CONFIG, KpiConfig
from daybook.plans import daily, runner, weekly
from daybook.sources.sinks import TableStore, backup_csv
from daybook.sources.tables import Sources, read_sources, write_sources

__all__ = [
    "FIXTURE_CONFIG",
    "KpiConfig",
    "Sources",
    "TableStore",
    "backup_csv",
    "daily",
    "read_sources",
    "runner",
    "weekly",
    "write_sources",
]
