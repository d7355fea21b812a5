"""Independent DuckDB SQL for every registered metric (the correctness check).

Each statement is written from the definition of its metric over five CTEs
(members, profiles and three logs, derived from the raw views as in
``daybook.sources.fixtures``): distinct counts per report day, a range frame
for gaps, self-sums for running totals, a long form of offsets for cohorts. It
shares no query shape with the Spark plans. Report bounds are computed in SQL
from the bookmarks, the overlap and the report time, not taken from the
library's window code.

In the check form dates are ISO strings and every numeric column is DOUBLE
(money after an exact DECIMAL sum; counts are exact below 2**53) on both
sides, so values and NULLs convert alike from either engine.
"""

from __future__ import annotations

from datetime import date

from daybook.config import KpiConfig
from daybook.sources import fixtures as fx

RETENTION_DAYS = 30


def _d(v: date) -> str:
    return f"DATE '{v.isoformat()}'"


def _os0_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in fx.OS_BY_MKTSEGMENT.items())
    return f"CASE c_mktsegment {whens} ELSE {fx.OS_OTHER} END"


def fixture_ctes(tz: int) -> str:
    """CTEs member, profile, login, billing, tutorial_end over events + customer."""
    log_os = f"CAST(CASE WHEN event_id % 7 = 0 THEN {fx.LOG_OS_OVERRIDE} ELSE os0 END AS INTEGER)"
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    return f"""
cust AS (
  SELECT c_custkey AS member_id, c_name,
         CAST({_os0_case()} AS INTEGER) AS os0,
         lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS cc0
    FROM customer
),
ev AS (
  SELECT e.event_id, e.ts, e.user_id AS member_id, e.event_type, e.value, e.props, c.c_name, c.os0, c.cc0
    FROM events e JOIN cust c ON c.member_id = e.user_id
),
member AS (
  SELECT member_id,
         min(ts) - INTERVAL ({int(tz)}) HOUR AS reg_utc,
         CASE WHEN member_id % {fx.NAMELESS_MOD} = 0 THEN '' ELSE min(c_name) END AS member_name
    FROM ev WHERE event_type = 'signup' GROUP BY member_id
),
profile AS (
  SELECT member_id,
         CAST(CASE WHEN member_id % {fx.NULL_OS_MOD} = 0 THEN NULL ELSE os0 END AS INTEGER) AS os_type,
         cc0 AS country_code
    FROM cust WHERE member_id % {fx.NO_PROFILE_MOD} <> {fx.NO_PROFILE_REM}
),
login AS (
  SELECT member_id, ts AS login_ts, {log_os} AS os_type, cc0 AS country_code,
         row_number() OVER (PARTITION BY member_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS login_day_seq
    FROM ev WHERE event_type = 'click'
),
billing AS (
  SELECT member_id, ts AS log_ts, {log_os} AS os_type, cc0 AS country_code,
         {k} % {fx.MARKETS} AS market, {k} AS product_id,
         CAST(value AS DECIMAL(18,2)) AS amount
    FROM ev WHERE event_type = 'purchase'
),
tutorial_end AS (
  SELECT member_id, ts AS log_ts, {log_os} AS os_type, cc0 AS country_code
    FROM ev WHERE event_type = 'view'
)"""


def fixture_ctes_orders(tz: int) -> str:
    """The same five CTEs over orders + customer (second fixture)."""
    log_os = f"CAST(CASE WHEN order_id % 7 = 0 THEN {fx.LOG_OS_OVERRIDE} ELSE os0 END AS INTEGER)"
    product = "CAST(substring(o_orderpriority, 1, 1) AS INTEGER)"
    return f"""
cust AS (
  SELECT c_custkey AS member_id, c_name,
         CAST({_os0_case()} AS INTEGER) AS os0,
         lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS cc0
    FROM customer
),
ev AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS member_id, o.o_orderdate AS ts, o.o_orderstatus,
         o.o_orderpriority, o.o_totalprice, c.c_name, c.os0, c.cc0
    FROM orders o JOIN cust c ON c.member_id = o.o_custkey
),
member AS (
  SELECT member_id,
         min(ts) - INTERVAL ({int(tz)}) HOUR AS reg_utc,
         CASE WHEN member_id % {fx.NAMELESS_MOD} = 0 THEN '' ELSE min(c_name) END AS member_name
    FROM ev GROUP BY member_id
),
profile AS (
  SELECT member_id,
         CAST(CASE WHEN member_id % {fx.NULL_OS_MOD} = 0 THEN NULL ELSE os0 END AS INTEGER) AS os_type,
         cc0 AS country_code
    FROM cust WHERE member_id % {fx.NO_PROFILE_MOD} <> {fx.NO_PROFILE_REM}
),
login AS (
  SELECT member_id, ts AS login_ts, {log_os} AS os_type, cc0 AS country_code,
         row_number() OVER (PARTITION BY member_id, CAST(ts AS DATE) ORDER BY ts, order_id) AS login_day_seq
    FROM ev
),
billing AS (
  SELECT member_id, ts AS log_ts, {log_os} AS os_type, cc0 AS country_code,
         {product} % {fx.MARKETS} AS market, {product} AS product_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM ev WHERE o_orderstatus = '{fx.PURCHASE_STATUS}'
),
tutorial_end AS (
  SELECT member_id, ts AS log_ts, {log_os} AS os_type, cc0 AS country_code
    FROM ev WHERE o_orderpriority = '{fx.TUTORIAL_PRIORITY}'
)"""


FIXTURE_CTES = {"events": fixture_ctes, "orders": fixture_ctes_orders}


def _wk(d: str) -> str:
    """Sunday week start of a DATE expression (DuckDB dayofweek: 0 = Sunday)."""
    return f"CAST(({d}) - CAST(dayofweek({d}) AS INTEGER) AS DATE)"


def _reg(alias: str, tz: int) -> str:
    return f"CAST({alias}.reg_utc + INTERVAL ({int(tz)}) HOUR AS DATE)"


def _after(cfg: KpiConfig, back: int = 0) -> str:
    """The day before the first report day: bookmark less the overlap (and ``back`` days)."""
    return f"CAST({_d(cfg.start)} - {cfg.before_days + back} AS DATE)"


def _until(cfg: KpiConfig) -> str:
    """The unfinished local day of the report time."""
    return f"CAST(TIMESTAMP '{cfg.as_of.isoformat(sep=' ')}' AS DATE)"


def _in_days(day: str, cfg: KpiConfig, back: int = 0) -> str:
    return f"{day} > {_after(cfg, back)} AND {day} < {_until(cfg)}"


def _in_weeks(day: str, cfg: KpiConfig) -> str:
    return f"{_wk(day)} > {_wk(_d(cfg.week_start))} AND {_wk(day)} < {_wk(_until(cfg))}"


def _present(sql: str, dates=(), numeric=()) -> str:
    repl = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates] + [f"CAST({c} AS DOUBLE) AS {c}" for c in numeric]
    if not repl:
        return f"SELECT * FROM ({sql}) q"
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) q"


def _with(cfg: KpiConfig, *extra: str, fixture: str = "events") -> str:
    parts = [FIXTURE_CTES[fixture](cfg.tz_offset_hours)] + [e for e in extra if e]
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- daily
def _new_members(cfg: KpiConfig, period: str, name: str, join: str, bound: str) -> str:
    return f"""
SELECT '{cfg.game_code}' AS game_code, {period} AS {name}, CAST(coalesce(p.os_type, 0) AS INTEGER) AS os_type,
       coalesce(p.country_code, '00') AS country_code,
       count(*) FILTER (m.member_name <> '') AS nru1, count(*) FILTER (m.member_name = '') AS nru2
FROM member m {join} JOIN profile p USING (member_id)
WHERE {bound}
GROUP BY ALL"""


def nru_day_body(cfg: KpiConfig) -> str:
    day = _reg("m", cfg.tz_offset_hours)
    return _new_members(cfg, day, "division_date", "", _in_days(day, cfg))


def nru_backup_rows_body(cfg: KpiConfig) -> str:
    day = _reg("m", cfg.tz_offset_hours)
    return f"""
SELECT {day} AS division_date, member_id, CAST(coalesce(p.os_type, 0) AS INTEGER) AS os_type,
       coalesce(p.country_code, '00') AS country_code, m.member_name
FROM member m JOIN profile p USING (member_id)
WHERE {_in_days(day, cfg)}"""


def _month_to_date(cfg: KpiConfig, log: str, ts: str, only: str, os_type: str, country: str, daily: str, monthly: str) -> str:
    """Distinct members of a report day, and of its month up to it, per segment that is known."""
    return f"""
SELECT '{cfg.game_code}' AS game_code, r.day AS division_date, a.os_type, a.country_code,
       count(DISTINCT a.member_id) FILTER (a.day = r.day) AS {daily}, count(DISTINCT a.member_id) AS {monthly}
FROM (SELECT DISTINCT CAST({ts} AS DATE) AS day FROM {log} WHERE {only} AND {_in_days(f"CAST({ts} AS DATE)", cfg)}) r
JOIN (SELECT l.member_id, CAST(l.{ts} AS DATE) AS day, {os_type} AS os_type, {country} AS country_code
      FROM {log} l JOIN profile p USING (member_id) WHERE {only}) a
  ON a.day >= date_trunc('month', r.day) AND a.day <= r.day
WHERE a.os_type IS NOT NULL AND a.country_code IS NOT NULL
GROUP BY ALL"""


def dau_day_body(cfg: KpiConfig) -> str:
    os_type, country = "coalesce(p.os_type, l.os_type)", "coalesce(p.country_code, l.country_code)"
    return _month_to_date(cfg, "login", "login_ts", "login_day_seq = 1", os_type, country, "dau", "sum_month_dau")


def pu_day_body(cfg: KpiConfig) -> str:
    return _month_to_date(cfg, "billing", "log_ts", "true", "p.os_type", "p.country_code", "pu", "sum_month_pu")


def eru_day_body(cfg: KpiConfig) -> str:
    day = _reg("m", cfg.tz_offset_hours)
    return f"""
SELECT '{cfg.game_code}' AS game_code, {day} AS division_date, p.os_type, p.country_code, count(*) AS eru
FROM member m JOIN profile p USING (member_id)
WHERE {_in_days(day, cfg)}
  AND (m.member_id, {day}) IN (SELECT (t.member_id, CAST(t.log_ts AS DATE)) FROM tutorial_end t)
GROUP BY ALL"""


def rau_day_body(cfg: KpiConfig) -> str:
    return f"""
SELECT '{cfg.game_code}' AS game_code, g.day AS division_date, CAST(coalesce(p.os_type, 0) AS INTEGER) AS os_type,
       coalesce(p.country_code, '00') AS country_code, count(*) AS rau
FROM (SELECT member_id, day, count(*) OVER (PARTITION BY member_id ORDER BY day
             RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS seen
      FROM (SELECT DISTINCT member_id, CAST(login_ts AS DATE) AS day FROM login
            WHERE login_day_seq = 1 AND CAST(login_ts AS DATE) > {_after(cfg, 7 if cfg.rau_lookback_days is None else cfg.rau_lookback_days)})) g
JOIN member m ON m.member_id = g.member_id AND g.day - {_reg("m", cfg.tz_offset_hours)} > 7
LEFT JOIN profile p ON p.member_id = g.member_id
WHERE g.seen = 0 AND {_in_days("g.day", cfg)}
GROUP BY ALL"""


def _sales_body(cfg: KpiConfig, period: str, name: str, bound: str, users: str) -> str:
    return f"""
SELECT '{cfg.game_code}' AS game_code, {period} AS {name}, os_type, country_code, market, product_id AS product_idx,
       {users} AS user_count, count(*) AS sales_count, CAST(sum(amount) AS DECIMAL(38,2)) AS real_cash_kr
FROM billing
WHERE {bound}
GROUP BY ALL"""


def sales_day_body(cfg: KpiConfig) -> str:
    day = "CAST(log_ts AS DATE)"
    return _sales_body(cfg, day, "division_date", _in_days(day, cfg), "count(DISTINCT member_id)")


def ru_day_body(cfg: KpiConfig, seed_sql: str | None = None) -> str:
    """Sign-ups per day and known segment, and their self-sum over all earlier sign-up days."""
    day = _reg("m", cfg.tz_offset_hours)
    seed = f"UNION ALL SELECT division_date, os_type, country_code, sum_date_count FROM ({seed_sql}) old WHERE division_date = {_after(cfg)}"
    days = f"SELECT DISTINCT {day} AS day FROM member m WHERE {day} >= {_after(cfg)} AND {day} < {_until(cfg)}"
    gains = f"""SELECT {day} AS day, p.os_type, p.country_code, count(*) AS n
      FROM member m JOIN profile p USING (member_id) WHERE {_in_days(day, cfg)} GROUP BY ALL {seed if seed_sql else ""}"""
    return f"""
SELECT '{cfg.game_code}' AS game_code, d.day AS division_date, s.os_type, s.country_code,
       CAST(coalesce(sum(g.n) FILTER (g.day = d.day), 0) AS BIGINT) AS date_count, CAST(coalesce(sum(g.n), 0) AS BIGINT) AS sum_date_count
FROM ({days}) d
JOIN (SELECT DISTINCT os_type, country_code FROM profile) s ON true
LEFT JOIN (SELECT * FROM ({gains}) WHERE day IN (SELECT day FROM ({days}))) g
  ON g.os_type = s.os_type AND g.country_code = s.country_code AND g.day <= d.day
GROUP BY ALL"""


def retention_day_body(cfg: KpiConfig) -> str:
    """Cohorts by sign-up day and segment; what their members did, in long form (kind, days since sign-up, amount)."""
    bound, known = _in_days("c.day", cfg, cfg.retention_lookback_days), "c.os_type IS NOT NULL AND c.country_code IS NOT NULL"
    value = lambda kind, k, t: f"CASE WHEN {known} THEN CAST(coalesce(sum(f.v) FILTER (f.kind = '{kind}' AND f.k = {k}), 0) AS {t}) END AS {kind}_{k}"
    cols = [value("user", k, "BIGINT") for k in range(1, RETENTION_DAYS + 1)] + [value("sales", k, "DECIMAL(38,2)") for k in range(RETENTION_DAYS + 1)]
    return f"""
SELECT '{cfg.game_code}' AS game_code, c.day AS division_date, c.os_type, c.country_code,
       count(DISTINCT c.member_id) AS user_count, {", ".join(cols)}
FROM (SELECT m.member_id, {_reg("m", cfg.tz_offset_hours)} AS day, p.os_type, p.country_code FROM member m JOIN profile p USING (member_id)) c
LEFT JOIN (
  SELECT 'user' AS kind, o.member_id, o.day - {_reg("m", cfg.tz_offset_hours)} AS k, CAST(1 AS DECIMAL(38,2)) AS v
  FROM (SELECT DISTINCT member_id, CAST(login_ts AS DATE) AS day FROM login) o JOIN member m USING (member_id)
  WHERE o.day < {_until(cfg)}
  UNION ALL
  SELECT 'sales', b.member_id, CAST(b.log_ts AS DATE) - {_reg("m", cfg.tz_offset_hours)}, b.amount
  FROM billing b JOIN member m USING (member_id) WHERE CAST(b.log_ts AS DATE) < {_until(cfg)}
) f ON f.member_id = c.member_id
WHERE {bound}
GROUP BY c.day, c.os_type, c.country_code"""


# ---------------------------------------------------------------- weekly
def nru_week_body(cfg: KpiConfig) -> str:
    day = _reg("m", cfg.tz_offset_hours)
    return _new_members(cfg, _wk(day), "division_week", "LEFT", _in_weeks(day, cfg))


def wau_week_body(cfg: KpiConfig) -> str:
    day = "CAST(login_ts AS DATE)"
    return f"""
SELECT '{cfg.game_code}' AS game_code, {_wk(day)} AS division_week, os_type, country_code, count(DISTINCT member_id) AS wau
FROM login WHERE {_in_weeks(day, cfg)} GROUP BY ALL"""


def pu_week_body(cfg: KpiConfig) -> str:
    """Payers of a week, each in the smallest of the segments logged for it, unknown ones first."""
    day, order = "CAST(log_ts AS DATE)", "ORDER BY os_type NULLS FIRST, country_code NULLS FIRST"
    return f"""
SELECT '{cfg.game_code}' AS game_code, week AS division_week, os AS os_type, cc AS country_code, count(*) AS pu
FROM (SELECT member_id, {_wk(day)} AS week, first(os_type {order}) AS os, first(country_code {order}) AS cc
      FROM billing WHERE {_in_weeks(day, cfg)} GROUP BY ALL)
GROUP BY ALL"""


def eru_week_body(cfg: KpiConfig) -> str:
    day = _reg("m", cfg.tz_offset_hours)
    return f"""
SELECT '{cfg.game_code}' AS game_code, {_wk(day)} AS division_week, t.os_type, t.country_code, count(*) AS eru
FROM member m, tutorial_end t
WHERE t.member_id = m.member_id AND CAST(t.log_ts AS DATE) = {day} AND {_in_weeks(day, cfg)}
GROUP BY ALL"""


def rau_week_body(cfg: KpiConfig, rau_day_sql: str) -> str:
    return f"""
SELECT game_code, {_wk("division_date")} AS division_week, os_type, country_code, CAST(sum(rau) AS BIGINT) AS rau
FROM ({rau_day_sql}) WHERE game_code = '{cfg.game_code}' AND {_in_weeks("division_date", cfg)} GROUP BY ALL"""


def sales_week_body(cfg: KpiConfig, per_member: bool = False) -> str:
    day = "CAST(log_ts AS DATE)"
    return _sales_body(cfg, _wk(day), "division_week", _in_weeks(day, cfg), "count(DISTINCT member_id)" if per_member else "CAST(1 AS BIGINT)")


# ---------------------------------------------------------------- statements
DAILY_DATES = ("division_date",)
WEEKLY_DATES = ("division_week",)
SALES_NUM = ("os_type", "market", "product_idx", "user_count", "sales_count", "real_cash_kr")
RETENTION_NUM = (
    ("os_type", "user_count")
    + tuple(f"user_{i}" for i in range(1, RETENTION_DAYS + 1))
    + tuple(f"sales_{i}" for i in range(RETENTION_DAYS + 1))
)
# Numeric output columns per metric; the check form renders them as DOUBLE
# (exact below 2**53) so NULLs and values look alike from either engine.
NUMERIC = {
    "nru_day": ("os_type", "nru1", "nru2"),
    "nru_week": ("os_type", "nru1", "nru2"),
    "nru_backup_rows": ("member_id", "os_type"),
    "dau_day": ("os_type", "dau", "sum_month_dau"),
    "pu_day": ("os_type", "pu", "sum_month_pu"),
    "eru_day": ("os_type", "eru"),
    "eru_week": ("os_type", "eru"),
    "rau_day": ("os_type", "rau"),
    "rau_week": ("os_type", "rau"),
    "sales_day": SALES_NUM,
    "sales_week": SALES_NUM,
    "sales_week_members": SALES_NUM,
    "ru_day": ("os_type", "date_count", "sum_date_count"),
    "retention_day": RETENTION_NUM,
    "wau_week": ("os_type", "wau"),
    "pu_week": ("os_type", "pu"),
}


def body(name: str, cfg: KpiConfig) -> str:
    """The bare metric query (natural types) for one metric name."""
    if name == "rau_week":
        return rau_week_body(cfg, rau_day_body(cfg))
    if name == "sales_week_members":
        return sales_week_body(cfg, True)
    if name == "sales_week":
        return sales_week_body(cfg, False)
    return globals()[f"{name}_body"](cfg)


def present(name: str, sql_with_ctes: str) -> str:
    dates = WEEKLY_DATES if name.endswith("_week") or name == "sales_week_members" else DAILY_DATES
    return _present(sql_with_ctes, dates, NUMERIC[name])


def statement(name: str, cfg: KpiConfig, fixture: str = "events") -> str:
    """Full DuckDB statement (check form) for one metric name."""
    return present(name, _with(cfg, fixture=fixture) + body(name, cfg))


def restricted(name: str, cfg: KpiConfig, date_col: str, after: date) -> str:
    """A full-run statement keeping rows with ``date_col`` after ``after``."""
    return f"SELECT * FROM ({statement(name, cfg)}) s WHERE {date_col} > '{after.isoformat()}'"


def bookmark_statement(jobs: list[tuple[str, str, str, str]], cfg_day: KpiConfig, cfg_week: KpiConfig) -> str:
    """(game_code, job, kind, value = max produced date) per (job, kind, metric, date column)."""
    parts = []
    for job, kind, metric, col in jobs:
        cfg = cfg_week if kind == "week" else cfg_day
        parts.append(
            f"SELECT '{cfg.game_code}' AS game_code, '{job}' AS job, '{kind}' AS kind, "
            f"max({col}) AS value FROM ({statement(metric, cfg)}) s"
        )
    return " UNION ALL ".join(parts)


def landed(name: str, cfg: KpiConfig, log: str, ts: str, until) -> str:
    """A metric over a log that ends before ``until``, of the days before the one of its newest row."""
    some = f"SELECT * FROM {log} WHERE {ts} < TIMESTAMP '{until.isoformat(sep=' ')}'"
    ctes = _with(cfg).rstrip()
    whole = f"{ctes}, landed AS ({some}) SELECT * FROM (WITH {log} AS (SELECT * FROM landed) {body(name, cfg)}) q WHERE division_date < (SELECT CAST(max({ts}) AS DATE) FROM landed)"
    return _present(whole, DAILY_DATES, NUMERIC[name])


def sales_replaced(cfg: KpiConfig, other_game: str, cutoff: date) -> str:
    """Rows of ``sales_day`` after two games' full runs and a run of the first game without market 0.

    The first game's rows: those of the last run, and of the first (each amount
    one more) those before the cutoff whose key the last run doesn't hold. Its
    members divisible by 3 have no logged platform.
    """
    other = cfg.replace(game_code=other_game)
    blank = "SELECT * REPLACE (CASE WHEN member_id % 3 <> 0 THEN os_type END AS os_type) FROM billing"
    old = f"WITH billing AS (SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(18,2)) AS amount) FROM unsegmented) {body('sales_day', cfg)}"
    new = f"WITH billing AS (SELECT * FROM unsegmented WHERE market <> 0) {body('sales_day', cfg)}"
    keys = ("division_date", "os_type", "country_code", "market", "product_idx")
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    sql = f"""{_with(cfg).rstrip()}, unsegmented AS ({blank}), old AS ({old}), fresh AS ({new}), other AS ({body('sales_day', other)})
SELECT * FROM fresh UNION ALL SELECT * FROM other
UNION ALL SELECT * FROM old o WHERE division_date < {_d(cutoff)} AND NOT EXISTS (SELECT 1 FROM fresh n WHERE {same})"""
    return _present(sql, DAILY_DATES, NUMERIC["sales_day"])
