"""Property tests: the custom operators against brute-force Python models on
random small inputs (hypothesis)."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators.activity import pick_first, returning_days
from daybook.operators.incremental import replace_range
from daybook.operators.month_to_date import month_to_date_distinct

BASE = date(2024, 1, 20)  # days span two month boundaries: 2024-01-20 .. 2024-03-19
DAYS = 60
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

activity = st.lists(
    st.tuples(st.integers(0, DAYS - 1), st.sampled_from([(1, "01"), (2, "01"), (1, "02")]), st.integers(1, 6)),
    min_size=1,
    max_size=40,
)


def _month(d: date) -> date:
    return d.replace(day=1)


@SETTINGS
@given(rows=activity, report_from=st.integers(0, DAYS - 1), report_len=st.integers(1, 30))
def test_month_to_date_matches_range_join_definition(spark, rows, report_from, report_len):
    acts = {(BASE + timedelta(days=o), seg, m) for o, seg, m in rows}
    report_hi = BASE + timedelta(days=min(DAYS, report_from + report_len))
    acts = {a for a in acts if a[0] < report_hi}
    spine = sorted({d for d, _, _ in acts if d >= BASE + timedelta(days=report_from)})
    if not acts:
        return
    df = spark.createDataFrame(
        [(d, s[0], s[1], m) for d, s, m in acts], "day date, os_type int, country_code string, member_id bigint"
    )
    days = spark.createDataFrame([(d,) for d in spine], "day date")
    got = {
        (r["division_date"], (r["os_type"], r["country_code"]), r["daily"], r["mtd"])
        for r in month_to_date_distinct(df, days, report_hi, "daily", "mtd").collect()
    }
    # brute force: for every report day and segment seen in the window, members active
    # that day and members active in the same month up to that day
    segs = {s for _, s, _ in acts}
    want = set()
    for d in spine:
        for s in segs:
            mtd = {m for (a, sg, m) in acts if sg == s and _month(a) == _month(d) and a <= d}
            if mtd:
                daily = {m for (a, sg, m) in acts if sg == s and a == d}
                want.add((d, s, len(daily), len(mtd)))
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 4), st.integers(0, DAYS - 1)), min_size=1, max_size=40), gap=st.integers(1, 10))
def test_returning_days_matches_not_exists(spark, rows, gap):
    df = spark.createDataFrame([(m, BASE + timedelta(days=o)) for m, o in rows], "member_id bigint, day date")
    got = {(r["member_id"], r["day"]) for r in returning_days(df, gap).collect()}
    days = {(m, BASE + timedelta(days=o)) for m, o in rows}
    want = {
        (m, d)
        for (m, d) in days
        if not any((m, d - timedelta(days=k)) in days for k in range(1, gap + 1))
    }
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 9), st.one_of(st.none(), st.integers(0, 2))), min_size=1, max_size=30))
def test_pick_first_is_smallest_segment_nulls_first(spark, rows):
    df = spark.createDataFrame(rows, "member_id bigint, week int, os_type int")
    got = {(r["member_id"], r["week"], r["os_type"]) for r in pick_first(df, ["member_id", "week"], ["os_type"]).collect()}
    groups = {}
    for m, w, o in rows:
        groups.setdefault((m, w), []).append(o)
    want = {(m, w, min(v, key=lambda x: (x is not None, x if x is not None else 0))) for (m, w), v in groups.items()}
    assert got == want


keyed = st.lists(
    st.tuples(st.sampled_from(["g", "h"]), st.integers(0, 9), st.one_of(st.none(), st.integers(1, 2)), st.integers(0, 99)),
    max_size=25,
)


@SETTINGS
@given(existing=keyed, new=keyed, cutoff=st.integers(0, 9))
def test_replace_range_matches_delete_then_replace(spark, existing, new, cutoff):
    def uniq(rows):  # one row per key, as in a keyed table
        out = {}
        for g, d, s, v in rows:
            out[(g, d, s)] = v
        return out

    old_t, new_t = uniq(existing), uniq([r for r in new if r[0] == "g" and r[1] >= 0])
    schema = "game_code string, division_date int, os_type int, value int"
    df_old = spark.createDataFrame([(g, d, s, v) for (g, d, s), v in old_t.items()], schema)
    df_new = spark.createDataFrame([(g, d, s, v) for (g, d, s), v in new_t.items()], schema)
    got = {
        (r["game_code"], r["division_date"], r["os_type"]): r["value"]
        for r in replace_range(df_old, df_new, "g", cutoff, ["game_code", "division_date", "os_type"], "division_date").collect()
    }
    # model: delete this game's rows at/after the cutoff, then REPLACE by key
    want = {k: v for k, v in old_t.items() if not (k[0] == "g" and k[1] >= cutoff)}
    want.update(new_t)
    assert got == want
    assert len(got) == replace_range(df_old, df_new, "g", cutoff, ["game_code", "division_date", "os_type"], "division_date").count()
