
from pyspark.sql import functions as F

from clickvault.operators import engagement as EN
from clickvault.operators import figures as FG
from clickvault.operators import funnel as FU
from clickvault.operators import quality as Q
from clickvault.operators.workload import build_workload
from clickvault.sources.tables import raw_events
from conftest import SF001


def _silver_block(spark, block):
    """Silver of workload block ``block`` alone (ids, sessions and times shifted)."""
    raw = raw_events(spark, SF001)
    n = raw.count()
    wl = build_workload(raw, (block + 1) * n, n=n)
    mine = wl.filter(F.col("source_row_number") >= block * n + 2)
    return Q.silver(Q.tag(mine))


def test_whole_day_shift_keeps_hourly_frame_and_funnel(spark):
    s0, s2 = _silver_block(spark, 0), _silver_block(spark, 2)
    h0 = {tuple(r) for r in FG.fig13_hourly(s0).collect()}
    h2 = {tuple(r) for r in FG.fig13_hourly(s2).collect()}
    assert h0 == h2
    f0 = [(r.sessions, r.conversion_from_previous_stage_pct) for r in FU.conversion_funnel(s0).orderBy("stage_order").collect()]
    f2 = [(r.sessions, r.conversion_from_previous_stage_pct) for r in FU.conversion_funnel(s2).orderBy("stage_order").collect()]
    assert f0 == f2
    d0 = sorted(r.event_date.toordinal() for r in s0.select("event_date").distinct().collect())
    d2 = sorted(r.event_date.toordinal() for r in s2.select("event_date").distinct().collect())
    assert [d + 2 for d in d0] == d2


def test_levels_cover_all_users(spark):
    s = Q.silver(Q.tag(raw_events(spark, SF001)))
    eng = EN.customer_engagement(s)
    assert eng.filter(F.col("engagement_level").isNull()).count() == 0
    assert eng.count() == s.select("user_id").distinct().count()
    levels = {r.engagement_level: r.customers for r in FG.fig09_level_distribution(eng).collect()}
    assert sum(levels.values()) == eng.count() and set(levels) == {"Low", "Medium", "High"}
