"""Expected numbers of FIXTURES.md §C at sf0.001 (and key ones at sf0.01)."""

import pytest
from pyspark.sql import functions as F

from clickvault.operators import abandonment as AB
from clickvault.operators import category as CA
from clickvault.operators import engagement as EN
from clickvault.operators import funnel as FU
from clickvault.operators import quality as Q
from clickvault.sources.tables import raw_events
from conftest import SF001, SF01


@pytest.fixture(scope="module")
def silver001(spark):
    return Q.silver(Q.tag(raw_events(spark, SF001))).cache()


def report(spark, sf, dedupe="raw"):
    return {r["metric"]: r["value"] for r in Q.quality_report(Q.tag(raw_events(spark, sf), dedupe)).collect()}


def test_quality_report_sf0001(spark):
    r = report(spark, SF001)
    assert r == {
        "raw_rows": 1010, "duplicate_rows_removed": 5, "unsupported_event_type_rows_removed": 198,
        "invalid_event_time_rows_removed": 12, "missing_required_identifier_rows_removed": 19,
        "invalid_price_rows_removed": 11, "nonpositive_price_rows_removed": 10,
        "clean_rows": 755, "removed_rows": 255,
    }


def test_quality_report_sf001(spark):
    r = report(spark, SF01)
    assert (r["raw_rows"], r["duplicate_rows_removed"], r["clean_rows"]) == (10093, 48, 7505)
    assert report(spark, SF01, "normalised")["clean_rows"] == 7474


def test_normalised_dedupe_sf0001(spark):
    assert report(spark, SF001, "normalised")["clean_rows"] == 752


def test_silver_counts(silver001):
    row = silver001.agg(F.countDistinct("user_id").alias("u"), F.countDistinct("user_session").alias("s"),
                        F.count_if(F.col("event_type") == "view").alias("v"),
                        F.count_if(F.col("event_type") == "cart").alias("c"),
                        F.count_if(F.col("event_type") == "purchase").alias("p"),
                        F.count_if(F.col("event_type") == "remove_from_cart").alias("r"),
                        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("price"))), 2).alias("rev"),
                        ).first()
    assert (row.u, row.s, row.v, row.c, row.p, row.r) == (15, 361, 179, 194, 193, 189)
    assert row.rev == pytest.approx(10043.51)


def test_funnels(silver001):
    ft = [r.sessions for r in FU.conversion_funnel(silver001).orderBy("stage_order").collect()]
    aa = [r.sessions for r in FU.conversion_funnel(silver001, "any_after").orderBy("stage_order").collect()]
    assert ft == [147, 24, 4]
    assert aa == [147, 27, 5]
    rows = FU.conversion_funnel(silver001).orderBy("stage_order").collect()
    assert round(rows[1].conversion_from_previous_stage_pct, 4) == 16.3265
    assert round(rows[2].conversion_from_previous_stage_pct, 4) == 16.6667
    assert round(rows[2].percent_of_view_sessions, 4) == 2.7211
    assert rows[0].conversion_from_previous_stage_pct == 100.0


def test_abandonment(silver001):
    t = AB.cart_abandonment(silver001).agg(F.sum("cart_sessions"), F.sum("abandoned_sessions")).first()
    assert tuple(t) == (187, 174)


def test_thresholds_and_levels(silver001):
    users = EN.user_activity(silver001)
    thr = EN.engagement_thresholds(users).first()
    assert thr.q33 == pytest.approx(100.62) and thr.q67 == pytest.approx(126.28)
    approx = EN.engagement_thresholds(users, "approx").first()
    assert (approx.q33, approx.q67) == (100.0, 130.0)
    levels = {r.engagement_level: r["count"] for r in
              EN.customer_engagement(silver001).groupBy("engagement_level").count().collect()}
    assert levels == {"Low": 5, "Medium": 5, "High": 5}


def test_category_table_sf001(spark):
    s = Q.silver(Q.tag(raw_events(spark, SF01)))
    got = {r.category_code: (r.views, r.cart_additions, r.purchases, round(r.purchase_revenue, 2))
           for r in CA.category_performance(s).collect()}
    assert got["ECONOMY"] == (206, 258, 210, 11150.96)
    assert got["unknown"] == (215, 204, 179, 7912.95)
    ab = {r.category_code: (r.cart_sessions, r.abandoned_sessions, r.remove_from_cart_events)
          for r in AB.cart_abandonment(s).collect()}
    assert ab["PROMO"] == (326, 301, 318)
