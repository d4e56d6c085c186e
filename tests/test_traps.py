
import pytest
from pyspark.sql import functions as F

from clickvault.functions.columns import format_g
from clickvault.operators import abandonment as AB
from clickvault.operators import category as CA
from clickvault.operators import engagement as EN
from clickvault.operators import funnel as FU
from clickvault.operators import quality as Q
from conftest import ev, make_raw


def reasons(spark, rows, **kw):
    t = Q.tag(make_raw(spark, rows), **kw)
    return [r.rejection_reason for r in t.orderBy("source_row_number").collect()]


def test_t1_raw_vs_normalised_duplicates(spark):
    rows = [ev(typ="view"), ev(typ="View"), ev(typ="view")]
    assert reasons(spark, rows) == [None, None, "duplicate_record"]
    assert reasons(spark, rows, dedupe="normalised") == [None, "duplicate_record", "duplicate_record"]


def test_duplicate_keeps_first_in_row_order_and_nulls_equal(spark):
    rows = [ev(brand=None, sess="a"), ev(brand=None, sess="a"), ev(brand="x", sess="a")]
    assert reasons(spark, rows) == [None, "duplicate_record", None]


def test_hot_duplicate_group(spark):
    """One key holding most rows: every copy after the first is a duplicate."""
    rows = [ev()] * 500 + [ev(sess=f"x{i}") for i in range(20)]
    got = reasons(spark, rows)
    assert got[0] is None and got.count("duplicate_record") == 499 and got[500:] == [None] * 20


def test_t3_nan_and_text_price(spark):
    rows = [ev(price="NaN"), ev(price="n/k", sess="b"), ev(price="-3.00", sess="c"), ev(price="0", sess="d"),
            ev(price=" 3.5 ", sess="e"), ev(price="inf", sess="f")]
    assert reasons(spark, rows) == ["invalid_price", "invalid_price", "nonpositive_price",
                                    "nonpositive_price", None, None]


def test_t4_tab_is_stripped(spark):
    assert reasons(spark, [ev(typ="view\t"), ev(typ="  CART ", sess="b"), ev(typ="click", sess="c")]) == \
        [None, None, "unsupported_event_type"]


def test_null_event_type_is_unsupported(spark):
    assert reasons(spark, [ev(typ=None)]) == ["unsupported_event_type"]


def test_t17_non_numeric_id(spark):
    assert reasons(spark, [ev(pid="abc"), ev(uid=None, sess="b"), ev(sess=None)]) == \
        ["missing_required_identifier"] * 3


def test_first_reason_wins(spark):
    # bad time, bad type, no session and bad price: the time reason wins
    assert reasons(spark, [ev(t="nope", typ="click", sess=None, price="x")]) == ["invalid_event_time"]
    # duplicate of a bad row is reported as duplicate
    assert reasons(spark, [ev(typ="click"), ev(typ="click")]) == ["unsupported_event_type", "duplicate_record"]


def test_t24_time_formats(spark):
    rows = [ev(t="2019-10-01"), ev(t="2019", sess="b"), ev(t="2019-10-01T01:02:03Z", sess="c"),
            ev(t="2019-10-01 01:02:03 UTC", sess="d")]
    assert reasons(spark, rows) == ["invalid_event_time"] * 3 + [None]
    loose = reasons(spark, rows, time_format=None)
    assert loose[0] is None and loose[2] is None


def test_all_rows_rejected(spark):
    raw = make_raw(spark, [ev(typ="click"), ev(price="-1", sess="b")])
    t = Q.tag(raw)
    r = {x.metric: x.value for x in Q.quality_report(t).collect()}
    assert r["clean_rows"] == 0 and r["removed_rows"] == 2
    s = Q.silver(t)
    assert s.count() == 0
    thr = EN.engagement_thresholds(EN.user_activity(s)).first()
    assert (thr.users, thr.q33, thr.q67) == (0, 0.0, 0.0)
    f = FU.conversion_funnel(s).orderBy("stage_order").collect()
    assert [x.sessions for x in f] == [0, 0, 0]
    assert f[0].conversion_from_previous_stage_pct == 100.0 and f[0].percent_of_view_sessions == 0.0


@pytest.mark.parametrize("n_users,expected", [(1, 10.0), (2, 12.0)])
def test_t7_small_population(spark, n_users, expected):
    rows = [ev(uid=str(u), sess=f"s{u}", t=f"2019-10-01 10:00:{i:02d} UTC")
            for u in range(n_users) for i in range(10 + 4 * u)]
    s = Q.silver(Q.tag(make_raw(spark, rows)))
    thr = EN.engagement_thresholds(EN.user_activity(s)).first()
    assert thr.q33 == thr.q67 == expected
    levels = {r.engagement_level for r in EN.customer_engagement(s).collect()}
    assert levels == {"Medium"}


def test_t8_funnel_modes(spark):
    t = lambda s: f"2019-10-01 10:00:{s:02d} UTC"
    rows = [
        # cart -> view -> cart: first-touch no, any-after yes
        ev(t=t(1), typ="cart", sess="a"), ev(t=t(2), typ="view", sess="a"), ev(t=t(3), typ="cart", sess="a"),
        ev(t=t(4), typ="purchase", sess="a"),
        # equal times count
        ev(t=t(5), typ="view", sess="b"), ev(t=t(5), typ="cart", sess="b"), ev(t=t(5), typ="purchase", sess="b"),
        # purchase before cart
        ev(t=t(1), typ="view", sess="c"), ev(t=t(2), typ="purchase", sess="c"), ev(t=t(3), typ="cart", sess="c"),
        # purchase only / no view
        ev(t=t(1), typ="purchase", sess="d"), ev(t=t(1), typ="cart", sess="e"),
    ]
    s = Q.silver(Q.tag(make_raw(spark, rows)))
    ft = [r.sessions for r in FU.conversion_funnel(s).orderBy("stage_order").collect()]
    aa = [r.sessions for r in FU.conversion_funnel(s, "any_after").orderBy("stage_order").collect()]
    assert ft == [3, 2, 1]  # a: first cart before view; b: all equal; c: cart, no later purchase
    assert aa == [3, 3, 2]  # a reaches cart and purchase


def test_t10_t11_abandonment_and_zero_rates(spark):
    rows = [ev(typ="purchase", sess="a", cat="x", t="2019-10-01 09:00:00 UTC"), ev(typ="cart", sess="a", cat="x"),
            ev(typ="cart", sess="b", cat="x"), ev(typ="remove_from_cart", sess="b", cat="x"),
            ev(typ="purchase", sess="c", cat="y")]
    s = Q.silver(Q.tag(make_raw(spark, rows)))
    ab = {r.category_code: r for r in AB.cart_abandonment(s).collect()}
    assert (ab["x"].cart_sessions, ab["x"].abandoned_sessions, ab["x"].remove_from_cart_events) == (2, 1, 1)
    assert ab["y"].cart_sessions == 0 and ab["y"].abandonment_rate_pct == 0.0
    cp = {r.category_code: r for r in CA.category_performance(s).collect()}
    assert cp["y"].views == 0 and cp["y"].view_to_cart_rate_pct == 0.0


def test_fill_unknown_and_time_parts(spark):
    s = Q.silver(Q.tag(make_raw(spark, [ev(brand=None, cat=None, t="2019-10-06 23:30:00 UTC")]))).first()
    assert (s.brand, s.category_code, s.event_hour, s.event_day, s.event_month) == \
        ("unknown", "unknown", 23, "Sunday", "2019-10")
    assert str(s.event_date) == "2019-10-06"


@pytest.mark.parametrize("x,text", [(102.17, "102.17"), (15.0, "15"), (100.0, "100"), (126.28000000000002, "126.28"),
                                    (1e6, "1e+06"), (0.0001, "0.0001"), (0.0, "0"), (1234567.0, "1.23457e+06")])
def test_t20_format_g(spark, x, text):
    assert spark.range(1).select(format_g(F.lit(x)).alias("s")).first().s == text == format(x, "g")


def test_normalised_dedupe_negative_zero_price(spark):
    """-0.0 and 0.0 are equal prices: the copy is a duplicate under the normalised rule."""
    rows = [ev(price="0.0"), ev(price="-0.0"), ev(price="-0")]
    assert reasons(spark, rows, dedupe="normalised") == ["nonpositive_price", "duplicate_record",
                                                         "duplicate_record"]
    assert reasons(spark, rows) == ["nonpositive_price"] * 3
