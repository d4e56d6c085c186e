"""Spark operators vs a brute-force Python model of the rules, on random rows."""

from datetime import datetime

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickvault.operators import abandonment as AB
from clickvault.operators import engagement as EN
from clickvault.operators import funnel as FU
from clickvault.operators import quality as Q
from conftest import make_raw

TIMES = ["2019-10-01 10:00:00 UTC", "2019-10-01 10:00:05 UTC", "2019-10-02 09:00:00 UTC", "bad", None]
TYPES = ["view", " View", "cart\t", "purchase", "remove_from_cart", "click", None]
PRICES = ["10.0", "0", "-3", "NaN", "n/k", None, " 7.5 ", "2.25"]
row_st = st.tuples(
    st.sampled_from(TIMES), st.sampled_from(TYPES), st.sampled_from(["1", "2", None, "x"]),
    st.just("100"), st.sampled_from(["a", "b", None]), st.sampled_from(["x", None]),
    st.sampled_from(PRICES), st.sampled_from(["7", "8", None]), st.sampled_from(["s1", "s2", "s3", None]),
)
BLANKS = " \t\n\r\x0b\x0c"


def _id(v):
    try:
        return int(v)
    except (TypeError, ValueError):
        return None


def _price(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def model(rows):
    """Reasons and clean rows, following the first-match rules."""
    seen, out = set(), []
    for r in rows:
        t = None
        if r[0] is not None:
            try:
                t = datetime.strptime(r[0], "%Y-%m-%d %H:%M:%S UTC")
            except ValueError:
                t = None
        et = r[1].strip(BLANKS).lower() if r[1] is not None else None
        p = _price(r[6])
        if r in seen:
            reason = "duplicate_record"
        elif t is None:
            reason = "invalid_event_time"
        elif et not in ("view", "cart", "remove_from_cart", "purchase"):
            reason = "unsupported_event_type"
        elif _id(r[2]) is None or _id(r[7]) is None or r[8] is None:
            reason = "missing_required_identifier"
        elif p is None or p != p:
            reason = "invalid_price"
        elif p <= 0:
            reason = "nonpositive_price"
        else:
            reason = None
        seen.add(r)
        out.append((reason, dict(t=t, et=et, p=p, user=_id(r[7]), sess=r[8], cat=r[4] or "unknown")))
    return out


def model_funnel(clean):
    sess = {}
    for e in clean:
        d = sess.setdefault(e["sess"], {"view": [], "cart": [], "purchase": []})
        if e["et"] in d:
            d[e["et"]].append(e["t"])
    ft = [0, 0, 0]
    aa = [0, 0, 0]
    for d in sess.values():
        if not d["view"]:
            continue
        fv = min(d["view"])
        ft[0] += 1
        aa[0] += 1
        if d["cart"] and min(d["cart"]) >= fv:
            ft[1] += 1
            if d["purchase"] and min(d["purchase"]) >= min(d["cart"]):
                ft[2] += 1
        later = [c for c in d["cart"] if c >= fv]
        if later:
            aa[1] += 1
            if any(p >= min(later) for p in d["purchase"]):
                aa[2] += 1
    return ft, aa


def model_abandonment(clean):
    pairs = {}
    for e in clean:
        d = pairs.setdefault((e["sess"], e["cat"]), {"cart": 0, "purchase": 0, "remove_from_cart": 0})
        if e["et"] in d:
            d[e["et"]] += 1
    cats = {}
    for (_, cat), d in pairs.items():
        c = cats.setdefault(cat, [0, 0, 0])
        c[0] += d["cart"] > 0
        c[1] += d["cart"] > 0 and d["purchase"] == 0
        c[2] += d["remove_from_cart"]
    return {k: tuple(v) for k, v in cats.items()}


def model_levels(clean):
    users = {}
    for e in clean:
        u = users.setdefault(e["user"], {"view": 0, "cart": 0, "purchase": 0})
        if e["et"] in u:
            u[e["et"]] += 1
    scores = {k: v["view"] + 3 * v["cart"] + 5 * v["purchase"] for k, v in users.items()}
    if len(scores) < 3:
        return {k: "Medium" for k in scores}
    q33, q67 = np.quantile(list(scores.values()), [0.33, 0.67])
    return {k: "Low" if s <= q33 else "Medium" if s <= q67 else "High" for k, s in scores.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_st, min_size=1, max_size=40).flatmap(
    lambda rows: st.lists(st.sampled_from(rows), min_size=0, max_size=8).map(lambda extra: rows + extra)))
def test_against_brute_force(spark, rows):
    expected = model(rows)
    tagged = Q.tag(make_raw(spark, rows))
    got = [r.rejection_reason for r in tagged.orderBy("source_row_number").collect()]
    assert got == [r for r, _ in expected]

    clean = [e for r, e in expected if r is None]
    silver = Q.silver(tagged).cache()
    ft, aa = model_funnel(clean)
    assert [r.sessions for r in FU.conversion_funnel(silver).orderBy("stage_order").collect()] == ft
    assert [r.sessions for r in FU.conversion_funnel(silver, "any_after").orderBy("stage_order").collect()] == aa
    ab = {r.category_code: (r.cart_sessions, r.abandoned_sessions, r.remove_from_cart_events)
          for r in AB.cart_abandonment(silver).collect()}
    assert ab == model_abandonment(clean)
    levels = {r.user_id: r.engagement_level for r in EN.customer_engagement(silver).collect()}
    assert levels == model_levels(clean)
    silver.unpersist()
