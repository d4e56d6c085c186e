import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickvault.session import get_spark, staging_dir
    s = get_spark("local[4]", app="clickvault-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    staging_dir(s)  # the session's spark.checkpoint.dir; a private folder only if unset
    yield s
    s.stop()


RAW_COLS = ("source_row_number", "event_time", "event_type", "product_id", "category_id",
            "category_code", "brand", "price", "user_id", "user_session")


def make_raw(spark, rows):
    """Hand-made bronze rows: tuples of the 9 raw text values; row numbers from 2."""
    data = [(i + 2, *r) for i, r in enumerate(rows)]
    schema = "source_row_number bigint, " + ", ".join(f"{c} string" for c in RAW_COLS[1:])
    return spark.createDataFrame(data, schema)


def ev(t="2019-10-01 10:00:00 UTC", typ="view", pid="1", cat="electronics", brand="acme",
       price="10.0", uid="7", sess="s1", cid="100"):
    return (t, typ, pid, cid, cat, brand, price, uid, sess)
