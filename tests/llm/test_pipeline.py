import re
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from clickvault.llm import personal
from clickvault.llm.common import BATCH_BYTES, fresh_path, map_texts
from clickvault.llm.leaks import decontaminate
from clickvault.llm.tokens import Encoder, default_tokenizer

from .helpers import ODD, docs_of, empty, prose
from .test_leaks_licenses import brute_leaks
from .test_personal import KINDS, brute
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def mask(text):
    spans, out, at = sorted(((a, -b, k) for k, a, b in brute(text))), "", 0
    for a, less, k in spans:
        out += text[at:a] if a > at else ""
        if -less > at:
            out += f"<{KINDS[k].upper()}>"
            at = -less
    return out + text[at:]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    one = P.language(spark, docs, SF)
    left = {r.doc_id for r in one.collect()}
    assert one.columns == docs.columns and left <= set(texts) and len(left) > 0.97 * len(texts)
    two = P.near_duplicate(spark, docs, SF)
    comps = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for i, c in comps.items() if i == c) and two.columns == docs.columns
    three = P.decontamination(spark, docs, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = dict(zip(texts, brute_leaks(texts.values(), items), strict=True))
    assert {r.doc_id: r.text for r in three.collect()} == {i: t for i, t in texts.items() if not hit[i][1]} and three.columns == docs.columns
    four = P.personal_data(spark, docs, SF)
    got = {r.doc_id: r for r in four.collect()}
    assert {i: r.text for i, r in got.items()} == {i: mask(t) for i, t in texts.items()}
    assert all(r.n_chars == len(r.text) for r in got.values()) and four.columns == docs.columns


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = P.language(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    texts = {i: texts[i] for i in {r.doc_id for r in docs.select("doc_id").collect()}}
    comps = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if comps[i] == i}
    hit = dict(zip(texts, brute_leaks(texts.values(), items), strict=True))
    texts = {i: mask(t) for i, t in texts.items() if not hit[i][1]}
    enc, parts = Encoder(default_tokenizer()), {}
    for r in P.run(spark, SF).collect():
        parts.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {i: b"".join(x for _, x in sorted(p)) for i, p in parts.items()} == {
        i: np.array([*enc.tok.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in texts.items()}


@pytest.mark.parametrize("stage", [n for n, _ in P.STAGES])
def test_odd_rows(spark, stage):
    import random
    rng = random.Random(1)
    texts = [*ODD, *[prose(rng, 30) for _ in range(20)], "mail a@b.cd now"]
    df = docs_of(spark, texts, {1: None})
    nulls = df.withColumn("doc_id", F.lit(None).cast("long"))
    for c in ("_k", "lang_pred", "score", "spans", "rid", "w", "_row_key", "__ROW_KEY", "_spans", "_lang_pred", "_lang_score", "_lang_ambiguous"):
        df, nulls = df.withColumn(c, F.lit("clash")), nulls.withColumn(c, F.lit("clash"))
    whole = df.unionByName(df.limit(5)).unionByName(nulls)
    path = fresh_path(spark, "t-docs")
    whole.write.parquet(path)
    fn = dict(P.STAGES)[stage]
    out = fn(spark, spark.read.parquet(path), SF)
    rows = out.collect()
    if stage != "packing":
        assert out.columns == whole.columns
        assert all(r[c] == "clash" for r in rows for c in ("_row_key", "__ROW_KEY", "_spans", "_lang_pred", "_lang_ambiguous"))
    if stage == "language":
        assert all(r.text and re.search(r"[^\W\d_]", r.text) for r in rows)
    if stage == "near_duplicates":
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert len(ids) == len(set(ids)) and sum(r.doc_id is None for r in rows) == len(set(texts))
    if stage == "decontamination":
        assert len(rows) == whole.count()
    if stage == "personal_data":
        assert len(rows) == whole.count() and sum("<EMAIL>" in (r.text or "") for r in rows) == 2 and not any("@" in (r.text or "") for r in rows)
    fn(spark, empty(spark), SF).collect()


def test_rows_that_share_an_id_are_told_apart(spark):
    import random
    rng = random.Random(4)
    a, b, c = (prose(rng, 60) for _ in range(3))
    df = docs_of(spark, [a, b, c, a], extra=False).withColumn("doc_id", F.when(F.col("doc_id") == 1, 0).otherwise(F.col("doc_id")))
    out = P.near_duplicate(spark, df.unionByName(df), SF).collect()  # ids 0 0 2 3; 3 is a copy of the first
    assert sorted((r.doc_id, r.text) for r in out) == sorted([(0, a), (0, b), (2, c)])


def test_batches_of_long_texts_are_bounded(spark):
    """What a Python worker gets at once follows a bound in bytes, not 10,000 texts of any length."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"n": b.num_rows, "bytes": b.nbytes}])

    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.lit("x" * 50_000).alias("text"))
    got = map_texts(docs, sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 600 and max(r.bytes for r in got) <= BATCH_BYTES + 200_000


def test_helper_rows_start_no_python_workers(spark):
    """The pipeline's native stages make their helper rows in the JVM."""
    docs = docs_of(spark, ["a mail to a@b.org from a b c d e f g h i j", None])
    items = spark.createDataFrame([("i1", "a b c d e f g h i j")], "item_id string, text string")
    with mock.patch.object(type(spark), "createDataFrame", side_effect=AssertionError("rows from Python")):
        assert {r.doc_id: r.contaminated for r in decontaminate(docs, items).collect()} == {0: True, 1: False}
        assert personal.find(docs).count() == 2
