import inspect
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickvault.llm import tokenfile
from clickvault.llm.common import fresh_path, list_files
from clickvault.llm.registry import QUERIES
from clickvault.llm.tokenfile import Predictor, blocks_of, decode_blocks, documents_of, encode_blocks, read_tokens, write_tokens
from clickvault.llm.tokens import Encoder, default_tokenizer

from .helpers import ODD, docs_of, empty, prose

SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 65535)), max_size=60), max_size=6))
def test_any_ids_come_back(blocks):
    blocks = [np.array(b, np.int64) for b in blocks]
    got = decode_blocks(encode_blocks(blocks), [len(b) for b in blocks])
    assert [g.tolist() for g in got] == [b.tolist() for b in blocks]


def test_worst_and_best_inputs():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 65536, 4096), np.zeros(4096, np.int64), np.tile([5, 65535, 7], 1300), np.full(4096, 65535), np.arange(4096)]
    coded = encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(decode_blocks(coded, [len(b) for b in blocks]), blocks))
    assert len(coded[0]) < 4096 * 2.4 and len(coded[1]) < 400 and len(coded[2]) < 900
    alone = decode_blocks([coded[2]], [len(blocks[2])])[0]  # a block needs no other block
    assert (alone == blocks[2]).all()


def test_bytes_of_the_format_stay():
    n = np.arange(3000)
    blocks = [n * 2654435761 % 2**32 >> 7 & 0xFFFF, n % 97 * 501, (n * n // 7 + n) % 61 * 1000, np.minimum(n, 700) * 93 & 0xFFFF]
    assert zlib.crc32(b"".join(encode_blocks(blocks))) == 190896343


def test_bytes_of_hard_blocks_stay():
    """Many lanes of unlike lengths: noise, runs, cycles, and ids that come back now and then."""
    n, blocks = np.arange(700), []
    for i in range(60):
        noise = (n + i * 977) * 2654435761 % 2**32 >> 11
        blocks.append([noise & 0xFFFF, n // 90 * 501 + i, n % (i + 1) * 1237 & 0xFFFF, np.where(noise % 7 < 5, n % 23 * 2011, noise) & 0xFFFF][i % 4][:700 - i * i % 611])
    coded = encode_blocks(blocks)
    assert zlib.crc32(b"".join(coded)) == 188708567
    assert all((a == b).all() for a, b in zip(decode_blocks(coded, [len(b) for b in blocks]), blocks))


def test_writing_codes_an_id_in_one_go(monkeypatch):
    """All bits are known, so the four groups share their steps."""
    group, calls = Predictor.group, []
    monkeypatch.setattr(Predictor, "group", lambda self, *a: calls.append(1) or group(self, *a))
    encode_blocks([np.arange(50) * 977, np.arange(30)])
    assert len(calls) == 50


def test_a_file_of_uneven_range_is_coded_in_one_go(monkeypatch):
    """Ranges differ by a tenth; blocks left over would be coded by themselves at a third of the cost of all."""
    usual = inspect.signature(write_tokens).parameters["file_ids"].default // tokenfile.BLOCK
    monkeypatch.setattr(tokenfile, "BLOCK", 4)
    whole, calls = tokenfile.encode_blocks, []
    monkeypatch.setattr(tokenfile, "encode_blocks", lambda blocks: calls.append(len(blocks)) or whole(blocks))
    ids = np.arange(usual * 4 * 6 // 5, dtype="<u2")
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary())})
    data = b"".join(b + tokenfile.TRAILER.encode() for out in tokenfile._write(ids.dtype)(iter([batch])) for b in out.column("block").to_pylist())
    assert calls == [-(-len(ids) // 4)]
    assert [np.frombuffer(d["ids"], "<u4").tolist() for d in documents_of(data)] == [ids.tolist()]


def test_reading_looks_at_few_borders(monkeypatch):
    """Four of the sixteen are mixed, so reading holds little more than writing."""
    group, peaks = Predictor.group, {True: 0, False: 0}

    def noted(self, coder, lanes, i, context, state, votes, symbol):
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        out = group(self, coder, lanes, i, context, state, votes, symbol)
        peaks[symbol is None] = max(peaks[symbol is None], tracemalloc.get_traced_memory()[1] - before)
        return out

    monkeypatch.setattr(Predictor, "group", noted)
    blocks = [np.arange(6) * 977 + i for i in range(1024)]
    tracemalloc.start()
    try:
        coded = encode_blocks(blocks)
        assert all((a == b).all() for a, b in zip(decode_blocks(coded, [6] * 1024), blocks))
    finally:
        tracemalloc.stop()
    assert 0 < peaks[True] < 1.5 * peaks[False], peaks


def test_mixing_beats_fewer_orders_on_documents(spark, monkeypatch):
    enc = Encoder(default_tokenizer())
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    ids = np.frombuffer(b"".join(enc.encode(t.encode()) for t in texts), enc.dtype).astype(np.int64)
    blocks = [ids[i:i + 4096] for i in range(0, len(ids) - 4095, 4096)][:12]
    start, sizes = Predictor.__init__, {}
    for orders in ((0,), (0, 1), (0, 2), (0, 1, 2)):
        def without(self, lanes, orders=orders):
            start(self, lanes)
            for o in (0, 1):
                self.weights[o] *= o + 1 in orders  # a weight of nothing stays nothing

        monkeypatch.setattr(Predictor, "__init__", without)
        sizes[orders] = sum(map(len, encode_blocks(blocks)))
    assert len(blocks) > 3 and all(sizes[0, 1, 2] < n for o, n in sizes.items() if len(o) < 3), sizes


def check_files(rows, texts):
    enc, start = Encoder(default_tokenizer()), 0
    by = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start))
    for r, (i, t) in zip(by, texts, strict=True):
        ids = np.array([*enc.tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids)) and bytes(r.ids) == ids.tobytes()
        start += len(ids)


@pytest.mark.parametrize("file_ids", [700, 8 << 20])
def test_round_trip(spark, file_ids):
    rng = random.Random(8)
    texts = [*ODD, *[prose(rng, rng.randrange(300)) for _ in range(30)], prose(rng, 9000)]
    df = docs_of(spark, texts).repartition(4)
    out = fresh_path(spark, "t-tokens")
    manifest = write_tokens(df, out, default_tokenizer(), file_ids=file_ids)
    check_files(read_tokens(spark, out).collect(), list(enumerate(texts)))
    assert (len(manifest) > 1) == (file_ids == 700) and sum(m["documents"] for m in manifest) == len(texts)


def test_null_ids_repeats_and_empty(spark):
    df = docs_of(spark, ["one two", "three"])
    both = df.unionByName(df).unionByName(df.withColumn("doc_id", F.lit(None).cast("long")))
    out = fresh_path(spark, "t-tokens")
    write_tokens(both, out, default_tokenizer())
    got = read_tokens(spark, out).collect()
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == [0, 0, 1, 1] and len(got) == 6
    assert len({r.start for r in got}) == 6 and all(r.start < 7 for r in got if r.doc_id is None)
    out = fresh_path(spark, "t-tokens")
    assert write_tokens(empty(spark), out, default_tokenizer()) == []


def test_damage_is_found(spark):
    out = fresh_path(spark, "t-tokens")
    write_tokens(docs_of(spark, ["some words to be coded here"]), out, default_tokenizer())
    path = next(p for p, _ in list_files(spark, out) if p.endswith(".tkb")).removeprefix("file:")
    data = open(path, "rb").read()
    assert len(list(documents_of(data))) == 1
    n, _, index, payload = next(blocks_of(data))
    at = data.index(payload)
    with pytest.raises(ValueError):
        list(documents_of(data[:at] + bytes([data[at] ^ 64]) + data[at + 1:]))
    with pytest.raises(ValueError):
        list(documents_of(data[:-3]))


def test_op1_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op1_token_files"](spark, SF).collect()}
    enc, start = Encoder(default_tokenizer()), 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*enc.tok.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
