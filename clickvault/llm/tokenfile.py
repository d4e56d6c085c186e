"""Token-id files: blocks of ids under an adaptive context-mixing range coder.

A block holds up to ``BLOCK`` ids and starts from nothing: its models, its
coder state and its checksum are its own, so any block can be decoded, or
found to be damaged, by itself.

Model of one id, coded four bits at a time: three predictions of each group of
bits are mixed. Order 0 gives adaptive frequencies for the bits before the
group; the id that followed the last id, and the one that followed the last
two, each vote for their own bits as long as the bits before were theirs. The
mix is the weighted sum of the three distributions. Weights are kept for how
often each order has been right lately, and move towards the share that each
prediction had in what came (its weight times the probability it gave). All
frequencies and weights adapt after every group, in whole numbers only, so
every machine decodes the same. A 64-bit range coder turns the intervals into
bytes.

Blocks do not depend on each other, so many are coded side by side: each
numpy operation below does the same step of up to ``LANES`` blocks.

File format, little-endian: per block ``TKB1``, u32 ids, u32 index bytes, u32
payload bytes, u32 crc32 of the ids as u32; the index (per piece of a
document: i64 id, u32 ids, u8 flags: 1 starts here, 2 ends here, 4 null id);
the payload; ``TKBE`` after it. Ids are written in ascending document order
over all files; pieces of a document may lie in several blocks of one file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.llm.common import batched, columns_of, commit_files, fresh_path, materialize, read_blobs, write_blobs
from clickvault.llm.tokens import encode_texts, id_type

#: LANES: a quarter more than the blocks of a file of the usual size, as the sampled ranges differ by a
#: tenth or so and a few blocks left over take a third of the time of 2048.
BLOCK, LANES, CONTEXTS = 4096, 2560, 1 << 12
MAGIC, TRAILER, HEAD, ENTRY = b"TKB1", "TKBE", struct.Struct("<4sIIII"), np.dtype([("id", "<i8"), ("n", "<u4"), ("flags", "u1")])
U = np.uint64
TOP, LOW, S16, S48, PREC = U(1 << 48), U((1 << 32) - 1), U(16), U(48), U(16)
FULL, LEAST = 1 << 14, 24
#: Weights are out of ONE, and order 0 keeps FLOOR: with LEAST that leaves every group of bits a width of one in 65536.
ONE, FLOOR, SPEED = 1 << 12, 64, 5
#: Contexts of order 0 for each group of bits, and how fast their frequencies move; where the bits lie in an id.
SIZES, RATES, PLACES = (1, 16, 256, 256), (5, 5, 4, 4), np.array([[12], [8], [4], [0]], np.int32)
SAME = np.tile(np.arange(FULL, dtype=np.int16)[:, None], (1, 16))  # each number as a row of borders


class Coder:
    """Range coder states of many blocks, one column each (carry-less, 16 bits at a time).

    A step takes the first so many lanes: blocks are in order of their length."""

    def __init__(self, lanes: int, data: list[bytes] | None = None, room: int = 0):
        self.low, self.range = np.zeros(lanes, U), np.full(lanes, U(0xFFFFFFFFFFFFFFFF))
        self.at, self.turns = np.zeros(lanes, np.int64), 0
        if data is None:
            self.out = np.zeros((lanes, room), "<u2")
        else:
            self.out = np.zeros((lanes, max(map(len, data), default=0) // 2 + 8), "<u2")
            for i, d in enumerate(data):
                self.out[i, :len(d) // 2] = np.frombuffer(d, "<u2")
            self.code = np.zeros(lanes, U)
            for _ in range(4):
                self.code = (self.code << S16) | self.out[np.arange(lanes), self.at].astype(U)
                self.at += 1

    def _narrow(self, lanes: int, r: np.ndarray, lo: np.ndarray, width: np.ndarray, reading: bool) -> None:
        low, rng = self.low[:lanes], self.range[:lanes]
        low += r * lo.astype(U, copy=False)
        np.multiply(r, width.astype(U, copy=False), out=rng)
        # no width is above 65521, so the first 16 bits of both ends can be equal below TOP only
        at = np.flatnonzero(rng < TOP)
        while len(at):
            a, b = low[at], rng[at]
            go, short = (a ^ (a + b)) < TOP, b <= LOW
            if np.count_nonzero(short):
                tight = np.flatnonzero(short & ~go)
                b[tight] = (~a[tight] + U(1)) & LOW
                go |= short
            at, a, b = at[go], a[go], b[go]
            if not len(at):
                break
            places = self.at[at]
            if reading:
                # beyond the end only in a damaged block, which its checksum will tell
                self.code[at] = (self.code[at] << S16) | self.out[at, np.minimum(places, self.out.shape[1] - 1)]
            else:
                if self.turns % 256 == 0 and int(self.at.max()) + 1024 >= self.out.shape[1]:
                    self.out = np.concatenate([self.out, np.zeros((len(self.out), 2048), "<u2")], axis=1)
                self.turns += 1
                self.out[at, places] = a >> S48
            self.at[at] = places + 1
            b <<= S16
            low[at] = a << S16
            rng[at] = b
            # after a shift they can also be equal when the range is all but whole and the sum goes round
            at = at[b + TOP < TOP + TOP]

    def encode(self, lanes: int, lo, width) -> None:
        self._narrow(lanes, self.range[:lanes] >> PREC, lo, width, False)

    def target(self, lanes: int) -> np.ndarray:
        self.unit = self.range[:lanes] >> PREC
        return np.minimum((self.code[:lanes] - self.low[:lanes]) // self.unit, U((1 << 16) - 1)).astype(np.int32)

    def decode(self, lanes: int, lo, width) -> None:
        """What ``target`` was asked for."""
        self._narrow(lanes, self.unit, lo, width, True)

    def finish(self) -> list[bytes]:
        for i in range(4):
            need = self.at + i + 1 > self.out.shape[1]
            if need.any():
                self.out = np.concatenate([self.out, np.zeros((len(self.at), 4), "<u2")], axis=1)
            self.out[np.arange(len(self.at)), self.at + i] = ((self.low >> (S48 - U(16 * i))) & U(0xFFFF)).astype(np.uint16)
        return [self.out[i, :n + 4].tobytes() for i, n in enumerate(self.at.tolist())]


class Tables:
    """Adaptive frequencies: for each group of bits, lane and context the upper
    borders of 16 symbols, out of ``FULL``; the last is always ``FULL``.

    A symbol moves the borders a part of the way to a distribution in which
    every other symbol still has ``LEAST``, so no width ever reaches zero.
    """

    def __init__(self, lanes: int):
        n = 16
        first = np.cumsum([0, *(lanes * c for c in SIZES)])
        self.base = first[:4, None] + np.arange(lanes) * np.array(SIZES)[:, None]
        self.borders = np.tile((np.arange(1, n + 1) * FULL // n).astype(np.int16), (int(first[4]), 1))
        self.whole = self.borders.view("V32").reshape(-1)  # the same borders, one item a context
        step = np.arange(n)
        self.goals = np.where(step[None, :] >= step[:, None], FULL - (n - 1 - step) * LEAST, (step + 1) * LEAST).astype(np.int16)

    def move(self, at: np.ndarray, rows: np.ndarray, symbol: np.ndarray, rates: tuple[int, ...]) -> None:
        """``rates``: one for each equal part of the rows."""
        change = self.goals.take(symbol, axis=0)
        change -= rows
        n = len(rows) // len(rates)
        for i, rate in enumerate(rates):
            change[i * n:(i + 1) * n] >>= rate
        change += rows
        self.whole[at] = change.view("V32").reshape(-1)


class Predictor:
    """The three orders of many blocks and the weights that mix them."""

    def __init__(self, lanes: int):
        # for each order, lane and context: the last id times four, and how far it is trusted
        self.seen = np.zeros(2 * lanes * CONTEXTS, np.int32)
        self.keys = np.arange(2 * lanes).reshape(2, lanes) * CONTEXTS
        self.bits = Tables(lanes)
        # weights of orders 1 and 2 for each trust in them, first group and later ones; an order
        # whose bits were wrong already (4) has none, and what has none gets none
        start = np.array([250, 1100, 1700, 2000, 0], np.int32)
        one, two = np.tile(start[:, None], (1, 5)).reshape(-1), np.tile(start[None, :], (5, 1)).reshape(-1)
        self.held = np.concatenate([np.tile(np.concatenate([w, w]), lanes) for w in (one, two)])
        self.weights = [self.held[:lanes * 50], self.held[lanes * 50:]]
        self.slots = np.arange(2 * lanes).reshape(2, lanes) * 50
        self.each = np.arange(4 * lanes) * 16

    def weigh(self, slots: np.ndarray) -> tuple[np.ndarray, ...]:
        """What is held for orders 1 and 2, and the weights of orders 1, 2 and 0."""
        held = self.held.take(slots)
        two = np.minimum(held[1], ONE - FLOOR)
        one = np.minimum(held[0], ONE - FLOOR - two)
        return held, one, two, ONE - one - two

    def learn(self, slots: np.ndarray, held: np.ndarray, own: np.ndarray, zero: np.ndarray) -> None:
        """Move weights towards each order's share in the probability of what came, out of ONE.

        A quotient of whole numbers below 2^38 by one below 2^27 is never rounded up to the next whole number."""
        share = (own * float(ONE << 14) / (zero + (own[0] + own[1] << 14))).astype(np.int32)
        share -= held
        share >>= SPEED
        share += held
        self.held[slots] = share

    def group(self, coder: Coder, lanes: np.ndarray, i: int | slice, context: np.ndarray, state: np.ndarray, votes: np.ndarray, symbol: np.ndarray | None) -> np.ndarray:
        """Code the ``i``-th four bits of one id of each lane under the mix; returns them.

        When writing all groups are known, and come together (``i``: a slice, and
        a dimension more). Products stay below 2^27, so 32 bits hold all but the
        weights' shares."""
        n, reading = len(lanes), symbol is None
        at = (self.bits.base[i, :n] + context).reshape(-1)
        rows = self.bits.borders.take(at, axis=0)
        flat, each = rows.reshape(-1), self.each[:len(at)]
        slots = self.slots[:, :n] + (state[0] * 5 + state[1])[..., None, :]
        if reading:
            if i:
                slots += 25
            held, one, two, zero = self.weigh(slots)
            symbol = self.find(coder.target(n), rows, each, np.stack([one, two]) << 4, zero, votes)
        else:
            slots[1:] += 25
        position = each + symbol.reshape(-1)
        hi = flat.take(position).astype(np.int32).reshape(symbol.shape)
        position -= 1  # the first symbol finds the row before, which ends with FULL: no lower border
        lo = (flat.take(position, mode="wrap") & (FULL - 1)).astype(np.int32).reshape(symbol.shape)
        hits = (votes == symbol).astype(np.int32)
        if reading:
            own = np.stack([one, two])
            own *= hits
            self.learn(slots, held, own, zero * (hi - lo))
        else:
            span, own = hi - lo, np.empty_like(hits)
            one, two, zero = (np.empty_like(hi) for _ in range(3))
            for g in range(len(slots)):
                held, one[g], two[g], zero[g] = self.weigh(slots[g])
                np.multiply(one[g], hits[0, g], out=own[0, g])
                np.multiply(two[g], hits[1, g], out=own[1, g])
                self.learn(slots[g], held, own[:, g], zero[g] * span[g])
        hi *= zero
        lo *= zero
        hi >>= 10
        lo >>= 10
        width = hi - lo
        width += own[0] + own[1] << 4
        below = (votes - symbol) >> 31  # all bits where a vote stands before what came
        below[0] &= one << 4
        below[1] &= two << 4
        lo += below[0]
        lo += below[1]
        if reading:
            coder.decode(n, lo, width)
        else:
            for l, w in zip(lo.astype(U), width.astype(U), strict=True):
                coder.encode(n, l, w)
        self.bits.move(at, rows, symbol.reshape(-1), RATES[i] if isinstance(i, slice) else RATES[i:i + 1])
        return symbol

    def find(self, target: np.ndarray, rows: np.ndarray, each: np.ndarray, parts: np.ndarray, zero: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """The first symbol whose upper border in the mix is above the target.

        Votes whose symbols begin at or before the target are taken off it; what is left
        is looked up among the borders of order 0, all 16 of a row compared at once."""
        before = (rows.reshape(-1).take(each + votes - 1, mode="wrap") & (FULL - 1)).astype(np.int32)
        before *= zero
        before >>= 10
        before += (votes[::-1] - votes) >> 31 & parts[::-1]
        past = (before - 1 - target) >> 31  # all bits where the target is not before the vote's symbol
        left = target + 1 - (parts[0] & past[0]) - (parts[1] & past[1])
        least = votes & past
        most = ((left * 1024 - 1) / zero).astype(np.int64)  # rounded towards zero: what is below has no border either
        fits = (rows <= SAME.take(most, axis=0, mode="clip")).view(U)
        count = (fits[:, 0] + fits[:, 1]) * U(0x0101010101010101) >> U(56)  # the sum of 16 bytes
        return np.maximum(count.astype(np.int32), np.maximum(least[0], least[1]))

    def step(self, coder: Coder, lanes: np.ndarray, one: np.ndarray, two: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """Code one id of each lane after ``two``, ``one``; returns the ids."""
        n = len(lanes)
        keys, mixed = np.empty((2, n), np.int64), one * 2654435761
        np.right_shift(mixed, 7, out=keys[0])
        np.right_shift(mixed + two * 2654469599, 9, out=keys[1])
        keys &= CONTEXTS - 1
        keys += self.keys[:, :n]
        seen = self.seen.take(keys)
        guess, trust = seen >> 2, seen & 3
        if ids is None:
            right, state, value = np.ones((2, n), bool), trust, np.zeros(n, np.int64)
            for i in range(4):
                context = value if i < 3 else value * 2654435761 >> 10 & 255
                votes = guess >> (12 - 4 * i) & 15
                part = self.group(coder, lanes, i, context, state, votes, None)
                value = value * 16 + part
                right &= votes == part
                if i < 3:
                    state = np.where(right, trust, 4)
        else:
            value, symbol, votes = ids, ids.astype(np.int32) >> PLACES & 15, guess[:, None] >> PLACES & 15
            context = np.zeros((4, n), np.int64)
            np.right_shift(ids, 12, out=context[1])
            np.right_shift(ids, 8, out=context[2])
            context[3] = (ids >> 4) * 2654435761 >> 10 & 255
            hits, state = votes == symbol, np.empty_like(votes)
            right, state[:, 0] = hits[:, 0], trust
            for i in range(1, 4):
                state[:, i] = np.where(right, trust, 4)
                right = right & hits[:, i]
            self.group(coder, lanes, slice(0, 4), context, state, votes, symbol)
        self.seen[keys] = value * 4 + np.where(right, np.minimum(trust + 1, 3), trust >> 1)
        return value


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks of ids below 65536, coded side by side."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    ids = np.zeros((int(sizes.max(initial=0)), len(blocks)), np.uint16)  # what a step codes lies together
    for lane, i in enumerate(order):
        ids[:len(blocks[i]), lane] = blocks[i]
    coder, model = Coder(len(blocks), room=2048), Predictor(len(blocks))
    one = two = np.zeros(len(blocks), np.int64)
    for t in range(len(ids)):
        lanes = np.arange(int((sizes > t).sum()))
        now = ids[t, :len(lanes)].astype(np.int64)
        model.step(coder, lanes, one[:len(lanes)], two[:len(lanes)], now)
        one, two = now, one
    out: list[bytes] = [b""] * len(blocks)
    for row, payload in enumerate(coder.finish()):
        out[order[row]] = payload
    return out


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    n = np.array([sizes[i] for i in order])
    coder, model = Coder(len(n), [payloads[i] for i in order]), Predictor(len(n))
    ids = np.zeros((int(n.max(initial=0)), len(n)), np.uint16)
    one = two = np.zeros(len(n), np.int64)
    for t in range(len(ids)):
        lanes = np.arange(int((n > t).sum()))
        now = model.step(coder, lanes, one[:len(lanes)], two[:len(lanes)], None)
        ids[t, :len(lanes)] = now
        one, two = now, one
    out: list[np.ndarray] = [one] * len(n)
    for lane, i in enumerate(order):
        out[i] = ids[:n[lane], lane].astype("<u4")
    return out


def assemble(ids: np.ndarray, index: np.ndarray, payload: bytes) -> bytes:
    """A block without its trailer, which the writer puts after each."""
    return HEAD.pack(MAGIC, len(ids), index.nbytes, len(payload), zlib.crc32(ids.astype("<u4").tobytes())) + index.tobytes() + payload


def blocks_of(data: bytes) -> Iterator[tuple[int, int, np.ndarray, bytes]]:
    """(ids, crc32, index, payload) of each block of a file."""
    at = 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise ValueError("the last block is cut off")
        magic, n, index, payload, crc = HEAD.unpack_from(data, at)
        at += HEAD.size
        end = at + index + payload + len(TRAILER)
        if magic != MAGIC or end > len(data) or data[end - len(TRAILER):end] != TRAILER.encode():
            raise ValueError(f"no whole block at byte {at - HEAD.size}")
        yield n, crc, np.frombuffer(data, ENTRY, index // ENTRY.itemsize, at), data[at + index:at + index + payload]
        at = end


_BLOB = pa.schema([("block", pa.binary())])


def _write(dtype: np.dtype):
    """Sorted documents (``doc_id ids``) to blocks, coded ``LANES`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: list[tuple[np.ndarray, list]] = []
        parts: list[np.ndarray] = []
        index: list[tuple] = []
        filled = 0

        def close():
            nonlocal parts, index, filled
            if filled:
                full.append((np.concatenate(parts), index))
            parts, index, filled = [], [], 0

        def flush():
            for (ids, entries), payload in zip(full, encode_blocks([b for b, _ in full]) if full else [], strict=True):
                yield {"block": assemble(ids, np.array(entries, ENTRY), payload)}
            full.clear()

        def rows():
            nonlocal filled
            for batch in batches:
                for doc, raw in zip(*columns_of(batch, "doc_id", "ids"), strict=True):
                    ids, at = np.frombuffer(raw, dtype), 0
                    while at < len(ids):
                        n = min(BLOCK - filled, len(ids) - at)
                        parts.append(ids[at:at + n])
                        index.append((doc or 0, n, (at == 0) | (at + n == len(ids)) << 1 | (doc is None) << 2))
                        at, filled = at + n, filled + n
                        if filled == BLOCK:
                            close()
                            if len(full) == LANES:
                                yield from flush()
            close()
            yield from flush()

        yield from batched(rows(), _BLOB, weigh="block")

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and documents of each file, from its blocks' heads and indexes."""
    schema = pa.schema([("path", pa.string()), ("tokens", pa.int64()), ("documents", pa.int64())])
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            blocks = [(n, int((index["flags"] & 2).astype(bool).sum())) for n, _, index, _ in blocks_of(data)]
            yield pa.RecordBatch.from_pylist([{"path": path, "tokens": sum(b[0] for b in blocks), "documents": sum(b[1] for b in blocks)}], schema)


def write_tokens(docs: DataFrame, out: str, tokenizer: str, file_ids: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Encode all texts and write ``out/tokens-NNNNNNNN.tkb`` in ascending id
    order, and ``out/manifest.json``; returns the manifest.

    Texts are encoded once, where they are read; their ids are sorted, by
    ranges, in one shuffle, and each range is coded and written where it
    arrives, as one file. ``file_ids``: about as many ids go into a file. Null
    ids come first; rows of the same id are ordered by a hash of their tokens,
    and equal rows can lie in several files.
    """
    spark, dtype = docs.sparkSession, id_type(tokenizer)
    if dtype.itemsize > 2:
        raise ValueError("the coder takes vocabularies of up to 65536 ids")
    staged = materialize(encode_texts(docs, tokenizer, id_col, text_col), "token-ids")
    total = (staged.agg(F.sum(F.length("ids"))).first()[0] or 0) // dtype.itemsize
    keyed = staged.select("doc_id", F.xxhash64("ids").alias("hash"), F.monotonically_increasing_id().alias("no"), "ids")
    key = ["doc_id", "hash", "no"]  # short: the ranges are found from a sample of it on the driver
    ranged = keyed.repartitionByRange(max(1, -(-total // file_ids)), *key).sortWithinPartitions(*key).select("doc_id", "ids")
    base = out.rstrip("/")
    temp = f"{base}/_temporary-{fresh_path(spark, 't').rsplit('-', 1)[1]}"
    write_blobs(ranged.mapInArrow(_write(dtype), "block binary"), temp, "block", TRAILER)
    # files are named by range; one row each comes back
    facts = sorted(tuple(r) for r in read_blobs(spark, temp, "part-*").mapInArrow(_count, "path string, tokens long, documents long").filter("tokens > 0").collect())
    manifest, first = [], 0
    for i, (_, tokens, documents) in enumerate(facts):
        manifest.append({"file": f"tokens-{i:08d}.tkb", "first": first, "tokens": tokens, "documents": documents})
        first += tokens
    commit_files(spark, [(f[0], f"{base}/{m['file']}") for f, m in zip(facts, manifest, strict=True)], f"{base}/manifest.json", manifest)
    return manifest


_DOC = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def documents_of(data: bytes) -> Iterator[dict]:
    """Documents of one file with their place in it, every block's checksum verified."""
    held: list[np.ndarray] = []
    at, start, todo = 0, 0, []

    def drain():
        nonlocal at, start, held
        for (n, crc, index, _), ids in zip(todo, decode_blocks([b[3] for b in todo], [b[0] for b in todo]) if todo else [], strict=True):
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError("a block's checksum differs")
            done = 0
            for e in index:
                if e["flags"] & 1:
                    held, start = [], at
                held.append(ids[done:done + int(e["n"])])
                done, at = done + int(e["n"]), at + int(e["n"])
                if e["flags"] & 2:
                    whole = np.concatenate(held)
                    yield {"doc_id": None if e["flags"] & 4 else int(e["id"]), "at": start, "n_tokens": len(whole), "ids": whole.astype("<u4").tobytes()}
                    held = []
        todo.clear()

    for block in blocks_of(data):
        todo.append(block)
        if len(todo) == LANES:
            yield from drain()
    yield from drain()


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id start n_tokens ids`` of every document in the files; ``ids`` as
    little-endian unsigned 32-bit, ``start``: ids of all documents before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                yield from batched(({"file": path.rsplit("/", 1)[1]} | d for d in documents_of(data)), _DOC, weigh="ids")

    firsts = spark.read.schema("file string, first long").json(f"{out.rstrip('/')}/manifest.json")  # one row a file
    rows = read_blobs(spark, out, "*.tkb").mapInArrow(run, "file string, doc_id long, at long, n_tokens long, ids binary")
    return rows.join(firsts, "file").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")
