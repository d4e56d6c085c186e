"""Repeated passages: every word inside a window of ``window`` words whose word
sequence starts anywhere else too is removed.

Level-wise doubling. A long window can only repeat if its halves do, so the
windows of the first length (the window halved until it is at most
``first``) are counted over the whole corpus; those that repeat, and only
those, are extended to twice the length and counted again, until the full
window is reached or no candidates survive.

Counting moves no positions and no text. The documents lie in groups; each
group sends the sorted set of its window keys, cut to as many bits as the
level needs and packed as differences, to the bucket of each key, with the
keys that already repeat inside the part marked. So a window that occurs in a
third of all documents arrives once a part, not once an occurrence. A bucket
answers each group with those of its keys that occur elsewhere too. Groups
meet the answers where their texts already are: the texts are exchanged once,
and that exchange serves every level. The last level compares 128 bits of two
independent hashes; the levels before may let a few candidates through that
do not repeat, which the last one rejects.

A row's group follows from its id and text, so copies of a text spread over
the groups; only exact repeats of a whole row share one.

Null text: no words. Texts shorter than the window are kept whole. Repeated
rows count as occurrences of their own. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import batched, pick

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PART = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("twice", pa.bool_()), ("keys", pa.binary())])
_ANSWER = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])
PART, ANSWER, OUT = "bucket int, grp int, twice boolean, keys binary", "grp int, bucket int, keys binary", "doc_id long, text string, n_words long, n_removed long"


def ladder(window: int, first: int) -> list[int]:
    """The window lengths, shortest first; each is at most twice the one before."""
    out = [window]
    while out[0] > first:
        out.insert(0, (out[0] + 1) // 2)
    return out


class Words(dict):
    """128-bit hashes of words, remembered per Python worker: so many, of up to 64 bytes."""

    def __missing__(self, word: bytes) -> bytes:
        from xxhash import xxh3_128_digest

        digest = xxh3_128_digest(word)
        if len(word) <= 64:
            self[word] = digest
        return digest

    def hashes(self, words: list[bytes], most: int = 400_000) -> np.ndarray:
        if len(self) > most:
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8").reshape(-1, 2)


_WORDS = Words()


def windows(lane: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key of every ``n`` consecutive hashes, built from halves."""
    def run(k: int) -> np.ndarray:
        if k == 1:
            return lane
        half = k // 2
        h = run(half)
        out = h[:len(h) - half] * np.uint64(pow(int(_ODD), half, 1 << 64)) + h[half:]
        return out[:-1] * _ODD + lane[k - 1:] if k % 2 else out

    if len(lane) < n:
        return np.zeros(0, np.uint64)
    h = run(n)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Level:
    """How keys of one level are cut, bucketed and packed."""

    def __init__(self, length: int, last: bool, buckets: int, bits: int):
        self.length, self.last, self.buckets = length, last, buckets
        self.shift = np.uint64(0 if last else max(0, 64 - bits))

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Of a text's word hashes: (n, 1) cut keys, or (n, 2) whole ones at the last level."""
        top = windows(hashes[:, 0].copy(), self.length) >> self.shift
        return np.stack([top, windows(hashes[:, 1].copy(), self.length)], 1) if self.last else top[:, None]

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys[:, 0] % np.uint64(self.buckets)).astype(np.int64)

    def pack(self, keys: np.ndarray) -> bytes:
        """Sorted rows; cut keys as byte planes of their differences (the high planes are zeros)."""
        if self.last:
            return keys.tobytes()
        k = keys[:, 0] // np.uint64(self.buckets)
        return np.diff(k, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[:self.planes].tobytes()

    @property
    def planes(self) -> int:
        return max(1, -(-(64 - int(self.shift)) // 8))

    def unpack(self, data: bytes, bucket: int) -> np.ndarray:
        if self.last:
            return np.frombuffer(data, "<u8").reshape(-1, 2)
        planes = np.frombuffer(data, np.uint8).reshape(self.planes, -1)
        full = np.zeros((planes.shape[1], 8), np.uint8)
        full[:, :self.planes] = planes.T
        return (np.cumsum(full.view("<u8")[:, 0], dtype=np.uint64) * np.uint64(self.buckets) + np.uint64(bucket))[:, None]


def sort_rows(keys: np.ndarray) -> np.ndarray:
    if keys.shape[1] == 1:
        return np.sort(keys, axis=0)
    out = keys[np.argsort(keys[:, 0])]
    same = out[1:, 0] == out[:-1, 0]
    if (out[1:, 1] != out[:-1, 1])[same].any():  # equal first halves with other second halves: almost never
        return keys[np.lexsort(keys.T[::-1])]
    return out


def repeated_rows(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of sorted keys, and whether each is there more than once."""
    if not len(keys):
        return keys, np.zeros(0, bool)
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    at = np.flatnonzero(new)
    return keys[at], np.diff(np.append(at, len(keys))) > 1


class Known:
    """Sorted keys to look others up in. A table over 22 mixed bits lets most
    others go without a search; what it lets through is searched for."""

    def __init__(self, found: np.ndarray):
        self.found, self.table = found, np.zeros(1 << 22, bool)
        self.table[self._slots(found)] = True

    def __len__(self) -> int:
        return len(self.found)

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys[:, 0] * _ODD) >> np.uint64(42)

    def among(self, keys: np.ndarray) -> np.ndarray:
        """Which rows of ``keys`` are known."""
        if not len(self.found) or not len(keys):
            return np.zeros(len(keys), bool)
        hit = self.table[self._slots(keys)]
        at = np.flatnonzero(hit)
        hit[at] = among(keys[at], self.found)
        return hit


def among(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which rows of ``keys`` are rows of ``found`` (sorted)."""
    if not len(found) or not len(keys):
        return np.zeros(len(keys), bool)
    lo = np.searchsorted(found[:, 0], keys[:, 0])
    if keys.shape[1] == 1:
        return found[np.minimum(lo, len(found) - 1), 0] == keys[:, 0]
    hit, open_ = np.zeros(len(keys), bool), lo < len(found)
    while open_.any():  # equal first halves with other second halves: almost never a second turn
        at = np.minimum(lo, len(found) - 1)
        same = open_ & (found[at, 0] == keys[:, 0])
        hit |= same & (found[at, 1] == keys[:, 1])
        lo, open_ = lo + 1, same & ~hit & (lo + 1 < len(found))
    return hit


class Sets:
    """Window keys of some groups, gathered and handed on as packed sets."""

    def __init__(self, level: Level, most: int):
        self.level, self.most, self.size, self.held = level, most, 0, {}

    def add(self, grp: int, keys: np.ndarray) -> Iterator[dict]:
        if len(keys):
            self.held.setdefault(grp, []).append(keys)
            self.size += len(keys)
            if self.size >= self.most:
                yield from self.flush()

    def flush(self) -> Iterator[dict]:
        for grp, parts in self.held.items():
            keys, twice = repeated_rows(sort_rows(np.concatenate(parts)))
            where = self.level.bucket(keys) * 2 + twice
            order = np.argsort(where, kind="stable")
            ids, starts = np.unique(where[order], return_index=True)
            for x, own in zip(ids.tolist(), np.split(keys[order], starts[1:]), strict=True):
                yield {"bucket": x // 2, "grp": grp, "twice": bool(x % 2), "keys": self.level.pack(own)}
        self.held, self.size = {}, 0


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _first(level: Level, most: int):
    """Documents (``grp doc_id text``) to the key sets of all their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(level, most)

        def rows():
            for batch in batches:
                for grp, text in zip(batch.column("grp").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    yield from sets.add(grp, level.keys(_WORDS.hashes(_words(text))))
            yield from sets.flush()

        yield from batched(rows(), _PART, weigh="keys")

    return run


def _known(level: Level, answers: pa.Table) -> Known:
    """All repeated keys that a group's answers hold."""
    got = [level.unpack(k, b) for k, b in zip(answers.column("keys").to_pylist(), answers.column("bucket").to_pylist(), strict=True)]
    return Known(sort_rows(np.concatenate(got)) if got else np.zeros((0, 2 if level.last else 1), np.uint64))


def _longer(before: Level, level: Level, most: int):
    """A group's documents and answers to the key sets of the windows whose first and last part both repeat."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        sets, known, rows = Sets(level, most), _known(before, answers), []
        for grp, text in zip(docs.column("grp").to_pylist(), docs.column("text").to_pylist(), strict=True) if len(known) else ():
            words = _words(text)
            n = len(words) - level.length + 1
            if n > 0:
                hashes = _WORDS.hashes(words)
                ok = known.among(before.keys(hashes))
                ok = ok[:n] & ok[level.length - before.length:][:n]
                if ok.any():
                    rows += sets.add(grp, level.keys(hashes)[ok])
        rows += sets.flush()
        return pa.Table.from_pylist(rows, schema=_PART)

    return run


def _count(level: Level):
    """A bucket's parts to answers: for each group those of its keys that occur more than once in all."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        grps, twice = table.column("grp").to_pylist(), table.column("twice").to_pylist()
        parts = [level.unpack(k, bucket) for k in table.column("keys").to_pylist()]
        every = sort_rows(np.concatenate([*parts, *[p for p, t in zip(parts, twice, strict=True) if t]]))
        keys, many = repeated_rows(every)
        found = keys[many]
        by: dict[int, list[np.ndarray]] = {}
        for grp, p in zip(grps, parts, strict=True):
            hit = p[among(p, found)]
            if len(hit):
                by.setdefault(grp, []).append(hit)
        rows = [{"grp": g, "bucket": bucket, "keys": level.pack(repeated_rows(sort_rows(np.concatenate(hits)))[0])} for g, hits in by.items()]
        return pa.Table.from_pylist(rows, schema=_ANSWER)

    return run


def _finish(level: Level):
    """A group's documents and the last answers to what is kept of each."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known, rows = _known(level, answers), []
        for doc, text in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True):
            words = _words(text)
            starts = np.flatnonzero(known.among(level.keys(_WORDS.hashes(words)))) if len(known) and len(words) >= level.length else ()
            kept = words
            if len(starts):
                gone = np.zeros(len(words) + 1, np.int64)
                gone[starts] += 1  # starts are distinct, and so are ends
                gone[starts + level.length] -= 1
                kept = list(compress(words, (np.cumsum(gone[:-1]) == 0).tolist()))
            rows.append({"doc_id": doc, "text": b" ".join(kept).decode(), "n_words": len(words), "n_removed": len(words) - len(kept)})
        return pa.Table.from_pylist(rows, schema=_OUT)

    return run


def remove_repeats(docs: DataFrame, window: int = 35, first: int = 18, group_bytes: int = 8 << 20,
                   bucket_windows: int = 4_000_000, part_windows: int = 1_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_words, n_removed``: the kept words joined by one space.

    ``group_bytes``: texts of a group; ``bucket_windows``: windows counted in
    one bucket; ``part_windows``: windows held before a part is sent. All
    three bound a task's memory and change no result.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    words = max(1, size // 4)  # an upper figure for the numbers of groups, buckets and bits only
    groups, buckets = max(1, -(-size // group_bytes)), max(1, -(-words // bucket_windows))
    bits = min(64, max(24, words.bit_length() + 7))  # under one false candidate in a hundred windows
    texts = (pick(docs, id_col, text_col).toDF("doc_id", "text")
             .withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))
             .select("grp", "doc_id", "text").repartition("grp"))
    by_group, before, answers = texts.groupBy("grp"), None, None
    for length in ladder(window, first):
        level = Level(length, length == window, buckets, bits)
        if before is None:
            parts = texts.mapInArrow(_first(level, part_windows), PART)
        else:
            parts = by_group.cogroup(answers.groupBy("grp")).applyInArrow(_longer(before, level, part_windows), PART)
        answers = parts.groupBy("bucket").applyInArrow(_count(level), ANSWER)
        before = level
    return by_group.cogroup(answers.groupBy("grp")).applyInArrow(_finish(level), OUT)
