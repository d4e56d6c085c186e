"""Harmonic packing of token ids into sequences of a fixed capacity.

Class ``k`` takes pieces of at most ``capacity // k`` tokens, and every bin
of class ``k`` takes exactly ``k`` pieces, so a bin is full when it has its
count: no search, no sizes to compare, and each worker fills its own bins.

Documents may be cut, so pieces are made to fit: a length that would leave
more than ``slack`` of a bin of its class empty gives up a piece of exactly
``capacity // (k + 1)`` tokens, and what is left goes on. A document of up to
``capacity`` tokens that fits its class well stays whole.

Bins a worker could not fill (fewer than ``k`` pieces of a class) are dealt
again by class and group of ``FAN`` workers, then by class and group of
groups, until one group is left: no task meets more than ``FAN`` times ``k -
1`` pieces of one class and group, however many workers there were. What is
still left is at most ``k - 1`` pieces a class (a constant, whatever the
corpus) and is laid end to end and cut at the capacity, its end at powers of
two, so the last sequence needs no padding either.

Null text: the end id alone. Repeated rows are packed each on its own; a null
``doc_id`` is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import batched, map_texts, materialize, pick
from clickvault.llm.tokens import END_ID, encoder

FAN = 16
SHARES = 4  # tasks that a round has for each group, whatever the number of shuffle partitions
COLUMNS = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


@lru_cache(maxsize=1 << 14)
def cuts(n: int, capacity: int, slack: float) -> tuple[int, ...]:
    """Piece lengths of what is left after the full sequences, largest first."""
    out = []
    while n:
        k = capacity // n
        if k * n >= (1 - slack) * capacity:
            out.append(n)
            return tuple(out)
        out.append(capacity // (k + 1))
        n -= out[-1]
    return tuple(out)


class Bins:
    """Open bins of one worker: the pieces of each class until there are ``k``."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id, self.open = capacity, first_id, defaultdict(list)

    def add(self, piece: dict) -> list[dict]:
        """The pieces of the bin that this piece completes, else nothing."""
        k = self.capacity // piece["length"]
        held = self.open[k]
        held.append(piece)
        if len(held) < k:
            return []
        del self.open[k]
        return self.close(held)

    def close(self, held: list[dict]) -> list[dict]:
        at = 0
        for p in held:
            p["sequence_id"], p["offset"] = self.next_id, at
            at += p["length"]
        self.next_id += 1
        return held

    def rest(self) -> list[dict]:
        return [p for held in self.open.values() for p in held]


def _ids(round_no: int) -> int:
    """The first of 2^32 sequence ids of this task; the eight rounds there can be have their own range."""
    return (round_no << 60) | (TaskContext.get().partitionId() << 32)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, slack: float = 1 / 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id start length doc_tokens sequence_id offset
    ids``; ``ids`` are the piece's token ids, little-endian unsigned 32-bit.

    One pass tokenizes, cuts and fills bins and is written to the shared
    staging folder; only leftover pieces (at most ``k - 1`` of each class and
    task) are shuffled, in rounds of ``FAN`` to one (16 million tasks take six).
    A round has ``SHARES`` tasks a group: a group is bounded by ``FAN`` and the
    capacity, and each task writes a file of its own.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bins = encoder(tokenizer), Bins(capacity, _ids(0))
        end = np.asarray([END_ID], "<u4")

        def rows():
            for batch in batches:
                ids_of, texts = (batch.column(batch.schema.get_field_index(c)) for c in (id_col, text_col))
                for doc, own in zip(ids_of.to_pylist(), enc.each(texts), strict=True):
                    ids = np.concatenate([own, end], dtype="<u4")
                    n, at = len(ids), 0
                    for length in (*[capacity] * (n // capacity), *cuts(n % capacity, capacity, slack)):
                        yield from bins.add({"doc_id": doc, "start": at, "length": length, "doc_tokens": n,
                                             "ids": ids[at:at + length].tobytes()})
                        at += length
            # a piece that is left carries its worker in place of an offset
            worker = TaskContext.get().partitionId()
            yield from (p | {"sequence_id": None, "offset": worker} for p in bins.rest())

        yield from batched(rows(), _SCHEMA, weigh="ids")

    def again(round_no: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = Bins(capacity, _ids(round_no))

            def rows():
                for batch in batches:
                    for p in batch.to_pylist():
                        yield from bins.add(p | {"group": p["offset"] // FAN})
                yield from (p | {"sequence_id": None, "offset": p["group"]} for p in bins.rest())

            yield from batched(rows(), _SCHEMA, weigh="ids")

        return run

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [p for batch in batches for p in batch.to_pylist()]
        total, seq, at = sum(p["length"] for p in pieces), _ids(7), 0
        sizes = [capacity] * (total // capacity) + [1 << b for b in reversed(range(capacity.bit_length()))
                                                    if total % capacity >> b & 1]
        size = iter(sizes)
        room = next(size, 0)

        def rows():
            nonlocal seq, at, room
            for p in pieces:
                done = 0
                while done < p["length"]:
                    n = min(room - at, p["length"] - done)
                    yield p | {"start": p["start"] + done, "length": n, "sequence_id": seq, "offset": at,
                               "ids": p["ids"][4 * done:4 * (done + n)]}
                    done, at = done + n, at + n
                    if at == room:
                        seq, at, room = seq + 1, 0, next(size, 0)

        yield from batched(rows(), _SCHEMA, weigh="ids")

    packed = materialize(map_texts(pick(docs, id_col, text_col), first, COLUMNS), "packing-bins")
    order = ["doc_id", "start", "length", "ids"]  # the same rows meet in the same order when a task runs again
    done, now, round_no = [packed], packed, 0
    groups = (packed.filter("sequence_id IS NULL").agg(F.max("offset")).first()[0] or 0) + 1
    while round_no == 0 or groups > 1:
        round_no, groups = round_no + 1, -(-groups // FAN)
        left = now.filter("sequence_id IS NULL")
        dealt = left.repartition(F.floor(F.lit(capacity) / F.col("length")), F.floor(F.col("offset") / FAN)).coalesce(SHARES * groups)
        now = materialize(dealt.sortWithinPartitions("length", *order).mapInArrow(again(round_no), COLUMNS), "packing-shared")
        done.append(now)
    # fewer than k pieces of each class: bounded by the capacity, not by the corpus
    rest = now.filter("sequence_id IS NULL").repartition(1).sortWithinPartitions("length", *order).mapInArrow(last, COLUMNS)
    return reduce(DataFrame.unionByName, [*[d.filter("sequence_id IS NOT NULL") for d in done], rest])
