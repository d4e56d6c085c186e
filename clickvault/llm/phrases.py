"""Phrase collocations by Toivonen's sampling method.

Texts (A-Z lower-cased) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, pieces
at spaces and tabs into words; everything is counted per language (null:
``und``). A phrase is 2 to ``longest`` words of one piece; frequent means at
least ``least`` places.

1. One pass counts all words exactly; the frequent ones are the seed.
2. A sample of the documents (``fraction``, by a hash of id and text) is mined
   at a lowered bound; what it finds is the proposal. The
   sample only steers: nothing of its counts is reported.
3. One full pass counts proposal and negative border together: every phrase
   of the corpus whose two parts (all but the last word, all but the first)
   are both proposed or frequent words. A border phrase that does not occur
   needs no count, so the border is met in the texts, never listed.
4. A border phrase that turns out frequent may have frequent phrases above it
   that were not counted: an expansion pass counts all phrases that hold one.
   Then all frequent phrases are known, exactly, whatever the sample held
   (:func:`close` says why one such pass closes).

Words and phrases are 64-bit hashes while they are counted (numpy over whole
batches: no Python per word); a phrase's key is the pair (hash of all but the
last word, hash of the last word), 128 bits, and texts are put together at the
end from the words. Words of equal hash would show in the word table: then
another seed is taken. The known phrases travel as a bit table of at most
``2 ** bits`` bits (16 MB), put together on executors; it may let in others, which costs a count and changes nothing, so its size is bounded
whatever the corpus holds.

At scale: a pass reads texts once, counts within batches before anything is
shuffled, and sends one row per distinct phrase of a batch; every pass ends in
a written table. A language, source or phrase of a third of all places is one
row a batch. Ranking takes the best of ``SALTS`` shares of a language before
they meet.

Null texts are empty, null ids and repeated rows count as rows. A table
without a candidate gives no rows. Counts are 64-bit, scores are computed in
38-digit decimals and floored by integer division.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import materialize, pick
from clickvault.plans.materialize import small_side

WINDOW = 1 << 18  # bytes looked at together; a longer word widens it
FLUSH = 1 << 17  # words whose phrases are counted together
SALTS = 64
SPARSE = 256  # bits of the table for a hash known at the start
_SPREAD, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_CLASS = np.zeros(256, np.uint8)  # 0 word, 1 between words, 2 between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """64 bits stirred, one to one."""
    h = (h ^ (h >> np.uint64(32))) * _FOLD
    h = (h ^ (h >> np.uint64(29))) * _SPREAD
    return h ^ (h >> np.uint64(32))


def joined(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word and that of the last."""
    return mixed(head * _SPREAD + last)


class Hasher:
    """Word hashes by prefix sums: a word's bytes times powers of an odd base, moved back to the power 0."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.byte = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(0, 1 << 61)) * 8 + 5
        self.size = 0

    def _powers(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, WINDOW + 1)
            ratio = np.full(self.size, self.base, np.uint64)
            ratio[0] = 1
            self.up = np.cumprod(ratio, dtype=np.uint64)
            ratio[1:] = pow(self.base, -1, 1 << 64)
            self.down = np.cumprod(ratio, dtype=np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.byte[data] * self.up[:len(data)], dtype=np.uint64)])
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, each text's start (and the end of the last), each text's language hash."""
    col = batch.column(0)
    wide = pa.types.is_large_string(col.type)
    col = col.cast(pa.large_binary() if wide else pa.binary())  # the bytes themselves, no copy
    col = col.fill_null(b"") if col.null_count else col
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    held = col.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]] if len(offsets) else data[:0]
    return data, offsets - offsets[0], np.asarray(batch.column(1)).view(np.uint64)


def _windows(batch: pa.RecordBatch, hasher: Hasher) -> Iterator[tuple]:
    """Per window of about ``WINDOW`` bytes: lower-cased bytes, word starts and
    ends, word hashes (language included), piece numbers within the window,
    whether its first word goes on in the piece of the word before, rows."""
    data, offsets, langs = _texts(batch)
    first_of = np.zeros(len(data) + 1, bool)
    first_of[offsets] = True
    at = 0
    while at < len(data):
        end = min(at + WINDOW, len(data))
        while end < len(data) and not first_of[end] and _CLASS[data[end]] == 0:
            nearby = np.flatnonzero((_CLASS[data[end:end + WINDOW]] > 0) | first_of[end:end + WINDOW][:len(data) - end])
            end = end + int(nearby[0]) if len(nearby) else min(end + WINDOW, len(data))
        part, new_text = _LOWER[data[at:end]], first_of[at:end]
        kind = _CLASS[part]
        word = kind == 0
        before = np.concatenate([[False], word[:-1]])
        starts = np.flatnonzero(word & (~before | new_text))
        after = np.concatenate([~word[1:] | new_text[1:], [True]])
        ends = np.flatnonzero(word & after) + 1
        piece = np.cumsum((kind == 2) | new_text)[starts]
        row = np.searchsorted(offsets, at + starts, side="right") - 1
        yield part, starts, ends, mixed(hasher.words(part, starts, ends) ^ langs[row]), piece, int(np.count_nonzero((kind == 2) | new_text)), row
        at = end


def _count_words(seed: int):
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            langs = batch.column(2)
            for part, starts, ends, h, _, _, row in _windows(batch, hasher):
                if len(h):
                    own, first, n = np.unique(h, return_index=True, return_counts=True)
                    raw = part.tobytes()
                    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([langs.take(pa.array(row[first])), pa.array(words, pa.binary()),
                                                      pa.array(own.view(np.int64)), pa.array(n)], schema=schema)

    return run


def _in(table: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = h >> np.uint64(64 - bits)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def phrases_in(h: np.ndarray, piece: np.ndarray, starts: int, known, new, bits: int, longest: int, deep: bool) -> Iterator[tuple]:
    """``(words, heads, lasts)`` of the phrases that begin at the first
    ``starts`` words and have both parts known or, ``deep``, of those that
    have all pairs of neighbouring words known and hold a new phrase."""
    whole = h  # hash of the phrase of n - 1 words that begins here
    ok, held = np.ones(len(h), bool), np.zeros(len(h), bool)
    for n in range(2, longest + 1):
        if len(h) < n:
            return
        if deep and n > 2:
            held = held | _in(new, whole, bits)
        if not deep or n <= 3:
            ok = ok & _in(known, whole, bits)
        ok = ok[:-1] & ok[1:] & (piece[:-(n - 1)] == piece[n - 1:])
        held = held[:-1] | held[1:]
        at = np.flatnonzero((ok & held if deep else ok)[:starts])
        if len(at):
            yield n, whole[at], h[at + n - 1]
        if not ok.any():
            return
        whole = joined(whole[:-1], h[n - 1:])


def _count_phrases(seed: int, longest: int, bits: int, known, new=None, wanted=None, coarse: bool = False):
    """Task function: counts of the phrases that :func:`phrases_in` names;
    ``wanted``: only those whose bit is set there; ``coarse``: counted by the
    first 48 bits of their hash alone."""
    key_schema = [] if coarse else [("head", pa.int64()), ("last", pa.int64()), ("words", pa.int8())]
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int32())] if coarse else [*key_schema, ("n", pa.int64())])

    def counted(h, piece, starts):
        found = list(phrases_in(h, piece, starts, known.value, new and new.value, bits, longest, new is not None))
        if not found:
            return
        heads, lasts = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        key = joined(heads, lasts)
        if coarse:
            bucket, n = np.unique(key >> np.uint64(16), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(n.astype(np.int32))], schema=schema)
            return
        words = np.concatenate([np.full(len(f[1]), f[0], np.int8) for f in found])
        if wanted is not None:
            keep = np.flatnonzero(_in(wanted.value, key, bits))
            key, heads, lasts, words = key[keep], heads[keep], lasts[keep], words[keep]
        order = np.argsort(key, kind="stable")
        key, heads, lasts, words = key[order], heads[order], lasts[order], words[order]
        # runs of equal phrases: the whole key (head and last) decides
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (heads[1:] != heads[:-1]) | (lasts[1:] != lasts[:-1])])[:len(key)])
        n = np.diff(np.concatenate([edge, [len(key)]]))
        yield pa.RecordBatch.from_arrays([pa.array(heads[edge].view(np.int64)), pa.array(lasts[edge].view(np.int64)),
                                          pa.array(words[edge]), pa.array(n)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        held_h, held_piece, held, pieces = [], [], 0, 0
        for batch in batches:
            for _, _, _, h, piece, n_pieces, _ in _windows(batch, hasher):
                held_h.append(h)
                held_piece.append(piece + pieces)
                pieces, held = pieces + n_pieces, held + len(h)
                if held >= FLUSH:
                    h, piece = np.concatenate(held_h), np.concatenate(held_piece)
                    yield from counted(h, piece, len(h) - (longest - 1))
                    held_h, held_piece, held = [h[-(longest - 1):]], [piece[-(longest - 1):]], longest - 1
        if held:
            yield from counted(np.concatenate(held_h), np.concatenate(held_piece), held)

    return run


def _keyed(rows: DataFrame, table, bits: int) -> DataFrame:
    """Adds ``h``, the phrase's own hash, and ``fresh``: its bit is not set."""
    schema = pa.schema([("head", pa.int64()), ("last", pa.int64()), ("words", pa.int8()), ("n", pa.int64()), ("h", pa.int64()), ("fresh", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, last = (np.asarray(batch.column(i)).view(np.uint64) for i in (0, 1))
            h = joined(head, last)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.view(np.int64)), pa.array(~_in(table.value, h, bits))], schema=schema)

    return rows.select("head", "last", "words", "n").mapInArrow(run, "head long, last long, words byte, n long, h long, fresh boolean")


def bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """A table of ``2 ** bits`` bits with that of the first ``bits`` bits of
    each ``h`` set. Executors put 64 bits together, so the driver gets the
    table's size at most, whatever the number of rows."""
    at = F.shiftrightunsigned("h", 64 - bits)
    mask = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    rows = hashes.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), mask.alias("mask"))
    got = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(max((1 << bits) // 64, 1), np.int64)
    table[np.asarray(got.column("word"), np.int64)] = np.asarray(got.column("mask"), np.int64)
    return table.view(np.uint8)


def close(texts: DataFrame, known: DataFrame, least: int, longest: int, seed: int, bits: int, name: str, sieve: bool = False) -> DataFrame:
    """All phrases of ``texts`` with at least ``least`` places. ``known``:
    hashes ``h`` taken for frequent at the start, words included.

    The first pass counts all phrases with both parts known: the known ones
    and their border. If a frequent one was not known, a second pass counts
    the phrases that hold such a one and whose pairs of neighbouring words
    are all known. That closes: of a frequent phrase not counted at first take
    the shortest frequent part that was not known; its own parts were, so it
    was counted and is new, and all pairs of frequent words were counted.

    Known is what has its bit set in a table of ``SPARSE`` bits a hash,
    ``2 ** bits`` at most; whatever a set bit lets in besides is counted too,
    so the end is the same with any table. ``sieve``: the first pass, which
    meets most distinct phrases, first counts by 48 bits alone (fewer bytes
    to shuffle) and then exactly those whose bits came to ``least``.
    """
    spark = texts.sparkSession
    size = min(bits, max(6, (known.count() * SPARSE).bit_length()))
    table = bit_table(known, size)

    def share(bits_set):
        return spark.sparkContext.broadcast(bits_set)

    def count(**how):
        rows = texts.mapInArrow(_count_phrases(seed, longest, size, **how), "head long, last long, words byte, n long")
        rows = rows.groupBy("head", "last", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return materialize(_keyed(rows, how["known"], size), name)

    shared = {"known": share(table)}
    if sieve:
        rough = texts.mapInArrow(_count_phrases(seed, longest, size, **shared, coarse=True), "bucket long, n int")
        rough = rough.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        rough = materialize(rough.select(F.shiftleft("bucket", 16).alias("h")), f"{name}-rough")
        shared["wanted"] = share(bit_table(rough, size))
    found = count(**shared)
    new = bit_table(found.filter("fresh"), size)
    if new.any():
        more = {"known": share(table | new), "new": share(new)}
        found = found.unionByName(count(**more)).drop("fresh").dropDuplicates(["head", "last", "words"])
        shared |= {f"{k}-2": v for k, v in more.items()}
    for s in shared.values():
        s.destroy()
    return found


def _spelled(found: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """``lang phrase words n``: texts put together from the words, a word at a time."""
    last = words.select(F.col("h").alias("last"), F.col("word").alias("last_word"))
    below = words.select(F.col("h").alias("head"), "lang", F.col("word").alias("head_text"))
    levels = []
    for n in range(2, longest + 1):
        own = found.filter(F.col("words") == n).drop("words")
        own = materialize(own.join(below, "head").join(last, "last")
                          .select("lang", F.concat_ws(" ", "head_text", "last_word").alias("phrase"), F.lit(n).alias("words"), "n", "h"), f"phrases-{n}")
        below = own.select(F.col("h").alias("head"), "lang", F.col("phrase").alias("head_text"))
        levels.append(own.drop("h"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def score(phrases: DataFrame, singles: DataFrame, totals: DataFrame, share: int) -> DataFrame:
    """``lang phrase a l r n score`` of the phrases that no longer one covers."""
    words = F.split("phrase", " ", -1)
    counts = phrases.select("lang", "phrase", F.col("n").alias("f")).unionByName(singles.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("first"),
                       _part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        side, _ = small_side(counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), "phrase-counts")
        cuts = cuts.join(side, ["lang", part])
    side, _ = small_side(totals, "lang-words")
    big = "CAST({} AS DECIMAL(38, 0))".format
    cuts = cuts.join(side, "lang").withColumn("score", F.expr(f"CAST(({big('1000')} * a * n) div ({big('l')} * r) AS LONG)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")

    inner = phrases.filter("words > 2").select("lang", "n", "words", words.alias("w"))
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.groupBy("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase")).agg(F.max("n").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100, fraction: float = 1 / 8,
                 bits: int = 27, seed: int = 12, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang rank phrase a l r n score``: each language's first ``top``
    candidates that no longer candidate covers to ``share`` percent."""
    docs = pick(docs, id_col, text_col, lang_col).toDF("doc_id", "text", "lang")
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    texts = docs.select("text", F.xxhash64(lang).alias("lang_hash"), lang.alias("lang"))
    for attempt in range(8):
        counts = texts.mapInArrow(_count_words(seed + attempt), "lang string, word binary, h long, n long")
        counts = materialize(counts.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
        frequent = materialize(counts.filter(F.col("n") >= least).withColumn("word", F.col("word").cast("string")), "phrase-frequent")
        if frequent.groupBy("h").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("words of equal hash under every seed")
    seed += attempt
    totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words, sampled = frequent.select("h"), F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 20)) < int(fraction * (1 << 20))
    lowered = max(2, int(least * fraction / 3))
    sample = materialize(docs.filter(sampled).select("text", F.xxhash64(lang).alias("lang_hash"), lang.alias("lang")), "phrase-sampled")
    proposal = close(sample, words, lowered, longest, seed, bits, "phrase-sample")
    found = close(texts, materialize(words.unionByName(proposal.select("h")), "phrase-known"), least, longest, seed, bits, "phrase-full", sieve=True)
    phrases = materialize(_spelled(found, frequent, longest), "phrase-texts")
    kept = score(phrases, frequent, totals, share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 100, longest: int = 5, top: int = 2000, share: int = 100) -> str:
    """The same in DuckDB: every phrase of the corpus counted, no sample."""
    place = " UNION ALL ".join(f"SELECT lang, {n} AS words, array_to_string(w[i:i + {n - 1}], ' ') AS phrase FROM places WHERE i + {n - 1} <= len(w)"
                               for n in range(1, longest + 1))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
f AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS n FROM ({place}) GROUP BY ALL HAVING count(*) >= {least}),
totals AS (SELECT lang, sum(len(w)) AS n FROM ws GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
cuts AS (
  SELECT c.lang, c.phrase, k, c.n AS a, l.n AS l, r.n AS r, t.n AS n,
         (1000::HUGEINT * c.n * t.n) // (l.n::HUGEINT * r.n) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(n) AS longer
  FROM (SELECT *, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM c)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN inner_ i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {share} * a
QUALIFY rank <= {top}
"""
