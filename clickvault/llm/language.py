"""Language ID by error-correcting output codes.

Each language has a codeword. One binary classifier per bit tells the
languages whose bit is 1 from the others: naive Bayes log odds of hashed
letter n-grams (1 to ``n_gram`` letters, word edges included). A text's
margins are the means over its n-grams; its language is the codeword of least
loss, each bit weighted by how well its classifier separated that language on
training texts it was not fitted on (loss-weighted decoding). Texts whose two
best codewords are about as near are flagged ambiguous.

Codewords: all ways to split up to five languages (their distance is half of
all bits); beyond, the best of some seeded random codes.

Fitting reads at most ``per_lang`` labelled texts of each language (those of
smallest hash of their id and text; whole texts), and sends hashed counts,
not texts, to the driver. Prediction is one pass without a shuffle.

Null texts and texts without a letter get ``und``, score 0. With no labelled
text at all every text gets ``und``. Repeated rows are rows. Null labels are
never learned from.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from clickvault.llm.common import columns_of, map_texts, pick
from clickvault.plans.materialize import small_side

EDGE = 1  # stands for all that is no letter
STEP = 1 << 20  # code points looked at together; bounds the memory of a long text


@lru_cache(maxsize=1)
def _letter() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def hashed_grams(text: bytes, n_gram: int, bits: int) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text's lower-cased words, word edges included, in parts."""
    code = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.where(_letter()[code], code, np.uint32(EDGE))
    code = np.concatenate([[np.uint32(EDGE)], code, [np.uint32(EDGE)]])
    for at in range(0, len(code), STEP):
        part = code[at:at + STEP + n_gram - 1]
        edge, grams, h = part == EDGE, [], np.zeros(len(part), np.uint32)
        inner = np.ones(len(part), bool)
        for n in range(1, n_gram + 1):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * np.uint32(1_000_003) + part[n - 1:]
            if n == 1:
                ok = ~edge
            elif n == 2:
                ok = ~(edge[:-1] & edge[1:])
            else:  # an edge may only be the first or the last of an n-gram
                inner = inner[:len(h)] & ~edge[n - 2:n - 2 + len(h)]
                ok = inner
            starts = np.flatnonzero(ok[:STEP])
            grams.append(((h[starts] + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))
        yield np.concatenate(grams).astype(np.int64)


def codebook(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) of -1 and 1, every column with both."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        rows = [[1, *bits] for bits in itertools.product((1, -1), repeat=n - 1)][1:]
        return np.array(rows, np.int8).T
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, length))
        if (np.abs(code.sum(axis=0, dtype=int)) == n).any():
            continue
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(gram, -length)
        if (d := (length - gram.max()) // 2) > apart:
            best, apart = code, d
    return best


@dataclass
class Model:
    """What prediction needs; a few MB, whatever the corpus."""

    langs: list[str]
    code: np.ndarray
    odds: np.ndarray       # (2^bits, code bits)
    weight: np.ndarray     # (langs, code bits), each row sums to 1
    scale: float
    n_gram: int
    bits: int
    least_gap: float

    def margins(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, code bits) mean log odds, and each text's number of n-grams."""
        total, n = np.zeros((len(texts), self.odds.shape[1])), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for grams in hashed_grams(text, self.n_gram, self.bits):
                total[i] += np.bincount(grams, minlength=len(self.odds)).astype(np.float32) @ self.odds
                n[i] += len(grams)
        return total / np.maximum(n, 1)[:, None], n

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """(texts, langs): weighted logistic loss of the margins against each codeword."""
        z = margins[:, None, :] * self.scale * self.code[None]
        return (self.weight[None] * np.logaddexp(0, -z)).sum(axis=2)

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float, bool]]:
        margins, n = self.margins([t or b"" for t in texts])
        loss = self.losses(margins)
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * self.code.shape[1])
        p /= p.sum(axis=1, keepdims=True)
        order = np.argsort(-p, axis=1, kind="stable")
        out = []
        for i in range(len(texts)):
            if n[i] == 0:
                out.append(("und", 0.0, False))
                continue
            best = order[i, 0]
            gap = p[i, best] - (p[i, order[i, 1]] if p.shape[1] > 1 else 0)
            out.append((self.langs[best], float(p[i, best]), bool(gap < self.least_gap)))
        return out


def _counts(texts: DataFrame, n_gram: int, bits: int) -> dict[tuple[str, int], np.ndarray]:
    """Hashed n-gram counts per language and fold: each task sends one vector for each."""
    schema = pa.schema([("lang", pa.string()), ("fold", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            langs, folds, (raw,) = batch.column("lang").to_pylist(), batch.column("fold").to_pylist(), columns_of(batch, "text")
            for lang, fold, text in zip(langs, folds, raw, strict=True):
                own = sum(np.bincount(g, minlength=1 << bits) for g in hashed_grams(text, n_gram, bits))
                # a text counts once whatever its length, so long texts do not drown the others
                own = own * (1000 / max(1, own.sum()))
                key = (lang, fold)
                held[key] = held.get(key, 0) + own
        for (lang, fold), c in held.items():
            yield pa.RecordBatch.from_pylist([{"lang": lang, "fold": fold, "counts": c.astype("<f8").tobytes()}], schema)

    out: dict[tuple[str, int], np.ndarray] = {}
    for r in map_texts(texts.select("lang", "fold", "text"), run, "lang string, fold int, counts binary").toLocalIterator():
        out[r["lang"], r["fold"]] = out.get((r["lang"], r["fold"]), 0) + np.frombuffer(r["counts"], "<f8")
    return out


def _odds(per_lang: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log odds of each n-gram for each bit, languages weighing the same."""
    share = (per_lang + 0.05) / (per_lang + 0.05).sum(axis=1, keepdims=True)
    cols = []
    for b in range(code.shape[1]):
        one, zero = share[code[:, b] > 0], share[code[:, b] < 0]
        cols.append(np.log(one.mean(axis=0)) - np.log(zero.mean(axis=0)) if len(one) and len(zero) else np.zeros(share.shape[1]))
    return np.stack(cols, axis=1).astype(np.float32)


def sample(labelled: DataFrame, per_lang: int) -> DataFrame:
    """At most ``per_lang`` rows (``text lang fold``) of each language, those of smallest
    hash; each task keeps its own smallest before the shuffle."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").withColumn("h", F.xxhash64("doc_id", "text"))
    ranked = rows.select("lang", "h").distinct().withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    # one limit per language, found on hashes alone; the texts are read again, not sorted
    limit = ranked.filter(F.col("r") <= per_lang).groupBy("lang").agg(F.max("h").alias("limit"))
    limit, _ = small_side(limit, "language-limits")
    kept = rows.join(limit, "lang").filter(F.col("h") <= F.col("limit"))
    return kept.dropDuplicates(["lang", "h"]).select("lang", "text", F.pmod("h", F.lit(5)).cast("int").alias("fold"))


def fit(labelled: DataFrame, per_lang: int = 400, n_gram: int = 4, bits: int = 16, least_gap: float = 0.05) -> Model:
    """A model from rows ``doc_id text lang``; ``per_lang`` (at most 1000) bounds what is read of each language."""
    rows = sample(pick(labelled, "doc_id", "text", "lang"), per_lang).persist()
    counts = _counts(rows, n_gram, bits)
    langs = sorted({lang for lang, _ in counts})
    code, zero = codebook(len(langs)), np.zeros(1 << bits)

    def summed(skip: int | None) -> np.ndarray:
        return np.array([sum((c for (g, f), c in counts.items() if g == lang and f != skip), zero) for lang in langs]).reshape(len(langs), 1 << bits)

    def model(skip: int | None, weight: np.ndarray, scale: float) -> Model:
        return Model(langs, code, _odds(summed(skip), code) if langs else np.zeros((1 << bits, code.shape[1]), np.float32), weight, scale, n_gram, bits, least_gap)

    even = np.full(code.shape, 1 / max(1, code.shape[1]))
    # margins of texts by a model that was fitted without their fold (fold 0), for weights and scale
    trial = model(0, even, 1.0)
    held = [(r["lang"], bytes(r["text"], "utf-8")) for r in rows.filter("fold = 0").toLocalIterator()]  # per_lang texts a language at most
    rows.unpersist()
    if len(langs) < 2 or not held:
        return model(None, even, 8.0)
    margins, n = trial.margins([t for _, t in held])
    of = np.array([langs.index(lang) for lang, _ in held])
    right = (margins * code[of] > 0) & (n[:, None] > 0)
    score = np.array([right[of == i].mean(axis=0) if (of == i).any() else np.full(code.shape[1], 0.5) for i in range(len(langs))])
    weight = np.maximum(score - 0.5, 0.01)
    size = np.median(np.abs(margins[n > 0])) if (n > 0).any() else 1.0
    return model(None, weight / weight.sum(axis=1, keepdims=True), float(4 / max(size, 1e-6)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row; only the text is looked at."""
    return label(pick(docs, id_col, text_col).toDF("doc_id", "text"), model).drop("text")


def label(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, ...] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """All columns of ``docs`` and the prediction under ``names``, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB: 2^bits rows of log odds
    kinds = ((0, pa.string()), (1, pa.float64()), (2, pa.bool_()))
    schema = StructType([*docs.schema.fields, *(StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType()), strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                (texts,) = columns_of(batch, text_col)
                got = shared.value.predict(texts) if shared.value.langs else [("und", 0.0, False)] * len(texts)
                cols = [*batch.columns, *(pa.array([g[i] for g in got], t) for i, t in kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *names])

    return map_texts(docs, run, schema)


def held_out(id_col: str = "doc_id"):
    """The rows that are never learned from; a null id is not one of them, nor learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out() & F.col("doc_id").isNotNull())
