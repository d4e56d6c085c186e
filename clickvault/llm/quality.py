"""Quality rules: robust multivariate outliers per language and source.

Fixed rules first: fewer than 50 words, or more than half of the words in
three-word windows that occur twice or more, fails.

The method: each text's statistics become a vector (log word length, log of
one and the symbols a word, shares of repeated lines and words). For each
language and source, each language, and all texts, a minimum covariance
determinant is searched over all texts that pass the fixed rules: three
deterministic starts (the medians and the two quartiles, with the absolute
deviations around them) make two concentration steps, the start of least
determinant goes on until its determinant falls no more. A step keeps the
three quarters of the texts nearest to the centre and takes their mean and
covariance anew, so the outliers do not shape what they are measured by. A
text whose Mahalanobis distance lies beyond the chi-square quantile is
rejected.

One rule for groups of every size: an estimate from ``n`` texts is pooled with
that of its language as if the latter were ``prior`` texts more (means,
covariances and what lies between the means), and a language's in the same way
with that of all texts.

Scale: a step is one aggregation. Rows are counted and summed per group, start
and bin of squared distance (map-side combined: at most ``BINS`` rows each and
task), and the three quarters are cut at a bin, so a hot source is never
gathered and the result does not depend on the partitions. What is computed
per group has ``BINS`` rows at most. Every step that is followed by another
lowers a determinant by a thousandth or more, and none can fall below that of
the floors, so the steps end.

If no text passes the fixed rules nothing is judged further. Null language or
source is a value of its own. Null text: no words, so it fails. Repeated rows count each.
Deviations below a floor are taken as the floor, so a statistic that is the
same in nearly all texts does not reject by itself on a trifle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import columns_of, materialize, pick
from clickvault.plans.materialize import small_side

STATS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
X = ["x1", "x2", "x3", "x4"]
#: Deviations that count as the least: 5 % of word length, and so on.
FLOORS = [0.05, 0.06, 0.1, 0.1]
BINS = 400
_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def text_stats(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a whole text in UTF-8."""
    words = text.split()
    chars = sum(map(len, words))
    if not text.isascii():
        chars -= sum(1 for w in words if not w.isascii() for b in w if b & 0xC0 == 0x80)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    repeat = 0
    if len(words) > 3 and len(ids) < len(words):
        n = len(ids) + 1
        if n < 2_000_000:
            keys = (seq[:-2] * n + seq[1:-1]) * n + seq[2:]
            _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        else:  # three ids do not fit one number
            _, which, times = np.unique(np.stack([seq[:-2], seq[1:-1], seq[2:]], 1), axis=0, return_inverse=True, return_counts=True)
        at = np.flatnonzero(times[which.reshape(-1)] > 1)
        cover = np.zeros(len(words), bool)
        for i in range(3):
            cover[at + i] = True
        repeat = int(cover.sum())
    return len(words), chars, len(_SYMBOLS.findall(text)), len(lines), len(lines) - len(set(lines)), repeat


def statistics(docs: DataFrame) -> DataFrame:
    """``STATS`` of every row, in one pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()),
                        *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = columns_of(batch, "text")
            got = np.array([text_stats(t or b"") for t in texts], np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("source"),
                                              *(pa.array(got[:, i]) for i in range(6))], schema=schema)

    return pick(docs, "doc_id", "lang", "source", "text").mapInArrow(run, STATS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector(df: DataFrame) -> DataFrame:
    """The transformed statistics; rounded, so sums do not depend on their order in any digit that counts."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns({
        "x1": F.round(F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), 9),
        "x2": F.round(F.log(1 + F.col("n_symbols") / n), 9),
        "x3": F.round(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 9),
        "x4": F.round(F.col("n_repeat_words") / n, 9)})


def group_keys() -> list[Column]:
    """The groups of a row: language and source, language, all; null is a value, and no two keys meet."""
    key = lambda *c: F.to_json(F.array(*[F.col(x) for x in c]), {"ignoreNullFields": "false"})
    return [key("lang", "source"), key("lang"), F.lit("[]")]


def chi2_4(p: float) -> float:
    """The quantile of chi-square with 4 degrees of freedom."""
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - math.exp(-mid / 2) * (1 + mid / 2) < p else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal vectors is short of (4 dimensions)."""
    q = chi2_4(share) / 2
    return share / (1 - math.exp(-q) * (1 + q + q * q / 2))


PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]
_NUMBERS = [*(f"m{i}" for i in range(4)), *(f"c{i}{j}" for i, j in PAIRS), *(f"p{i}{j}" for i, j in PAIRS), "det"]
PARAMS = "grp string, start int, n long, " + ", ".join(f"{c} double" for c in _NUMBERS)


def _params(grp: str, start: int, n: int, mean: np.ndarray, cov: np.ndarray) -> dict:
    """Centre, covariance, its inverse and determinant, the two with the floors."""
    floored = cov + np.diag(np.square(FLOORS))
    inv = np.linalg.inv(floored)
    return ({"grp": grp, "start": start, "n": n, "det": float(np.linalg.det(floored))} | {f"m{i}": float(mean[i]) for i in range(4)}
            | {f"c{i}{j}": float(cov[i, j]) for i, j in PAIRS} | {f"p{i}{j}": float(inv[i, j]) for i, j in PAIRS})


def _moments(row: dict, prefix: str = "") -> tuple[int, np.ndarray, np.ndarray]:
    cov = np.zeros((4, 4))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = row[f"{prefix}c{i}{j}"]
    return row[f"{prefix}n"], np.array([row[f"{prefix}m{i}"] for i in range(4)]), cov


def pooled(own: tuple, parent: tuple, prior: float) -> tuple[int, np.ndarray, np.ndarray]:
    """``own`` (n, mean, covariance) with ``prior`` texts that are as ``parent`` says."""
    (n, mean, cov), (_, up, up_cov) = own, parent
    w, off = prior / (n + prior), mean - up
    return n, mean - w * off, (1 - w) * cov + w * up_cov + w * (1 - w) * np.outer(off, off)


def distance2() -> Column:
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    terms = [d[i] * d[j] * F.col(f"p{i}{j}") * (1 if i == j else 2) for i, j in PAIRS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _start(rows: DataFrame) -> DataFrame:
    """The starts of each group: medians and quartiles with the absolute deviations around them, from counts per value to three digits."""
    def of_group(table: pa.Table) -> pa.Table:
        which, value, n = (table.column(c).to_numpy() for c in ("which", "value", "n"))
        out = []
        for start, share in enumerate((0.5, 0.25, 0.75)):
            mean, dev = np.zeros(4), np.zeros(4)
            for i in range(4):
                v, w = value[which == i], n[which == i]
                order = np.argsort(v)
                v, w = v[order], w[order]
                mean[i] = v[np.searchsorted(np.cumsum(w), w.sum() * share)]
                off = np.abs(v - mean[i])
                order = np.argsort(off, kind="stable")
                dev[i] = off[order][np.searchsorted(np.cumsum(w[order]), w.sum() / 2)]
            out.append(_params(table.column("grp")[0].as_py(), start, int(n[which == 0].sum()), mean / 1000, np.diag(np.square(1.4826 * dev / 1000))))
        return pa.Table.from_pylist(out, schema=_PA)

    # a value is one of a few thousand (shares and lengths to three digits), so a group's counts are bounded
    long = rows.select("grp", F.posexplode(F.array(*[F.round(F.col(x) * 1000).cast("long") for x in X])).alias("which", "value"))
    counts = long.groupBy("grp", "which", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("grp").applyInArrow(of_group, PARAMS)


def _step(rows: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """One concentration step."""
    factor = consistency(share)

    def of_group(table: pa.Table) -> pa.Table:
        t = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("grp", "start")}
        order = np.argsort(t["bin"])
        n = t["n"][order]
        last = np.searchsorted(np.cumsum(n), math.ceil(share * n.sum()))
        at = order[:last + 1]
        m = t["n"][at].sum()
        mean = np.array([t[f"s{i}"][at].sum() for i in range(4)]) / m
        cov = np.zeros((4, 4))
        for i in range(4):
            for j in range(i, 4):
                cov[i, j] = cov[j, i] = t[f"q{i}{j}"][at].sum() / m - mean[i] * mean[j]
        return pa.Table.from_pylist([_params(table.column("grp")[0].as_py(), table.column("start")[0].as_py(), int(n.sum()), mean, cov * factor)], schema=_PA)

    with_bin = rows.join(params.drop("n"), "grp").withColumn("bin", F.least(F.greatest(F.floor(20 * F.log(distance2() + 1e-6)), F.lit(-BINS // 2)), F.lit(BINS // 2)))
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    sums += [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in PAIRS]
    binned = with_bin.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *sums)
    return binned.groupBy("grp", "start").applyInArrow(of_group, PARAMS)


_PA = pa.schema([("grp", pa.string()), ("start", pa.int32()), ("n", pa.int64()), *((c, pa.float64()) for c in _NUMBERS)])


def estimate(used: DataFrame, share: float = 0.75) -> DataFrame:
    """``PARAMS`` of each ``grp`` of the rows (``grp`` and ``X``): the least determinant that the starts lead to."""
    best = lambda df, *by: (df.withColumn("r", F.struct("det", *[c for c in df.columns if c not in ("det", *by)]))
                            .groupBy(*by).agg(F.min("r").alias("r")).select(*by, "r.*"))
    params = materialize(_start(used), "quality-params")  # written: a step's plan never holds the steps before it
    for _ in range(2):  # a start is no covariance of rows: its determinant is not compared
        params = materialize(_step(used, params, share), "quality-params")
    params = materialize(best(params, "grp"), "quality-params")
    while True:
        nxt = _step(used, params, share).select("grp", F.struct("det", *[c for c in params.columns if c not in ("grp", "det")]).alias("new"))
        both = params.select("grp", F.struct("det", *[c for c in params.columns if c not in ("grp", "det")]).alias("old")).join(nxt, "grp")
        falls = F.col("new.det") < 0.999 * F.col("old.det")
        both = materialize(both.select("grp", falls.alias("falls"), F.when(falls, F.col("new")).otherwise(F.col("old")).alias("r")), "quality-params")
        params = both.select("grp", "r.*")
        if both.filter("falls").limit(1).count() == 0:
            return params


def _pool(prior: float):
    """Rows with own, language's and all texts' moments (``o_ l_ a_``) to the pooled estimate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("l", pa.string()), ("s", pa.string()), *((c, pa.float64()) for c in _NUMBERS)])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                up = _moments(row, "a_")
                for level in ("l_", "o_"):
                    if row[f"{level}n"]:
                        up = pooled(_moments(row, level), up, prior)
                out.append(_params("", 0, *up) | {"l": row["l"], "s": row["s"]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def judge(docs: DataFrame, share: float = 0.75, prior: float = 60.0, quantile: float = 0.9999) -> DataFrame:
    """``STATS`` of every row with ``base_failed``, ``distance`` (null: no text to judge by) and ``kept``."""
    rows = materialize(vector(statistics(docs)).withColumn("base_failed", base_failed()), "quality-stats")
    used = rows.filter("NOT base_failed").select(F.explode(F.array(*group_keys())).alias("grp"), *X)
    params = estimate(used, share)
    groups = rows.select("lang", "source").distinct().select(F.col("lang").alias("l"), F.col("source").alias("s"),
                                                             *[k.alias(f"{x}grp") for x, k in zip(("o_", "l_", "a_"), group_keys(), strict=True)])
    for x, how in (("o_", "left"), ("l_", "left"), ("a_", "inner")):
        groups = groups.join(params.select(*[F.col(c).alias(f"{x}{c}") for c in params.columns if c[0] in "gnmc"]), f"{x}grp", how)
    side, _ = small_side(groups.mapInArrow(_pool(prior), "l string, s string, " + ", ".join(f"{c} double" for c in _NUMBERS)), "quality-pooled")
    far = F.when(F.col("m0").isNotNull(), F.sqrt(F.greatest(distance2(), F.lit(0.0))))
    out = rows.join(side, rows["lang"].eqNullSafe(F.col("l")) & rows["source"].eqNullSafe(F.col("s")), "left").withColumn("distance", F.round(far, 6))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= math.sqrt(chi2_4(quantile)), F.lit(True))
    return out.withColumn("kept", kept).select(*[x.split(" ")[0] for x in STATS.split(", ")], *X, "base_failed", "distance", "kept")
