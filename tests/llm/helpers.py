"""Hard inputs shared by the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, langs=None, sources=None, extra=True):
    """A documents table; ``extra`` adds columns whose names operators use inside."""
    rows = [(i, t, (langs or {}).get(i, "en"), (sources or {}).get(i, "src0"), None if t is None else len(t))
            for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F
        for name in ("ids", "fp", "pos", "hash", "start", "length", "key", "mask", "component", "words", "n_words", "item_id"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng: random.Random, n: int, vocab: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocab):x}q" for _ in range(n))


ODD = [None, "", " \t\n\x0b\x0c\r", "One", "one two", "ünï çödé  \x00 x\x1cy\x85z", "a" * 5000, "!!! ??? ###", "日本語 テスト 文章 です"]
