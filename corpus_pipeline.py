"""The corpus pipeline over ``documents``: language ID, near-duplicates,
benchmark leaks, personal data, packing.

Each stage works on all that the one before it kept; its result is written as
Parquet in the shared staging folder and read again, so a lost executor costs
a stage's tasks at most. Small tables of decisions are joined back to the
documents: broadcast up to ``SMALL`` measured bytes, else by a shuffle join.

Rows are told apart by id and text, so null and repeated ids are handled row
by row; exact repeats of a row share a decision. Columns beyond those of
``documents`` are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.llm import personal
from clickvault.llm.common import fresh_path
from clickvault.llm.language import fit, label, training_rows
from clickvault.llm.leaks import decontaminate
from clickvault.llm.packing import pack
from clickvault.llm.simhash import near_duplicates
from clickvault.llm.tokens import default_tokenizer
from clickvault.plans.materialize import small_side

SMALL = 32 << 20
KEY = "_row_key"


def free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame, key: str) -> DataFrame:
    return docs.withColumn(key, F.xxhash64("doc_id", "text"))


def same(docs: DataFrame) -> list:
    """All columns of ``docs``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter, and those
    whose two best languages are about as near, go."""
    names = tuple(free(docs, n) for n in ("_lang_pred", "_lang_score", "_lang_ambiguous"))
    found = label(docs, fit(training_rows(docs)), names=names)
    return found.filter((F.col(names[0]) != "und") & ~F.col(names[2])).select(same(docs))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash component, once; texts that
    share an id count each. Rows without an id stay, once for each text."""
    key = free(docs, KEY)
    rows = keyed(docs.filter("doc_id IS NOT NULL"), key)
    found = near_duplicates(rows, id_col=key).select(F.col("doc_id").alias(key), "component_id").distinct()
    first = F.min(F.struct("doc_id", key))[key].alias(key)
    keys = rows.select("doc_id", key).distinct().join(found, key).groupBy("component_id").agg(first).select(key)
    stay, _ = small_side(keys, "pipeline-stay", SMALL)
    kept = rows.join(stay, key, "left_semi").dropDuplicates([key]).select(same(docs))
    return kept.unionByName(docs.filter("doc_id IS NULL").dropDuplicates(["text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window stands."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    key = free(docs, KEY)
    hit = decontaminate(keyed(docs, key), items, id_col=key).filter("contaminated").select(F.col("doc_id").alias(key)).distinct()
    gone, _ = small_side(hit, "pipeline-leaks", SMALL)
    return keyed(docs, key).join(gone, key, "left_anti").select(same(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; ``n_chars`` follows the text."""
    key, at = free(docs, KEY), free(docs, "_spans")
    found = personal.find(keyed(docs, key), id_col=key).filter(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias(key), F.col("spans").alias(at)).dropDuplicates([key])
    spans, _ = small_side(found, "pipeline-spans", SMALL)
    out = keyed(docs, key).join(spans, key, "left")
    out = out.withColumn("text", personal.masked(F.col("text"), F.col(at)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(at).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(same(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents, packed into sequences of 2048 tokens."""
    return pack(docs, default_tokenizer())


STAGES = [("language", language), ("near_duplicates", near_duplicate), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]
#: A trained classifier, SimHash components and tokens are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
