"""The ``opN_*`` queries: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickvault.llm.common import fresh_path
from clickvault.llm.language import fit, held_out, identify, training_rows
from clickvault.llm.mixing import mix
from clickvault.llm import leaks, licenses, personal, phrases, vectors
from clickvault.llm.packing import pack
from clickvault.llm.quality import judge
from clickvault.llm.repeats import remove_repeats
from clickvault.llm.simhash import near_duplicates
from clickvault.llm.tokenfile import read_tokens, write_tokens
from clickvault.llm.tokens import default_tokenizer
from clickvault.llm.warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonic packing of all documents into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), default_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register("op10_warc", """
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN m.target > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.target > p.page_id THEN m.target END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
             sha1(coalesce(html, '')) AS payload_digest FROM pages) p
LEFT JOIN (SELECT html, max(page_id) AS target FROM pages WHERE strlen(html) >= 1000 GROUP BY html) m ON m.html = p.html
""")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files and read back from them."""
    out = fresh_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    return read_warc(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op2_simhash_dedup")
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 2 bits."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of repeated 35-word windows."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(training_rows(docs))).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed quality rules and robust outliers over all documents."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@register("op3_license_scan", licenses.oracle_sql())
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@register("op6_decontamination", leaks.oracle_sql())
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that stand in 10-word windows of benchmark items."""
    return leaks.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: fixed kinds, and identifiers found by context."""
    found = personal.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(personal.listed("base"), 256).alias("base_sha256"),
                        personal.listed("spans").alias("spans"))


@register("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written as coded blocks and read back from the files."""
    out = fresh_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), out, default_tokenizer())
    return read_tokens(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op11_vector_codes", vectors.oracle_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings: 4 parts, 256 entries, 4 rounds, equal-average search."""
    return vectors.encode(table(spark, sf_dir, "embeddings")).drop("label")


@register("op13_source_mix")
def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 in turn, at 150 % of all words."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "probability")


@register("op12_collocations", phrases.oracle_sql())
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
