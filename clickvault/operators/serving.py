"""Serving layer: typed serving tables, their loads and the analysis queries.

The analysis queries exist in two equivalent forms: Spark SQL text over
temp views / catalog tables (``SERVING_SQL``) and DataFrame functions.
``TOP n`` becomes ``LIMIT n`` (a top-k: Spark plans TakeOrderedAndProject,
each task keeps n rows); every ORDER BY ends with the key so ties are
deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickvault.schemas import SERVING

SERVING_TABLES = tuple(SERVING)

SERVING_SQL = {
    "sql_top_engagement":
        "SELECT * FROM customer_engagement ORDER BY engagement_score DESC, user_id LIMIT 20",
    "sql_funnel": "SELECT * FROM conversion_funnel",
    "sql_top_abandonment":
        "SELECT * FROM cart_abandonment ORDER BY abandonment_rate_pct DESC, category_code LIMIT 20",
    "sql_top_revenue":
        "SELECT * FROM category_performance ORDER BY purchase_revenue DESC, category_code LIMIT 20",
    "sql_total_revenue":
        "SELECT SUM(purchase_revenue) AS total_purchase_revenue FROM category_performance",
    "sql_top_conversion":
        "SELECT category_code, views, purchases, purchase_conversion_rate_pct "
        "FROM category_performance WHERE views >= 10 "
        "ORDER BY purchase_conversion_rate_pct DESC, category_code LIMIT 10",
}


def top_engagement(engagement: DataFrame, n: int = 20) -> DataFrame:
    return engagement.orderBy(F.desc("engagement_score"), "user_id").limit(n)


def top_abandonment(abandonment: DataFrame, n: int = 20) -> DataFrame:
    return abandonment.orderBy(F.desc("abandonment_rate_pct"), "category_code").limit(n)


def top_revenue(category: DataFrame, n: int = 20) -> DataFrame:
    return category.orderBy(F.desc("purchase_revenue"), "category_code").limit(n)


def total_revenue(category: DataFrame) -> DataFrame:
    return category.agg(F.sum("purchase_revenue").alias("total_purchase_revenue"))


def top_conversion(category: DataFrame, n: int = 10, min_views: int = 10) -> DataFrame:
    return (category.filter(F.col("views") >= min_views)
            .orderBy(F.desc("purchase_conversion_rate_pct"), "category_code").limit(n)
            .select("category_code", "views", "purchases", "purchase_conversion_rate_pct"))


def to_serving(df: DataFrame, table: str) -> DataFrame:
    """Cast a Gold frame to the serving table's column types and order."""
    schema = SERVING[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> SQL NULL in every floating column before a load."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType))
                        .otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def serving_load(df: DataFrame, table: str, name: str | None = None, path: str | None = None,
                 jdbc: dict | None = None) -> None:
    """Full refresh of one serving table.

    ``table`` names the serving schema, ``name`` the target (default: same).
    Catalog table (external when ``path`` is given) by default; with ``jdbc``
    options the same frame goes through Spark's JDBC writer with
    ``truncate=true`` (parallel batched inserts, one connection per task).
    """
    out = nan_to_null(to_serving(df, table))
    name = name or table
    if jdbc:
        (out.write.format("jdbc").options(**jdbc).option("dbtable", name)
         .option("truncate", "true").mode("overwrite").save())
        return
    writer = out.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def serving_row_counts(spark: SparkSession, tables: tuple[str, ...] = SERVING_TABLES) -> DataFrame:
    """(table, row_count) for each serving table present in the catalog."""
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table"), "row_count")
             for t in tables if spark.catalog.tableExists(t)]
    return reduce(DataFrame.unionByName, parts)
