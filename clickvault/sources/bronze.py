"""Bronze event CSV reader.

* quoting is standard CSV: a quote inside a quoted field is doubled (fields
  with line breaks need ``multi_line``, which makes files unsplittable);
* every file must have the columns of the first one in the same order; a
  file that has not makes the read fail instead of shifting its values;
* column names come from the header, read on the driver (no inference
  job; every column is text, the cleaning step parses); the nine required
  columns are checked before any data job, extra columns are ignored;
* the missing-value spellings pandas' CSV reader treats as NA become null
  (Spark's CSV reader only nulls empty fields);
* ``source_row_number`` counts data rows in file order from 2 (row 1 is the
  header), across files in path order, without a global sort: each
  input split's rows are numbered locally and shifted by the rows of all
  earlier splits (one small row per split).
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickvault.plans.materialize import small_side
from clickvault.schemas import RAW_COLUMNS

# The strings pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row


def require_columns(columns, required=RAW_COLUMNS) -> None:
    """Raise with the list of absent required columns (no data is read)."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def missing_columns(df: DataFrame, required=RAW_COLUMNS) -> DataFrame:
    """The absent required columns as rows ``(missing_column)`` (empty when fine)."""
    spark = df.sparkSession
    absent = [c for c in required if c not in df.columns]
    return spark.createDataFrame([(c,) for c in absent], "missing_column string")


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_missing_tokens(df: DataFrame, tokens=PANDAS_NA_TOKENS, columns=RAW_COLUMNS) -> DataFrame:
    """Missing-value spellings -> null, as one projection (one ``IN`` list per
    column, parsed on the JVM in a single call)."""
    if not tokens:
        return df
    in_list = ", ".join(_sql_string(t) for t in tokens)
    return df.selectExpr(*[
        f"CASE WHEN `{c}` IN ({in_list}) THEN NULL ELSE `{c}` END AS `{c}`" if c in columns else f"`{c}`"
        for c in df.columns])


POSITION_COLUMNS = ("_file", "_block", "_local")


def with_positions(scan: DataFrame) -> DataFrame:
    """Add each row's position: file path, split start, index inside its task.

    ``scan`` must come straight from a file source (``_metadata`` columns);
    the index is fixed when the columns are computed on the scan.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),  # the name alone repeats across folders
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)).alias("_local"),
    )


def number_positions(df: DataFrame, start: int = 2, name: str = "source_row_number") -> DataFrame:
    """Positions -> contiguous row numbers in file order (position columns dropped).

    Per split (file, block start): the first local index and the row count;
    a running sum over splits ordered by (file path, block start) gives each
    split's offset. The split table has one row per input split (data size /
    split size); it is measured and joined back — broadcast when it fits.
    """
    splits = df.groupBy("_file", "_block").agg(
        F.min("_local").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_block", "_lo",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets, _ = small_side(offsets, "split-offsets")
    number = (F.col("_before") + F.col("_local") - F.col("_lo") + F.lit(start)).cast("bigint")
    keep = [c for c in df.columns if c not in POSITION_COLUMNS]
    return df.join(offsets, ["_file", "_block"]).select(number.alias(name), *keep)


def with_source_row_number(scan: DataFrame, start: int = 2, name: str = "source_row_number") -> DataFrame:
    """Number rows of a file scan in file order (see ``number_positions``)."""
    return number_positions(with_positions(scan), start, name)


def _data_files(spark: SparkSession, path: str) -> list:
    """Visible data files under ``path`` (file, folder or glob), sorted by path."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    out = []
    for st in fs.globStatus(root) or []:
        if st.isDirectory():
            it = fs.listFiles(st.getPath(), True)
            while it.hasNext():
                out.append(it.next().getPath())
        else:
            out.append(st.getPath())
    visible = [q for q in out if not q.getName().startswith(("_", "."))]
    return sorted(visible, key=lambda q: q.toString())


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line of the first data file.

    A driver-side read of one line through the Hadoop file system (any FS
    URI, compressed files through their codec) — no Spark job.
    """
    try:
        files = _data_files(spark, path)
    except Exception:  # remote session: no JVM access; let Spark read the header
        return spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if not files:
        raise FileNotFoundError(f"no data files under {path}")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    first = files[0]
    stream = first.getFileSystem(conf).open(first)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(first)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return next(csv.reader([line.lstrip("\ufeff")]), [])


def read_bronze_csv(spark: SparkSession, path: str, missing_tokens=PANDAS_NA_TOKENS,
                    row_numbers: bool = True, positions: bool = False, multi_line: bool = False) -> DataFrame:
    """Read event CSV file(s) with a header into the nine raw text columns.

    The header is read on the driver and checked before any data job; the
    scan then gets an explicit all-text schema in header order. With
    ``positions`` the row positions are kept instead of numbered (to number
    them after a write, so the CSV is parsed once). ``multi_line`` accepts
    line breaks inside quoted fields.
    """
    header = read_header(spark, path)
    require_columns(header)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    scan = (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
            .option("enforceSchema", False).csv(path).select(*RAW_COLUMNS))
    if positions:
        scan = with_positions(scan)
    elif row_numbers:
        scan = with_source_row_number(scan)
    return null_missing_tokens(scan, missing_tokens)


CSV_FILES = "{*.csv,*.csv.gz}"  # part files of a written workload


def write_bronze_csv(df: DataFrame, path: str, order_col: str | None = "source_row_number", max_records: int = 0,
                     compression: str = "none") -> None:
    """Write raw rows as CSV with a header, keeping blanks around values;
    ``max_records`` (if any) bounds the rows of a file.

    With ``order_col`` the rows are range-partitioned and sorted, so part
    files in name order hold the rows in order.
    """
    out = df
    if order_col and order_col in df.columns:
        out = df.repartitionByRange(order_col).sortWithinPartitions(order_col)
    (out.select(*RAW_COLUMNS).write.mode("overwrite")
     .option("maxRecordsPerFile", max_records)
     .option("compression", compression)
     .option("header", True)
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def sample_sizes(spark: SparkSession, pattern: str) -> DataFrame:
    """Discover ``ecommerce_<n>.csv`` inputs, files or folders of part files:
    one row ``(sample_size, path)`` per workload, in numeric order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES).load(pattern).select("path")
    size = F.regexp_extract(F.col("path"), r"ecommerce_(\d+)(\.csv)?(/|$)", 1)
    root = F.regexp_extract(F.col("path"), r"^(.*ecommerce_\d+(?:\.csv)?)(?:/|$)", 1)
    return (files.select(size.cast("bigint").alias("sample_size"), root.alias("file"))
            .filter(F.col("sample_size").isNotNull()).distinct().orderBy("sample_size", "file"))


def workload_size(path: Column) -> Column:
    """The ``<n>`` of ``ecommerce_<n>`` (file or folder) in a file's path."""
    return F.regexp_extract(path, r"ecommerce_(\d+)(\.csv)?(/|$)", 1).try_cast("bigint")


def workload_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the workloads written under ``root`` (``ecommerce_<n>.csv``,
    files or folders) in one scan: ``sample_size file`` and the raw columns."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
    scan = (spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
            .csv(f"{root.rstrip('/')}/*.csv"))
    file = F.col("_metadata.file_path")
    return scan.select(workload_size(file).alias("sample_size"), file.alias("file"), *RAW_COLUMNS)


def written_workloads(spark: SparkSession, root: str) -> DataFrame:
    """``sample_size`` once for every row of the workloads written under
    ``root``, the size as discovered."""
    return workload_rows(spark, root).select("sample_size")
