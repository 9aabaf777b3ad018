"""File sources: retail CSV tables (S1-S3) and the quote history table.

Every reader declares its schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from ledgerline.functions.expressions import with_date_parts
from ledgerline.sources.schemas import INV, QUOTE_COLUMNS, QUOTES, SESS, TXN

CSV_DECIMAL = DecimalType(26, 6)   # what decimal columns are read as
CSV_EXACT = DecimalType(38, 18)    # as many digits before the point, and more behind it to see what would be cut


def _csv(spark: SparkSession, path: str, schema: StructType, on_bad: str, bad_column: str | None) -> DataFrame:
    """CSV folder or file with a header: columns by name, in any order, extra ones left out.

    The header is read from the first file; a file with another one fails.
    Decimal columns become decimal(26,6).  One rule holds for every column:
    text that is not exactly a value of the column's type is bad (white space
    alone is no value).  ``on_bad="fail"`` fails the job and names column and
    text; ``"null"`` makes it NULL and keeps the row.  ``bad_column`` adds an
    array with the names of a row's bad columns, for ``reject_counts``.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    names = spark.read.option("header", True).csv(path).columns
    text = (spark.read.schema(StructType([StructField(n, StringType()) for n in names]))
            .option("header", True).option("enforceSchema", False).csv(path))
    out = [F.expr(f"{_parsed(f, on_bad)} AS `{f.name}`") for f in schema.fields]
    if bad_column is not None:
        marks = ", ".join(f"CASE WHEN {_is_bad(f)} THEN '{f.name}' END" for f in schema.fields
                          if not isinstance(f.dataType, StringType))
        out.append(F.expr(f"array_compact(array({marks})) AS `{bad_column}`"))
    return text.select(*out)


def _value(field: StructField) -> str:
    """The column's text as its type; NULL if it is not exactly such a value."""
    c = f"`{field.name}`"
    if not isinstance(field.dataType, DecimalType):
        return f"try_cast({c} AS {field.dataType.simpleString()})"
    exact = f"try_cast({c} AS {CSV_EXACT.simpleString()})"
    kept = f"try_cast({exact} AS {CSV_DECIMAL.simpleString()})"
    return f"CASE WHEN {kept} = {exact} THEN {kept} END"


def _is_bad(field: StructField) -> str:
    return f"(trim(`{field.name}`) != '' AND {_value(field)} IS NULL)"


def _parsed(field: StructField, on_bad: str) -> str:
    c = f"`{field.name}`"
    if isinstance(field.dataType, StringType):
        return c
    if on_bad == "null":
        return _value(field)
    kind = (CSV_DECIMAL if isinstance(field.dataType, DecimalType) else field.dataType).simpleString()
    what = "a number of at most 6 decimals" if isinstance(field.dataType, DecimalType) else kind
    return (f"CASE WHEN {_is_bad(field)} THEN CAST(raise_error(concat('{field.name}: not {what}: ', {c})) AS {kind}) "
            f"ELSE {_value(field)} END")


def load_transactions(spark: SparkSession, path: str, on_bad: str = "fail",
                      bad_column: str | None = None) -> DataFrame:
    """Transactions CSV with header; adds ``year_month``, ``month_num``, ``year``."""
    return with_date_parts(_csv(spark, path, TXN, on_bad, bad_column))


def load_sessions(spark: SparkSession, path: str, on_bad: str = "fail", bad_column: str | None = None) -> DataFrame:
    """Sessions CSV with header; ``timestamp`` parsed as wall-clock time.

    Up to nine fraction digits are accepted (pandas writes nanoseconds);
    Spark keeps microseconds.
    """
    return _csv(spark, path, SESS, on_bad, bad_column)


def load_inventory(spark: SparkSession, path: str, on_bad: str = "fail", bad_column: str | None = None) -> DataFrame:
    """Inventory CSV with header."""
    return _csv(spark, path, INV, on_bad, bad_column)


def reject_counts(rows: DataFrame, bad_column: str) -> DataFrame:
    """``(column, rejects)``: bad values per column of rows loaded with ``bad_column``; columns without any are left out."""
    return (rows.select(F.explode(bad_column).alias("column")).groupBy("column")
            .agg(F.count(F.lit(1)).alias("rejects")))


def _is_missing_path(err: AnalysisException) -> bool:
    return (err.getCondition() or "") == "PATH_NOT_FOUND"


def load_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Quote history table, re-read on every call (sees all committed batches).

    The table is Parquet written by the ingest stream; its ``_spark_metadata``
    commit log makes readers skip files of an unfinished batch.  The log is
    read when the frame is made: the frame stays at that commit however often
    it runs, and a new call sees later batches.  A missing table gives an
    empty frame with the full 8-column schema.
    """
    try:
        df = spark.read.schema(QUOTES).parquet(path)
    except AnalysisException as err:
        if not _is_missing_path(err):
            raise
        df = spark.createDataFrame([], QUOTES)
    return df.select(*QUOTE_COLUMNS)


def is_finished(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished write (its ``_SUCCESS`` marker), on any file system Spark knows."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)
