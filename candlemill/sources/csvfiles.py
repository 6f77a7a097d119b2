"""Historical CSV: one file, or one folder of part files, per symbol."""

from pyspark.sql import functions as F

from candlemill.functions.timefn import parse_text
from candlemill.schemas import CSV_SCHEMA
from candlemill.sources.canonical import canonical

# Fixed value: the symbol is the part of the name before `_1m_1year` or `_1m_1month`.
# A folder of that name may hold the symbol's part files.
NAME_PATTERN = r"([^/\\=]+)_1m_(?:1year|1month)\.csv(?:/[^/]+)?$"


def symbol_of_path(path):
    """Symbol named by a file path, or the empty string when the name does not fit."""
    return F.regexp_extract(path, NAME_PATTERN, 1)


def scan_csv(spark, path):
    """All files below ``path`` with their symbol and source path, cells still text."""
    return (
        spark.read.schema(CSV_SCHEMA)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("path"))
        .withColumn("symbol", symbol_of_path(F.col("path")))
    )


def read_candles(spark, path):
    """Canonical candles of every file whose name carries a symbol."""
    return canonical(scan_csv(spark, path).filter(F.col("symbol") != ""))


def rejected_files(spark, path):
    """Rows per file whose name carries no symbol."""
    rejected = scan_csv(spark, path).filter(F.col("symbol") == "")
    return rejected.groupBy("path").agg(F.count("*").alias("n_rows"))


def rejected_rows(spark, path):
    """Rows of symbol files whose time cannot be read: they have no key, so no job stores them."""
    rows = scan_csv(spark, path).filter(F.col("symbol") != "")
    return rows.filter(parse_text("timestamp").isNull()).withColumn("reason", F.lit("bad time"))
