"""CSV edge lists, clusterings and matchings.

Format (fixed): comma separated, no header, no quotes, exactly two integer
fields per line; CRLF line ends are accepted.  Any other line fails the read
instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed schemas of the three file kinds.
EDGE_SCHEMA = "src BIGINT, dst BIGINT"
ASSIGN_SCHEMA = "vid BIGINT, cid BIGINT"


# Fixed pattern of a line: two integers; a carriage return or blanks may follow a field.
LINE = r"^[ \t]*([+-]?[0-9]+)[ \t]*,[ \t]*([+-]?[0-9]+)[ \t\r]*$"


def _read_pairs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines are read whole and checked in a filter, which no column pruning
    removes: any other line fails every action, ``count()`` too."""
    line = F.col("value")
    good = F.when(line.rlike(LINE), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"malformed line in {path}: "), line)).cast("boolean"))
    first, second = (part.split()[0] for part in schema.split(", "))
    # a good line has one comma; the cast leaves out blanks and carriage returns
    return spark.read.text(path).where(good).select(
        F.substring_index(line, ",", 1).cast("bigint").alias(first),
        F.substring_index(line, ",", -1).cast("bigint").alias(second))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge list ``(src, dst)`` as stored (duplicates / self-loops kept)."""
    return _read_pairs(spark, path, EDGE_SCHEMA)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Clustering ``(vid, cid)``."""
    return _read_pairs(spark, path, ASSIGN_SCHEMA)


def read_matching(spark: SparkSession, path: str) -> DataFrame:
    """Matching ``(src, dst)``, smaller id first (rows are not deduplicated)."""
    m = _read_pairs(spark, path, EDGE_SCHEMA)
    return m.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))


def write_assignments(assign: DataFrame, path: str) -> None:
    """Write ``(vid, cid)`` as header-less CSV, one file per partition, replacing ``path``."""
    assign.select("vid", "cid").write.mode("overwrite").option("header", "false").csv(path)
