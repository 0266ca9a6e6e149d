"""Work-list CSV source and sink.

The work list is written as CSV with a header; the row index is an explicit
``row_idx`` column (numbering continues across the halves) and the halves
are ``part=1`` / ``part=2`` directories, so both halves can be read together
or one at a time. Files written by the original tool (first header cell
empty) are read with the same fixed schema: columns are matched by position,
then blank cells become ''.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import WORKLIST

STRING_COLUMNS = ["debtorcode", "category", "projno", "month_year"]


def write_worklist_csv(wl: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the work list; a ``part`` column becomes one directory per half."""
    writer = wl.write.mode(mode).option("header", True)
    if "part" in wl.columns:
        writer = writer.partitionBy("part")
    writer.csv(path)


def read_worklist_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read work-list CSV files (one file, a half, or the whole directory)."""
    df = (spark.read.option("header", True).option("enforceSchema", True)
          .schema(WORKLIST).csv(path))
    df = df.na.fill("", STRING_COLUMNS)
    if "part" in df.columns:
        df = df.withColumn("part", F.col("part").cast("long"))
    return df
