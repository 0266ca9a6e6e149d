"""The work-list job, warehouse -> cells -> work list -> two CSV halves.

One lazy plan from the scans to the CSV write; the exchanges are the
line/header join, the cell aggregate and the grouping-sets aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DENSITY, MIN_SPAN_MONTHS
from ..operators import facts, worklist as W
from ..sources import worklist_io
from ..sources.warehouse import Warehouse


def last_closed_month(spark: SparkSession, as_of=None) -> str:
    """'YYYY-MM' of the month before the run date (one scalar, no data)."""
    from ..functions import dates
    return spark.range(1).select(dates.last_closed_month(as_of).alias("m")).first()["m"]


def build_worklist(wh: Warehouse, as_of=None, month: str | None = None, random_split: bool = False,
                   seed: int = 42, density: float = DENSITY, min_span: int = MIN_SPAN_MONTHS) -> DataFrame:
    """Work list with ``part`` (1 or 2); ``month`` forces an earlier cutoff."""
    spark = wh.lines.sparkSession
    cutoff = W.validate_cutoff(month, last_closed_month(spark, as_of))
    cells = facts.cells(wh, as_of)
    wl = W.worklist(cells, cutoff, density, min_span)
    return W.split_random(wl, seed) if random_split else W.split_sequential(wl)


def run(wh: Warehouse, out_path: str, as_of=None, month: str | None = None, random_split: bool = False,
        seed: int = 42) -> DataFrame:
    """Build and write the work list; returns it (written as part=1 / part=2)."""
    wl = build_worklist(wh, as_of, month, random_split, seed)
    worklist_io.write_worklist_csv(wl, out_path, mode="overwrite")
    return wl.withColumn("part", F.col("part").cast("long"))
