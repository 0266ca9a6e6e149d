"""Work list: which series are long, dense and current enough to forecast.

The three grain profiles (customer x channel, category x channel,
customer x category x channel) come from one GROUPING SETS aggregate: one
scan, one Expand, partial aggregation of count/min/max before the shuffle,
so a category holding a third of all cells is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.constants import ALL, DEFAULT_ITEMS, DENSITY, MIN_SPAN_MONTHS
from ..schemas import WORKLIST
from .indexing import dense_row_index

# grouping_id() values (bit set = column rolled up; order debtorcode, category, projno)
GRAIN_CUSTOMER = 2        # (debtorcode, projno)
GRAIN_CATEGORY = 4        # (category, projno)
GRAIN_CUSTOMER_CATEGORY = 0  # (debtorcode, category, projno)
SECTION_OF_GRAIN = {GRAIN_CUSTOMER: 1, GRAIN_CATEGORY: 2, GRAIN_CUSTOMER_CATEGORY: 3}


def grain_profile(cells: DataFrame) -> DataFrame:
    """A3: count of non-null cells, first and last month per grain.

    Null keys are dropped per grain (a null category still counts at the
    customer grain), as a group-by that skips null keys would do.
    """
    d, c, p = F.col("debtorcode"), F.col("category"), F.col("projno")
    prof = (cells.groupingSets([[d, p], [c, p], [d, c, p]], d, c, p)
            .agg(F.count("y").alias("n_cells"),
                 F.min("month_year").alias("month_year_min"),
                 F.max("month_year").alias("month_year_max"),
                 F.grouping_id(d, c, p).alias("grain")))
    keep = (((F.col("grain") == GRAIN_CUSTOMER) & d.isNotNull() & p.isNotNull())
            | ((F.col("grain") == GRAIN_CATEGORY) & c.isNotNull() & p.isNotNull())
            | ((F.col("grain") == GRAIN_CUSTOMER_CATEGORY) & d.isNotNull() & c.isNotNull() & p.isNotNull()))
    return prof.filter(keep)


def qualify_series(profile: DataFrame, cutoff: str, density: float = DENSITY,
                   min_span: int = MIN_SPAN_MONTHS) -> DataFrame:
    """C1 (P9-P12): current at the cutoff, dense, long enough.

    The span is an exclusive month difference (same month = 0); the density
    rule compares the cell count with span * density in doubles.
    """
    span = dates.month_diff(F.col("month_year_max"), F.col("month_year_min"))
    return (profile
            .filter(F.col("month_year_max") == F.lit(cutoff))
            .withColumn("monthcount", span)
            .filter(F.col("n_cells").cast("double") >= F.col("monthcount").cast("double") * F.lit(float(density)))
            .filter(F.col("monthcount") >= F.lit(min_span))
            .select(
                F.when(F.col("grain") == GRAIN_CATEGORY, F.lit(ALL)).otherwise(F.col("debtorcode")).alias("debtorcode"),
                F.when(F.col("grain") == GRAIN_CUSTOMER, F.lit(ALL)).otherwise(F.col("category")).alias("category"),
                "projno",
                F.col("month_year_max").alias("month_year"),
                "grain"))


def default_items(spark: SparkSession, cutoff: str) -> DataFrame:
    """The three roll-up items, in output order."""
    rows = [(d, c, p, cutoff, i) for i, (d, c, p) in enumerate(DEFAULT_ITEMS)]
    return spark.createDataFrame(rows, "debtorcode string, category string, projno string, month_year string, _ord int")


def validate_cutoff(cutoff: str | None, last_closed: str) -> str:
    """A forced month may not be later than the last closed month."""
    if cutoff is None or cutoff == "":
        return last_closed
    if cutoff > last_closed:
        raise ValueError(f"month {cutoff} is after the last closed month {last_closed}")
    return cutoff


def worklist(cells: DataFrame, cutoff: str, density: float = DENSITY, min_span: int = MIN_SPAN_MONTHS) -> DataFrame:
    """Defaults + customer + category + customer x category items, numbered.

    Returns (row_idx, debtorcode, category, projno, month_year); row_idx
    follows section order, then the grain keys (W8, K3).
    """
    spark = cells.sparkSession
    qualified = qualify_series(grain_profile(cells.filter(F.col("month_year") <= F.lit(cutoff))),
                               cutoff, density, min_span)
    sections = F.create_map(*[x for g, s in SECTION_OF_GRAIN.items() for x in (F.lit(g), F.lit(s))])
    body = qualified.select("debtorcode", "category", "projno", "month_year",
                            sections[F.col("grain")].alias("_section"), F.lit(0).alias("_ord"))
    head = default_items(spark, cutoff).withColumn("_section", F.lit(0))
    allrows = head.unionByName(body)
    order = ["_section", "_ord", "debtorcode", "category", "projno"]
    numbered = dense_row_index(allrows, order, "row_idx")
    return numbered.select(*[f.name for f in WORKLIST.fields])


def split_sequential(wl: DataFrame, fraction: float = 0.5) -> DataFrame:
    """K1: first int(n * fraction) rows are part 1, the rest part 2."""
    n = wl.count()
    first = int(n * fraction)
    return wl.withColumn("part", F.when(F.col("row_idx") < F.lit(first), F.lit(1)).otherwise(F.lit(2)))


def split_random(wl: DataFrame, seed: int = 42, fraction: float = 0.5) -> DataFrame:
    """An exact, repeatable random half and its complement.

    Rows are ranked by a seeded hash of their keys (not ``rand()``, which is
    not stable across task retries), the first int(n * fraction) are part 1.
    """
    n = wl.count()
    first = int(n * fraction)
    keyed = wl.withColumn("_h", F.xxhash64(F.lit(seed), "row_idx", "debtorcode", "category", "projno"))
    ranked = dense_row_index(keyed, ["_h", "row_idx"], "_rank")
    return (ranked.withColumn("part", F.when(F.col("_rank") < F.lit(first), F.lit(1)).otherwise(F.lit(2)))
            .drop("_h", "_rank"))
