"""Warehouse scans (S1): read the four source tables into canonical names.

A warehouse is four DataFrames with canonical lower-case columns:

* ``headers``  (dockey, docdate, debtorcode)          invoice header
* ``lines``    (dockey, itemcode, amount, projno)     invoice line
* ``items``    (itemcode, itemtype)                   item master
* ``channel2`` (debtorcode, docdate, amount, category, invtype)
  denormalised invoices of the second sales channel

Sources can be catalog tables, parquet paths or JDBC tables; all scans are
lazy, so Catalyst prunes columns and pushes filters into each reader.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType


@dataclass(frozen=True)
class Warehouse:
    headers: DataFrame
    lines: DataFrame
    items: DataFrame
    channel2: DataFrame


# --- fixed values: source column -> canonical column, per table (the original warehouse names) ---
HEADER_COLUMNS = {"DocKey": "dockey", "DocDate": "docdate", "DebtorCode": "debtorcode"}
LINE_COLUMNS = {"DocKey": "dockey", "ItemCode": "itemcode", "TaxCurrencyTaxableAmt": "amount", "ProjNo": "projno"}
ITEM_COLUMNS = {"ItemCode": "itemcode", "ItemType": "itemtype"}
CHANNEL2_COLUMNS = {"debtorcode": "debtorcode", "docdate": "docdate", "amount": "amount",
                    "category": "category", "invtype": "invtype"}
# --- end of fixed values ----------------------------------------------------


def canonical(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Project and rename by name (P1); dates are cast to DATE; amounts keep a decimal type, else DOUBLE."""
    cols = []
    for src, dst in mapping.items():
        c = F.col(src)
        if dst == "docdate":
            c = c.cast("date")
        elif dst == "amount" and not isinstance(df.schema[src].dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(dst))
    return df.select(*cols)


def _load(spark: SparkSession, source: str, fmt: str, options: dict | None, predicates: list[str] | None = None) -> DataFrame:
    if fmt == "table":
        return spark.read.table(source)
    reader = spark.read.format(fmt)
    if options:
        reader = reader.options(**options)
    if fmt == "jdbc" and predicates:  # one task per condition; each goes into that task's own query
        more = {k: v for k, v in (options or {}).items() if k != "url"}
        return spark.read.jdbc(options["url"], source, predicates=predicates, properties=more)
    if fmt == "jdbc":
        return reader.option("dbtable", source).load()
    return reader.load(source)


def quantile_cuts(df: DataFrame, column: str, parts: int) -> list:
    """At most ``parts`` - 1 ascending cut values that deal the rows of ``df`` about evenly by ``column`` (a date or a number).

    One map-side combined aggregate; ``df`` may be a small extract of the source (a key column, or dates of headers)."""
    kind = df.schema[column].dataType
    days = F.unix_date(F.col(column)) if isinstance(kind, DateType) else F.col(column)
    got = df.agg(F.percentile_approx(days, [k / parts for k in range(1, parts)], 10_000).alias("q")).first()["q"] if parts > 1 else None
    return [dt.date(1970, 1, 1) + dt.timedelta(days=int(v)) if isinstance(kind, DateType) else v for v in sorted(set(got or []))]


def range_predicates(column: str, cuts: list) -> list[str]:
    """SQL conditions, one per scan partition, of which every row meets exactly one: below the first cut (and nulls), between cuts,
    from the last cut on."""
    def value(v):
        return f"DATE '{v.isoformat()}'" if isinstance(v, dt.date) else repr(v)
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    return [f"({column} < {value(cuts[0])} OR {column} IS NULL)",
            *[f"({column} >= {value(lo)} AND {column} < {value(hi)})" for lo, hi in zip(cuts, cuts[1:])],
            f"({column} >= {value(cuts[-1])})"]


def scan_warehouse(spark: SparkSession, headers: str, lines: str, items: str, channel2: str,
                   fmt: str = "table", options: dict | None = None,
                   table_options: dict[str, dict] | None = None,
                   columns: dict[str, dict[str, str]] | None = None,
                   cuts: dict[str, tuple[str, list]] | None = None) -> Warehouse:
    """Scan the four tables (catalog names, paths, or JDBC table names).

    ``table_options`` adds reader options per table ("headers", "lines", "items", "channel2"): for JDBC give the
    fact tables ``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions`` and ``fetchsize``, or all their
    rows arrive in one task. ``cuts`` does that without bounds: per table a source column and cut values (:func:`quantile_cuts`
    of the header dates, or of the line keys), read as one partition per range. ``columns`` replaces a table's source -> canonical column map.
    """
    maps = {"headers": HEADER_COLUMNS, "lines": LINE_COLUMNS, "items": ITEM_COLUMNS, "channel2": CHANNEL2_COLUMNS} | (columns or {})
    sources = {"headers": headers, "lines": lines, "items": items, "channel2": channel2}
    return Warehouse(**{name: canonical(_load(spark, source, fmt, (options or {}) | (table_options or {}).get(name, {}),
                                           range_predicates(*cuts[name]) if name in (cuts or {}) else None), maps[name])
                        for name, source in sources.items()})
