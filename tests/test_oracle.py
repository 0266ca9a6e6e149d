"""Every registered query against its DuckDB twin on the driver's test tables.

All of them run on sf0.001 (or DEMAND_ORACLE_SF); the cells and the split series that most queries start from are
built once here and shared. ``python tests/oracle_compare.py`` runs each query on its own, as the driver does.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from demand.plans import catalog  # noqa: E402
from demand.session import cut_lineage  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

SF = os.environ.get("DEMAND_ORACLE_SF", "/root/testdata/sf0.001")
NO_SQL = {"boosted_lags", "forecast_all_models"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module", autouse=True)
def shared_steps():
    """One fact pass and one series build for all queries of this module."""
    made, saved = {}, (catalog._cells, catalog._split)
    cells, split = saved

    def once(name, build):
        return lambda spark, sf: made[name] if name in made else made.setdefault(name, cut_lineage(build(spark, sf)))

    catalog._cells, catalog._split = once("cells", cells), once("split", split)
    yield
    catalog._cells, catalog._split = saved


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], catalog.oracle_sql()[name], SF)
    assert res["ok"], res


def test_selection_is_exercised(spark):
    """The record's candidates compete: several winners, and the tie goes to the first label."""
    rows = catalog.queries()["best_model"](spark, SF).collect()
    winners = {r.mape_model for r in rows}
    assert len(winners) > 1 and "SARIMAX" in winners and "XGBoost" not in winners
    assert {r.status for r in catalog.queries()["record_statuses"](spark, SF).collect()} == {
        "ok", "bad_item", "no_data", "too_short", "no_model"}


def test_queries_without_sql_are_known():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == NO_SQL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "status" in df.columns
