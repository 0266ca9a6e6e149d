"""Property tests against brute force (numpy / pandas) on small random fixtures."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import cells_df, months
from demand.operators import series as S

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
MONTHS = months(2019, 1, 30)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 29), st.integers(1, 1000)), min_size=1, max_size=20, unique_by=lambda x: x[0]))
def test_gap_fill_equals_numpy_interp(spark, points):
    raw = spark.createDataFrame([(1, MONTHS[i], float(v)) for i, v in points], "item_id long, month_year string, y double")
    got = S.gap_fill(raw).orderBy("t").toPandas()
    xs = np.array(sorted(i for i, _ in points))
    ys = np.array([dict(points)[i] for i in xs], dtype=float)
    grid = np.arange(xs.min(), xs.max() + 1)
    assert len(got) == len(grid)                                   # no missing month
    np.testing.assert_allclose(got.y.values, np.interp(grid, xs, ys), rtol=1e-12)
    assert (got.filled.values == ~np.isin(grid, xs)).all()         # known points kept, gaps flagged


cell = st.tuples(st.sampled_from(["D1", "D2", "D3", None]), st.sampled_from(["C1", "C2", None]),
                 st.sampled_from(["AC", "UL"]), st.integers(1, 500), st.integers(0, 5))


@SETTINGS
@given(st.lists(cell, min_size=1, max_size=25))
def test_hierarchy_expand_equals_pandas(spark, rows):
    data = [(d, c, p, float(y), MONTHS[m]) for d, c, p, y, m in rows]
    cells = cells_df(spark, data)
    items = [("All", "All", "All"), ("All", "All", "UL"), ("D1", "All", "AC"), ("All", "C2", "UL"), ("D2", "C1", "AC")]
    wl = spark.createDataFrame([(i, d, c, p, MONTHS[3]) for i, (d, c, p) in enumerate(items)],
                               "item_id long, debtorcode string, category string, projno string, month_year string")
    got = {(r.item_id, r.month_year): r.y for r in S.hierarchy_expand(cells, wl).collect()}
    pdf = pd.DataFrame(data, columns=["debtorcode", "category", "projno", "y", "month_year"])
    pdf = pdf[pdf.month_year <= MONTHS[3]]
    selections = [pdf, pdf[pdf.projno == "UL"], pdf[pdf.debtorcode == "D1"], pdf[pdf.category == "C2"],
                  pdf[(pdf.debtorcode == "D2") & (pdf.category == "C1")]]
    want = {}
    for i, sel in enumerate(selections):
        for m, y in sel.groupby("month_year")["y"].sum().items():
            want[(i, m)] = y
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k]
