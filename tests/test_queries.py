"""Every registered query against its SQL in DuckDB; queries without SQL for rows."""

import datetime
import decimal
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidewheel import plans
from tidewheel.plans import segment_plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def tidy(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(map(tidy, v.values()))
    return tuple(map(tidy, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows_as_sql(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    result = con.execute(plans.SQL[name])
    cols = [c[0] for c in result.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(map(tidy, r)) for r in result.fetchall())
    assert Counter(tuple(tidy(r[c]) for c in cols) for r in df.collect()) == want


def unit(x):
    return -1e-9 <= x <= 1 + 1e-9


def one_row_per(rows, *keys):
    return len({tuple(r[k] for k in keys) for r in rows}) == len(rows)


def one_hot(features, sizes):
    at = len(features) - sum(sizes)
    return all(sum(features[at + sum(sizes[:k]) : at + sum(sizes[: k + 1])]) == 1 for k in range(len(sizes)))


#: What holds of the results of queries without SQL, whatever the models found: rows, ids of the table.
INVARIANTS = {
    "d10_pca": lambda rows, ids: all(abs(v) <= 1 + 1e-9 for r in rows for v in r.asDict().values() if isinstance(v, float)),
    "d11_d12_clusters": lambda rows, ids: sum(r.n for r in rows) == len(ids) and all(r.amount_p20 <= r.amount_median <= r.amount_p80 for r in rows),
    "d13_silhouettes": lambda rows, ids: all(-1 <= r.silhouette <= 1 for r in rows) and [r.inertia for r in sorted(rows, key=lambda r: -r.k)] == sorted(r.inertia for r in rows),
    "d16_d18_model_scores": lambda rows, ids: one_row_per(rows, "msisdn") and all(0.3 < r.score <= 1 for r in rows) and {r.msisdn for r in rows} <= ids,
    "d22_two_model_uplift": lambda rows, ids: {r.msisdn for r in rows} == ids and all(unit(r.treated) and unit(r.control) and abs(r.uplift - r.treated + r.control) < 1e-12 for r in rows),
    "d23_propensity": lambda rows, ids: abs(sum(r.importance for r in rows) - 1) < 1e-6 and all(unit(r.auc) for r in rows),
    "d29_preprocessing": lambda rows, ids: {r.msisdn for r in rows} == ids and all(one_hot(r.features, r.sizes) for r in rows),
    "d30_forest_metrics": lambda rows, ids: len(rows) == 1 and 0 < rows[0].r2 <= 1 and rows[0].mae <= rows[0].rmse <= rows[0].max_error and abs(rows[0].rse + rows[0].r2 - 1) < 1e-9,
    "d31_d33_similar_performance": lambda rows, ids: {r.msisdn for r in rows} == ids and one_row_per(rows, "msisdn", "point") and all(0 <= r.value <= 100 for r in rows if r.point == "percentile"),
    "d34_grid_search": lambda rows, ids: len(rows) == 2 and all(unit(r.auc) for r in rows),
    "d23_boosted_propensity": lambda rows, ids: abs(sum(r.importance for r in rows) - 1) < 1e-6 and all(unit(r.auc) and r.positives + r.negatives < len(ids) for r in rows),
    "d35_importances": lambda rows, ids: len(rows) == 4 and abs(sum(r.mean for r in rows) - 1) < 1e-6 and all(r.min <= r.median <= r.max for r in rows),
    "d36_selected_uplift": lambda rows, ids: {r.repeat for r in rows} == {0, 1} and all(len(r.features.split(",")) == 2 for r in rows) and max(r.n for r in rows) < len(ids),
    "d35_comparability": lambda rows, ids: one_row_per(rows, "repeat") and all(unit(r.auc) for r in rows),
    "d36_cross_fold_uplift": lambda rows, ids: (ns := [r.n for r in sorted(rows, key=lambda r: r.quantile)]) == sorted(set(ns)) and ns[-1] == len(ids),
}


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_invariants(spark, name):
    rows = plans.QUERIES[name](spark, SF).collect()
    assert rows and INVARIANTS[name](rows, {r.msisdn for r in segment_plans.wide(spark, SF).select("msisdn").collect()})
