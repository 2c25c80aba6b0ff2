"""Every registered query against its SQL counterpart, or at least to a result."""

import pytest

import compare
from netpulse.catalog.oracles import ORACLES
from netpulse.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


GOLDEN = {  # raw, duplicates, timestamps, cells, sites, KPI, undecided, clean
    "sf0.001": (1020, 20, 5, 3, 3, 51, 9, 929),
    "sf0.01": (10200, 200, 48, 32, 32, 510, 93, 9285),
    "sf0.1": (102000, 2000, 474, 324, 320, 5002, 932, 92949),
}


def test_golden_funnel(spark, sf_dir):
    expected = GOLDEN.get(sf_dir.rstrip("/").split("/")[-1])
    if expected is None:
        pytest.skip("no golden counts for this folder")
    row = QUERIES["quality_funnel"](spark, sf_dir).first()
    names = ["raw_rows", "duplicates_removed", "invalid_timestamps", "invalid_cell_ids", "invalid_site_ids",
             "invalid_kpis", "null_kpi", "final_rows"]
    assert tuple(row[name] for name in names) == expected
