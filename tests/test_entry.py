"""Driver contract and a sample of the SQL-oracle comparisons at sf0.001
(``python check_oracles.py <sf_dir>`` runs all of them)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import TABLES, canon

SF = "/root/testdata/sf0.001"
SAMPLE = ["target_counts_for_cells", "global_coordinates", "dotplot_stats", "type_flows", "flow_nodes",
          "select_segmentations", "stitch_mosaic", "label_boundaries", "cells_in_shapes", "run_durations",
          "layer_catalog", "read_cell_metadata"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["target", "count"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    assert set(q) - set(o) <= set(E.LLM_QUERIES)  # every query of the library itself has SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    r = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, srows) == canon(ocols, orows)
