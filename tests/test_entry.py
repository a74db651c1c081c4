import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_module
from check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")

# One query of each kind; tools/check_oracle.py runs all of them.
CHECKED = ["s2_read_record_blocks", "a7_group_rollup", "a3_pair_status", "a14_overlap_metrics", "w2_mid_rank", "w3_bh_adjust",
           "j14_reconcile_artifacts", "w7_stall_gaps", "d7_overrepresented_lookup", "a17_sample_distances", "g4_gate_status", "z2_stall_sessions"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_statement_belongs_to_a_query_and_runs(duck):
    queries, oracle = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracle) <= set(queries)
    for name, sql in oracle.items():
        columns = [d[0] for d in duck.execute(sql).description]
        assert len(columns) == len(set(columns)), name


@pytest.mark.parametrize("name", CHECKED)
def test_rows_equal_the_statement(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(entry_module.oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() == len({r["sample_id"] for r in entry_module.entry(spark).collect()})
