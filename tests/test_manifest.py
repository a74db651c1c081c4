import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators import gates as G
from cohortlens.operators import manifest as M

COLUMNS = ["gsm", "title", "run", "patient_id", "analysis_group", "paper_final_set", "paper_group",
           "paper_exclusion_reason", "pair_sensitivity", "library_layout"]


def base():
    """Ten samples: three complete pairs, two further members and two excluded samples."""
    out = []
    for i in range(6):
        group = "pca_tumor" if i % 2 == 0 else "pca_adjacent_normal"
        out.append([f"GSM{i}", f"T{i}", f"SRR{i}", f"P{i // 2}", group, "yes", "tumor" if i % 2 == 0 else "control", "", "yes", "SINGLE"])
    out += [[f"GSM{i}", f"T{i}", f"SRR{i}", f"P{i}", "bph_normal", "yes", "control", "", "no", "SINGLE"] for i in (6, 7)]
    out += [[f"GSM{i}", f"T{i}", f"SRR{i}", f"P{i}", "pca_tumor", "no", "excluded", "small section", "no", "SINGLE"] for i in (8, 9)]
    return out


CONTRACT = G.ManifestContract(n_rows=10, group_sizes={"tumor": 3, "control": 5}, n_sensitivity=6, n_pairs=3)


def check(spark, data):
    df = spark.createDataFrame([tuple(r) for r in data], ", ".join(f"{c} string" for c in COLUMNS))
    return [(r["rule"], r["key"]) for r in G.check_manifest(df, CONTRACT).collect()]


def test_clean_manifest_has_no_violation(spark):
    assert check(spark, base()) == []


MUTATIONS = [
    (0, "gsm", "GSM1", ("unique_id", "gsm=GSM1")),
    (0, "title", "T1", ("unique_id", "title=T1")),
    (9, "run", "XRR9", ("run_pattern", "XRR9")),
    (4, "library_layout", "PAIRED", ("layout", "SRR4")),
    (7, "pair_sensitivity", "maybe", ("sensitivity_value", "SRR7")),
    (8, "paper_exclusion_reason", "", ("exclusion_provenance", "SRR8")),
    (8, "paper_group", "tumor", ("exclusion_provenance", "SRR8")),
    (0, "analysis_group", "bph_normal", ("pair", "P0")),
    (6, "paper_group", "none", ("group_size_control", "group_size_control")),
    (9, "gsm", "SRX9", ("gsm_pattern", "SRR9")),
]


@pytest.mark.parametrize("row,column,value,want", MUTATIONS)
def test_each_mutation_gives_one_violation(spark, row, column, value, want):
    data = base()
    data[row][COLUMNS.index(column)] = value
    assert check(spark, data) == [want]


def test_ragged_line_is_malformed(spark):
    data = base()
    data[9][COLUMNS.index("library_layout")] = None
    assert sorted(check(spark, data)) == [("layout", "SRR9"), ("malformed_row", "SRR9")]


def test_missing_row_and_column(spark):
    assert check(spark, base()[:9]) == [("row_count", "row_count")]
    with pytest.raises(ValueError, match="Missing manifest columns"):
        G.check_manifest(spark.createDataFrame([("a",)], "gsm string"), CONTRACT)


def test_attach_runs_keeps_last_and_flags_missing(spark):
    records = spark.createDataFrame([("s1", "x1"), ("s2", "x2"), ("s3", None)], "id string, srx string")
    runs = spark.createDataFrame([("x1", 1, "old"), ("x1", 2, "new")], "srx string, pos int, run string")
    got = rows(M.attach_runs(records, runs, "srx", "pos", ["run"]), "id", "run", "run_found")
    assert got == [("s1", "new", True), ("s2", "", False), ("s3", "", False)]


def test_pair_status(spark):
    data = [("a", "T", "yes"), ("a", "N", "no"), ("b", "T", "yes"), ("c", "H", "yes"), ("c", "B", "yes"), ("d", "?", "yes")]
    df = spark.createDataFrame(data, "p string, g string, final string")
    got = rows(M.pair_status(df, "p", "g", (("T", "N"), ("H", "B")), 0, "final"), "p", "g", "pair_status", "pair_sensitivity")
    assert got == [("a", "N", "paired", "no"), ("a", "T", "paired", "yes"), ("b", "T", "unpaired", "no"),
                   ("c", "B", "paired", "no"), ("c", "H", "paired", "no"), ("d", "?", "unclassified", "no")]


def test_flags_keep_rule_order(spark):
    df = spark.createDataFrame([(1,), (5,), (20,)], "x int")
    got = rows(M.review_flags(df, [(F.col("x") > 3, "big"), (F.col("x") > 10, "huge")]), "x", "review_flag")
    assert got == [(1, ""), (20, "big; huge"), (5, "big")]


def test_zero_levels_survive(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",)], "c string")
    assert rows(M.group_counts(df, "c", ["a", "b"])) == [("a", 2), ("b", 0), ("z", 1)]


def test_exactly_one_and_patterns(spark):
    names = spark.createDataFrame([("x",), ("y",), ("z",)], "name string")
    genes = spark.createDataFrame([("x",), ("y",), ("y",)], "g string")
    assert rows(M.exactly_one(names, "name", genes, "g")) == [("y", 2), ("z", 0)]
    ids = spark.createDataFrame([("SRR1",), ("SRR1x",), (None,), ("xSRR2",)], "id string")
    assert rows(M.pattern_violations(ids, "id", r"SRR\d+")) == [("SRR1x",), ("xSRR2",), (None,)]


def test_gate_needs_acceptance_and_no_blocker(spark):
    v = spark.createDataFrame([("g1", "BLOCKER"), ("g1", "INFO"), ("g2", "REVIEW_REQUIRED")], "stage string, severity string")
    acc = spark.createDataFrame([("g1", True), ("g2", True), ("g3", False)], "stage string, accepted boolean")
    stages = spark.createDataFrame([(f"g{i}",) for i in range(1, 5)], "stage string")
    got = rows(G.gate_status(v, acc, stages), "stage", "worst", "may_proceed")
    assert got == [("g1", "BLOCKER", False), ("g2", "REVIEW_REQUIRED", True), ("g3", "NONE", False), ("g4", "NONE", False)]
