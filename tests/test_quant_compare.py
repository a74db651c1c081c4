import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators import compare as C
from cohortlens.operators import quant as Q

GENES = {0: "gA", 1: "gA", 2: "gA", 3: "gB", 4: "gB", 5: "gC", 6: "gC", 7: "gC", 8: "gC", 9: "gD", 10: "gD", 11: "gD"}


@pytest.fixture(scope="module")
def quant(spark):
    """Six samples, twelve features, four genes; gD is all zero and gB is zero in sample s0."""
    data = []
    for s in range(6):
        raw = []
        for f in range(12):
            reads = float((f + 1) * (s + 2) % 7 + 1)
            if GENES[f] == "gD" or (GENES[f] == "gB" and s == 0):
                reads = 0.0
            raw.append((f"s{s}", f, 100.0 + 10 * f, reads))
        total = sum(r[3] / r[2] for r in raw)
        data += [(a, b, c, 1e6 * d / c / total, d) for a, b, c, d in raw]
    return spark.createDataFrame(data, "sample_id string, feature_id int, eff_len double, tpm double, num_reads double").cache()


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame(list(GENES.items()), "feature_id int, gene_id string")


def test_rollup_and_length_fill(spark, quant, mapping):
    mapped = Q.map_features(quant, mapping)
    raw = Q.group_rollup(mapped)
    assert Q.rollup_conservation(quant, raw).first()["max_abs_delta"] == 0
    pdf = mapped.toPandas()
    one = pdf[(pdf.gene_id == "gA") & (pdf.sample_id == "s3")]
    got = raw.where("gene_id = 'gA' and sample_id = 's3'").first()
    assert got["count"] == one.num_reads.sum()
    assert got["length"] == pytest.approx((one.tpm * one.eff_len).sum() / one.tpm.sum())
    filled = Q.fill_group_length(Q.densify(raw, [f"s{i}" for i in range(6)]), Q.mean_feature_length(mapped)).toPandas()
    assert len(filled) == 24 and filled["length"].notna().all()
    b = filled[filled.gene_id == "gB"].set_index("sample_id")["length"]
    assert b["s0"] == pytest.approx(math.exp(np.log(b.drop("s0")).mean()))
    assert set(filled[filled.gene_id == "gD"]["length"].round(6)) == {200.0}


def test_densify_fills_absent_cells(spark):
    genes = spark.createDataFrame([("g", "s0", 5.0, 1.0, 9.0)], "gene_id string, sample_id string, count double, tpm double, length double")
    assert rows(Q.densify(genes, ["s0", "s1"])) == [("g", "s0", 5.0, 1.0, 9.0), ("g", "s1", 0.0, 0.0, None)]


def test_validate_quant_names_each_broken_rule(spark, quant):
    metrics = Q.quant_metrics(quant)
    meta_schema = ("sample_id string, num_processed long, num_mapped long, num_valid_targets long, index_seq_hash string, "
                   "library_types array<string>, quant_errors array<string>, em_converged boolean")
    good = ("s{}", 100, 50, 12, "h", ["SF"], [], True)
    bad = {1: (1, 99, "read_count"), 2: (2, 0, "mapped"), 3: (4, "x", "index_identity"), 4: (5, ["A"], "library_mode"), 5: (7, False, "converged")}
    data = []
    for s in range(6):
        row = [good[0].format(s), *good[1:]]
        if s in bad:
            row[bad[s][0]] = bad[s][1]
        data.append(tuple(row))
    expected = spark.createDataFrame([(f"s{s}", 100, "h", 12) for s in range(6)], "sample_id string, reads long, index_hash string, n_targets long")
    got = rows(Q.validate_quant(metrics, spark.createDataFrame(data, meta_schema), expected))
    assert got == [(f"s{s}", bad[s][2]) for s in sorted(bad)]
    # A repeated feature breaks both the row count and the uniqueness of ids.
    twice = quant.unionByName(quant.where("sample_id = 's0' and feature_id = 11"))
    got = rows(Q.validate_quant(Q.quant_metrics(twice), spark.createDataFrame(data[:1], meta_schema), expected.where("sample_id = 's0'")))
    assert got == [("s0", "row_count"), ("s0", "unique_ids")]


def test_pearson_guards_and_large_offset(spark):
    df = spark.createDataFrame([("const", 1.0, 2.0), ("const", 1.0, 3.0), ("one", 1.0, 1.0), ("neg", 1.0, 3.0), ("neg", 2.0, 1.0),
                                ("neg", None, 1.0)] + [("far", 1e9 + i, 2e9 - 3.0 * i) for i in range(50)], "g string, x double, y double")
    got = {r["g"]: (r["n"], r["r"]) for r in C.pearson(df, "x", "y", ["g"]).collect()}
    assert got["const"] == (2, None) and got["one"] == (1, None)
    assert got["neg"][0] == 2 and got["neg"][1] == pytest.approx(-1)
    assert got["far"][1] == pytest.approx(-1)


def test_spearman_with_ties(spark):
    x, y = [1, 2, 2, 3, 5, 5], [2, 1, 4, 4, 9, 7]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    rx, ry = np.array([1, 2.5, 2.5, 4, 5.5, 5.5]), np.array([2, 1, 3.5, 3.5, 6, 5])
    assert C.spearman(df, "x", "y").first()["r"] == pytest.approx(np.corrcoef(rx, ry)[0, 1])


def test_two_direction_rules_differ_on_zeros_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, -2.0), (0.0, 5.0), (0.0, 0.0), (None, 1.0)], "x double, y double")
    strict = C.direction_concordance(df, "x", "y").first()
    assert (strict["n_pairs"], strict["concordant"], strict["opposed"], strict["zero"]) == (4, 1, 1, 2)
    assert C.direction_concordance(df, "x", "y", null_as_zero=True).first()["zero"] == 3
    side = "k int, lfc double, padj double"
    a = spark.createDataFrame([(1, 0.0, 0.01), (2, 1.0, 0.01), (3, None, 0.01), (4, 1.0, 0.05)], side)
    b = spark.createDataFrame([(1, 0.0, 0.01), (2, -1.0, 0.01), (3, 1.0, 0.01), (4, 1.0, 0.01)], side)
    assert rows(C.sign_concordance(a, b, "k", "lfc"), "k", "same_sign") == [(1, True), (2, False), (3, None)]


def test_overlap_metrics_and_categories(spark):
    pub = spark.createDataFrame([("a", 1.0), ("b", -1.0), ("c", 0.0), ("d", 2.0), ("e", 1.0), ("f", 1.0)], "gene_key string, published_lfc double")
    ours = spark.createDataFrame([("a", 1.0, 0.001, 0.01), ("b", 1.0, 0.01, 0.2), ("c", 1.0, 0.6, 0.9), ("d", 1.0, None, None),
                                  ("e", 1.0, 0.2, None), ("x", 1.0, 0.001, 0.04), ("y", 1.0, 0.5, 0.8)],
                                 "gene_key string, lfc double, pvalue double, padj double")
    m = C.overlap_metrics(pub, ours).first()
    assert (m["published"], m["ours"], m["overlap"], m["union_size"], m["published_only"], m["ours_only"]) == (6, 2, 1, 7, 5, 1)
    assert (m["published_up"], m["published_down"], m["published_in_universe"]) == (4, 2, 5)
    assert C.overlap_metrics(pub, ours, zero_as="none").first()["published_down"] == 1
    assert m["jaccard"] == pytest.approx(1 / 7)
    joined = pub.join(ours.withColumn("seen", F.lit(True)), "gene_key", "left")
    got = dict(rows(C.discordance_category(joined, F.col("seen").isNotNull(), "pvalue", "padj"), "gene_key", "category"))
    assert got == {"a": "our_significant", "b": "our_nominal_p_below_0.05_but_BH_not", "c": "our_not_significant_nominal",
                   "d": "our_raw_p_unavailable", "e": "our_BH_padj_unavailable", "f": "absent_from_our_nonzero_gene_universe"}


def test_discordance_table_and_guards(spark):
    published = spark.createDataFrame([("a", 1.0, 0.01, "t"), ("b", -1.0, 0.02, "t"), ("c", 2.0, 0.03, "u")], "gene_key string, published_lfc double, fdr double, gene_type string")
    ours = spark.createDataFrame([("a", 1.5, 0.001, 0.01), ("b", 1.0, 0.04, 0.2), ("d", 3.0, 0.001, 0.01)], "gene_key string, lfc double, pvalue double, padj double")
    types = spark.createDataFrame([("a", "x"), ("b", "y")], "gene_key string, type string")
    got = rows(C.discordance_table(C.compare_full(published, ours), types))
    assert got == [("a", "shared_DE", "our_significant", "t", "x", True),
                   ("b", "published_only", "our_nominal_p_below_0.05_but_BH_not", "t", "y", False),
                   ("c", "published_only", "absent_from_our_nonzero_gene_universe", "u", "unannotated", None),
                   ("d", "ours_only", "not_in_published_DE_table", None, "unannotated", None)]
    bad = spark.createDataFrame([("a", 0.01), ("a", 0.02), ("b", None), ("c", 0.05), ("d", 0.01)], "gene_key string, fdr double")
    assert rows(C.comparator_violations(bad, "gene_key", "fdr")) == [("duplicate_id", "a", 2), ("fdr_not_significant", "c", 1), ("missing_fdr", "b", 1)]
    left, right = (spark.createDataFrame([(x,) for x in s], "id string") for s in (["a", "b", "b", None], ["b", "c", None]))
    assert rows(C.set_algebra(left, right, "id")) == sorted([("a", "a_only"), ("a", "union"), ("b", "intersect"), ("b", "union"), ("c", "b_only"),
                                                             ("c", "union"), (None, "intersect"), (None, "union")], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_sets_order_and_partition(spark):
    a = spark.createDataFrame([(i, v) for i, v in enumerate("abc", 1)], "ordinal int, v string")
    b = spark.createDataFrame([(i, v) for i, v in enumerate("acb", 1)], "ordinal int, v string")
    assert rows(C.ordered_mismatches(a, b, "ordinal", "v"), "ordinal") == [(2,), (3,)]
    tail = spark.createDataFrame([(1, "d")], "ordinal int, v string")
    assert rows(C.ordered_mismatches(tail, tail, "ordinal", "v", offset=3), "ordinal") == [(1,), (4,)]
    ids = lambda s: spark.createDataFrame([(x,) for x in s], "id string")
    assert rows(C.partition_violations(ids("abb"), ids("abc"), "id")) == [("b", 2, "in_several_parts"), ("c", 0, "not_covered")]
    assert rows(C.partition_violations(ids("abcz"), ids("abc"), "id")) == [("z", 1, "outside_whole")]
    assert rows(C.unmatched_keys(ids("ab"), ids("bc"), "id")) == [("a", "left_only"), ("c", "right_only")]
    venn = {(r["l"], r["r"]): r["n"] for r in C.venn_table([("l", ids("abq")), ("r", ids("bc"))], ids("abcd"), "id").collect()}
    assert venn == {(True, False): 1, (True, True): 1, (False, True): 1, (False, False): 1}


def test_groups_and_pairs(spark, mapping):
    edges = spark.createDataFrame([(0, 1), (2, 3), (3, 99)], "retained int, duplicate int")
    assert tuple(C.cross_group_pairs(edges, mapping, "retained", "duplicate").first()) == (3, 1, 1, 1)
    types = spark.createDataFrame([("gA", "coding"), ("gB", "other")], "gene_id string, gene_type string")
    gone = spark.createDataFrame([(3,), (4,), (0,)], "feature_id int")
    assert rows(C.groups_without_retained(mapping, gone, types)) == [("other", 1)]
