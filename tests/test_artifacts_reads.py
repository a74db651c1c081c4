import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators import artifacts as A
from cohortlens.operators import gates as G
from cohortlens.operators import reads as R


def test_reconcile_states(spark):
    exp = spark.createDataFrame([(k, 10, "h", "c") for k in "abcdefg"], "run string, size int, sha256 string, config string")
    inv = spark.createDataFrame([("a", True, False, 10), ("b", True, False, 10), ("c", True, False, 10), ("d", False, True, 10), ("e", False, False, 10),
                                 ("f", True, False, 11), ("g", True, False, 10)], "run string, has_final boolean, has_work boolean, source_size int")
    ev = spark.createDataFrame([("a", "h", "c"), ("b", "zzz", "c"), ("f", "h", "c"), ("g", "h", "other")], "run string, e_sha256 string, e_config string")
    assert rows(A.reconcile_artifacts(exp, inv, ev, "run")) == [
        ("a", "VALIDATED_SKIP"), ("b", "PROVENANCE_CONFLICT"), ("c", "UNVERIFIED_RESULT"), ("d", "INTERRUPTED"), ("e", "RUN"),
        ("f", "SOURCE_MUTATED"), ("g", "PROVENANCE_CONFLICT")]


def test_reuse_states(spark):
    # name, data, files, manifest, marker, policy, marker_ok, manifest_ok, content_ok, expected
    cases = [
        ("absent", 0, 0, 0, 0, None, 0, 0, 0, "download"), ("complete", 1, 1, 1, 1, "v2", 1, 1, 1, "reused"),
        ("corrupted", 1, 1, 1, 1, "v2", 1, 0, 1, "integrity_conflict"), ("manifest_only", 1, 1, 1, 0, None, 0, 1, 1, "recovered"),
        ("bad_manifest_only", 1, 1, 1, 0, None, 0, 0, 1, "integrity_conflict"), ("marker_only", 1, 1, 0, 1, "v2", 1, 1, 1, "integrity_conflict"),
        ("legacy", 1, 1, 1, 1, "v1", 0, 1, 1, "migrated"), ("legacy_bad", 1, 1, 1, 1, "v1", 0, 1, 0, "integrity_conflict"),
        ("orphan_metadata", 0, 0, 1, 0, None, 0, 1, 1, "integrity_conflict"), ("bare_valid", 1, 1, 0, 0, None, 0, 0, 1, "recovered"),
        ("bare_partial", 1, 1, 0, 0, None, 0, 0, 0, "download"),
    ]
    flags = ["has_data", "has_files", "has_manifest", "has_marker"]
    data = [(c[0], *[bool(x) for x in c[1:5]], c[5], *[bool(x) for x in c[6:9]]) for c in cases]
    df = spark.createDataFrame(data, "name string, " + ", ".join(f"{f} boolean" for f in flags)
                               + ", marker_policy string, marker_ok boolean, manifest_ok boolean, content_ok boolean")
    assert dict(rows(A.reuse_state(df, "v2"), "name", "state")) == {c[0]: c[9] for c in cases}


def test_digest_states(spark):
    cols = "path string, bytes int, sha256 string"
    exp = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x")], cols)
    obs = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "y"), ("e", 1, "x")], cols)
    assert dict(rows(A.verify_digests(exp, obs))) == {"a": "ok", "b": "size_mismatch", "c": "digest_mismatch", "d": "missing", "e": "extra"}


def test_stall_rule_across_chunks(spark):
    base = 1_700_000_000
    obs = [("r", 0, 5), ("r", 30, 5), ("r", 60, 6), ("r", 130, 6), ("r", 200, 6), ("r", 260, 7), ("q", 0, 1), ("q", 500, 1)]
    df = spark.createDataFrame([(r, base + t, s, i) for i, (r, t, s) in enumerate(obs)], "run string, t long, size int, id int")
    df = df.withColumn("ts", F.timestamp_seconds("t"))
    for chunk in (7, 100, 86_400):
        got = rows(A.stall_gaps(df, "run", "ts", "size", 100, "id", chunk_seconds=chunk), "id", "idle_seconds", "stalled")
        assert got == [(0, 0.0, False), (1, 30.0, False), (2, 0.0, False), (3, 70.0, False), (4, 140.0, True), (5, 0.0, False),
                       (6, 0.0, False), (7, 500.0, True)]


def test_progress_and_journal(spark):
    items = spark.createDataFrame([("a", True, False, False), ("b", False, True, False), ("c", False, False, True), ("d", False, False, False),
                                   ("e", True, False, False), ("e", False, False, False)], "stage string, ok boolean, running boolean, failed boolean")
    got = {r["stage"]: (r["status"], r["completed"], r["total"]) for r in A.stage_progress(items).collect()}
    assert got == {"a": ("done", 1, 1), "b": ("running", 0, 1), "c": ("attention", 0, 1), "d": ("pending", 0, 1), "e": ("attention", 1, 2)}
    j = spark.createDataFrame([("r1", "reused", 1, 5), ("r2", "integrity_conflict", 0, 9)], "accession string, status string, attempts int, duration_seconds int")
    assert tuple(A.run_report(j).first()) == (2, 1, 1, 1, 9)
    assert rows(A.failed_runs(j)) == [("r2",)]


def test_clip_tail(spark):
    df = spark.createDataFrame([([30, 10, 30, 5, 5],), ([5, 5],), ([],), ([20],)], "q array<int>")
    assert rows(R.clip_tail(df, "q", 20, 2), "clipped_length", "kept") == [(0, False), (0, False), (1, False), (3, True)]


def test_systematic_sample_is_even(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").alias("pos"), F.floor(F.col("id") / 64).alias("chunk"))
    got = [r["pos"] for r in R.systematic_sample(df, ["g"], "chunk", ["pos"], 40).orderBy("pos").collect()]
    assert len(got) == 40 and got[0] == 0 and set(np.diff(got)) == {25}
    assert R.systematic_sample(df, ["g"], "chunk", ["pos"], 5000).count() == 1000


def test_lookup_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    text = lambda n: "".join(rng.choice(list("ACGT"), n))
    panel = [(i, text(400)) for i in range(30)] + [(30, "AAAA" * 40), (31, "short"), (32, "")]
    seqs = [(i, panel[i % 30][1][i: i + 12 + 7 * (i % 9)]) for i in range(40)]
    seqs += [(100, text(50)), (101, "A"), (102, "short"), (103, "A" * 60), (104, "hort"), (105, panel[3][1])]
    want = sorted((s, p) for s, q in seqs for p, t in panel if q in t)
    got = R.overrepresented_lookup(spark.createDataFrame(seqs, "s int, q string"), spark.createDataFrame(panel, "p int, t string"), "s", "q", "p", "t")
    assert rows(got) == sorted(want, key=lambda t: tuple((False, str(v)) for v in t))


def test_variant_stability_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a = np.round(rng.gamma(1.0, 40, 300))
    b = np.round(a * np.exp(rng.normal(0, 0.4, 300)))
    frame = lambda v: spark.createDataFrame([("s", i, float(x)) for i, x in enumerate(v)], "s string, f int, v double")
    got = R.variant_stability(frame(a), frame(b), "f", "v", ["s"], k=50).first()
    kept = (a >= 10) | (b >= 10)
    ratio = np.abs(np.log2((b[kept] + 1) / (a[kept] + 1)))
    assert got["n_features"] == kept.sum() and got["n_two_fold"] == (ratio >= 1).sum()
    assert got["pearson_log1p"] == pytest.approx(np.corrcoef(np.log1p(a[kept]), np.log1p(b[kept]))[0, 1])
    assert got["p95_abs_log2"] == pytest.approx(np.quantile(ratio, 0.95))
    top = lambda v: {i for i, _ in sorted(enumerate(v), key=lambda t: (-t[1], t[0]))[:50]}
    assert got["top_shared"] == len(top(a) & top(b))


def test_reference_check(spark):
    names = lambda xs: spark.createDataFrame([(i + 1, x) for i, x in enumerate(xs)], "ordinal long, name string")
    mapping = lambda d: spark.createDataFrame(list(d.items()), "feature_id string, gene_id string")
    tx, dec = names(["A.1", "B.1", "C.1"]), names(["chr1"])
    edges = spark.createDataFrame([("A.1", "B.1")], "retained string, duplicate string")
    good = mapping({"A.1": "G1", "B.1": "G2", "C.1": "G2"})
    run = lambda **k: rows(G.check_reference(**{"transcripts": tx, "decoys": dec, "combined": names(["A.1", "B.1", "C.1", "chr1"]),
                                               "mapping": good, "edges": edges, "id_pattern": r"G\d+", **k}), "rule", "key")
    assert run() == []
    assert run(combined=names(["A.1", "C.1", "B.1", "chr1"])) == [("combined_order", "2"), ("combined_order", "3")]
    assert run(mapping=mapping({"A.1": "G1", "B.1": "G2", "C.1": "X2"})) == [("group_pattern", "X2")]
    assert run(mapping=mapping({"A.1": "G1", "B.1": "G2"})) == [("map_coverage", "C.1")]
    assert run(edges=spark.createDataFrame([("A.1", "Z")], "retained string, duplicate string")) == [("edge_unmapped", "Z")]
