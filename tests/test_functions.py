from pyspark.sql import functions as F

from cohortlens import functions as X


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"s {kind}").select(column.alias("v")).first()["v"]


def test_strip_version_variants(spark):
    cases = [("ENSG1.2", "ENSG1", "ENSG1"), ("ENSG1 .2", "ENSG1", "ENSG1 "), (" ENSG2.1 ", "ENSG2", "ENSG2"),
             ("", "", ""), (None, "", ""), ("\tENSG3\n", "ENSG3", "ENSG3"), ("a.b.c", "a", "a")]
    for raw, split_first, trim_first in cases:
        assert one(spark, raw, X.strip_version("s")) == split_first
        assert one(spark, raw, X.strip_version("s", trim_first=True)) == trim_first


def test_finite_or_null(spark):
    cases = {"": None, "NA": None, "nan": None, "inf": None, "-Infinity": None, " 1.5 ": 1.5, "1e-3": 0.001, "1.5d": None,
             "-.5": -0.5, "3.": 3.0, "1e999": None, "x1": None}
    for raw, want in cases.items():
        assert one(spark, raw, X.finite_or_null("s")) == want, raw


def test_text_cuts(spark):
    assert one(spark, "k = a=b ", X.after_first("s", "=")) == "a=b"
    assert one(spark, "none", X.after_first("s", "=")) == ""
    assert one(spark, "http://x/y/SAMN1 ", X.after_last("s", "/")) == "SAMN1"
    assert one(spark, " A\u00a0b ", X.normalise_value("s")) == "A b"
    assert one(spark, " PSA Level ", X.normalise_key("s")) == "psa level"
    assert one(spark, "Phase 1: a\nPhase 2: b", X.regex_last("s", r"Phase\s+[1-9]:[^<\n]+")) == "Phase 2: b"
    assert one(spark, "no", X.regex_last("s", "z")) == ""
    assert one(spark, "no", X.regex_first("s", "(z)")) is None


def test_numbers(spark):
    assert one(spark, 0.0, X.ratio(F.lit(1.0), "s"), "double") is None
    assert one(spark, 8.0, X.pct(F.lit(2), "s"), "double") == 25.0
    for x, digits, want in [(0.0, 2, 0.0), (123456.0, 2, 120000.0), (-0.0012345, 3, -0.00123), (9.99, 1, 10.0)]:
        assert abs(one(spark, x, X.signif("s", digits), "double") - want) < 1e-12


def test_lists_and_maps(spark):
    df = spark.createDataFrame([(["SF"], {"a": "1"}), ([], {}), (None, None)], "l array<string>, m map<string,string>")
    got = [tuple(r) for r in df.select(X.list_equals("l", ["SF"]), X.list_empty("l"), X.map_get("m", "a", "-")).collect()]
    assert got == [(True, False, "1"), (False, True, "-"), (False, True, "-")]


def test_analysis_id_depends_on_every_field(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("a", 1)], "x string, y int")
    ids = [r[0] for r in df.select(X.analysis_id("x", "y")).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3] and len(ids[0]) == 64


def test_text_id_keeps_numbers_wider_than_the_pad(spark):
    import duckdb

    from cohortlens.plans.registry import text_id

    numbers = [7, 99, 100, 8_000_000, 8_000_001, 500_000_000]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", text_id("G", F.col("n"), 2).alias("id"))
    got = {r.n: r.id for r in df.collect()}
    assert got == {7: "G07", **{n: f"G{n}" for n in numbers[1:]}}
    sql = "SELECT n, 'G' || lpad(CAST(n AS VARCHAR), CAST(greatest(2, length(CAST(n AS VARCHAR))) AS INTEGER), '0') FROM (SELECT unnest(?) AS n)"
    assert dict(duckdb.execute(sql, [numbers]).fetchall()) == got
