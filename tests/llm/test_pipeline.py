from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import op06_toxicity, op08_minhash
from cohortlens.llm.base import Scratch
from tests.llm.fixtures import as_documents, pairs  # noqa: F401
from tests.llm.test_dedup import links, smallest
from tests.llm.test_mix import shares
from tests.llm.test_text import base_spans

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_stages_against_brute_force(spark):
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(scratch.store(stage(spark, tables[-1], SF)))
    rows = [{r.doc_id: r for r in t.collect()} for t in tables[:-1]]
    assert all(t.columns == docs.columns for t in tables[:-1])
    # 6: the rows that stay are those that the model scores below the threshold.
    model = op06_toxicity.fit(*op06_toxicity.sample(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    for i, r in rows[0].items():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        assert (i in rows[1]) == (model.probability(model.rows_margin(raw, np.array([0, len(raw)])))[0] < op06_toxicity.THRESHOLD)
    # 8: one document of each group of near copies, and (nearly) no link of 0.8 is missed.
    sets, linked = links([(i, r.text) for i, r in rows[1].items()], 80)
    assert set(rows[2]) == {i for i, c in smallest(sets, linked).items() if i == c}
    # 10: base spans are replaced, the rest of the text stays.
    for i, r in rows[2].items():
        text = out = r.text
        for a, k, b in reversed(base_spans(text)):
            out = out[:a] + "[" + ("EMAIL", "IP", "CARD", "PHONE")[k] + "]" + out[b:]
        assert rows[3][i].text == out and rows[3][i].n_chars == len(out) or out == text
    # 5: copies follow the sources' rates.
    sizes: dict = {}
    for r in rows[3].values():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    want = shares(sizes)
    copies = {}
    for r in tables[4].select("doc_id").collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for i, r in rows[3].items():
        rate = want[r.source] / sizes[r.source]
        assert int(rate) <= copies.get(i, 0) <= int(rate) + 1
    # 9: all ids of all copies are packed.
    pieces = tables[5].collect()
    total: dict = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    size = {p.doc_id: p.doc_tokens for p in pieces}
    assert total == {i: size[i] * n for i, n in copies.items()}


def test_stages_take_odd_tables(spark, pairs, tmp_path):
    spark.createDataFrame([(3, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in ([], pairs + [(None, "no id"), (None, None)]):
        docs = as_documents(spark, rows)
        scratch = Scratch(spark, "test")
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = scratch.store(stage(spark, now, str(tmp_path)))
            assert now.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
        assert packed.count() >= now.count()


def test_stages_take_columns_with_their_own_names(spark, pairs, tmp_path):
    """All names that the stages use themselves, as columns of the input."""
    names = ("_copy _spans _s _print _row _rate _low print low n none id doc row base all kind start end added spans cut of name nameless "
             "slice place rate copies size source_size target score text_ component_id n_shingles signature key family _ord_v _ord_in").split()
    spark.createDataFrame([(3, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(i, t, "en", "s", 1, *[f"{n}{i}" for n in names]) for i, t in [*pairs[:14], (None, "mail me at a.b@c.org now")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    now, scratch = docs, Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = scratch.store(stage(spark, now, str(tmp_path)))
        assert now.columns == docs.columns, name
        assert all(r["_copy"] == f"_copy{r.doc_id}" and r["base"] == f"base{r.doc_id}" for r in now.collect())
    assert any(r.text == "mail me at [EMAIL] now" for r in now.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() >= now.count()


def test_near_stage_goes_by_text_and_not_by_id(spark):
    text = lambda k: " ".join(f"{k}v{i}" for i in range(40))
    rows = [(3, text("a")), (3, text("b")), (3, text("b")), (None, text("c")), (None, text("c") + " end"), (None, text("a")),
            (4, ""), (4, ""), (5, None)]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, as_documents(spark, rows), "").collect()]
    c = [r for r in got if r[1] and r[1].startswith("cv")]
    assert len(c) == 1 and c[0][0] is None
    assert sorted((r for r in got if r not in c), key=str) == sorted([rows[i] for i in (0, 1, 6, 7, 8)], key=str)


def test_near_duplicates_take_a_rule(spark):
    base = [f"w{i}" for i in range(120)]
    near = list(base)
    near[30], near[90] = "x", "y"
    rows = [(1, " ".join(base)), (2, " ".join(near))]
    assert len(links(rows, 84)[1]) == 1 and not links(rows, 85)[1]
    docs = as_documents(spark, rows)
    kept = lambda **rule: {r.doc_id for r in op08_minhash.near_duplicates(docs, **rule).where("kept").collect()}
    assert kept() == {1, 2} and kept(rule=op08_minhash.Rule(coordinates=64, min_matches=34, numerator=80)) == {1}
