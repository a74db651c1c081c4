import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import op02_topk, op05_mixing, op06_toxicity, op09_packing
from tests.llm.fixtures import as_documents, pairs  # noqa: F401


def shares(sizes):
    """Targets by resharing in rounds, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    capped, left = {}, set(names)
    while True:
        rest = sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in left)
        over = [s for s in left if Fraction(rest * weight[s], total) > 3 * sizes[s]]
        if not over:
            return {**capped, **{s: Fraction(rest * weight[s], total) for s in left}}
        for s in over:
            capped[s] = 3 * sizes[s]
            left.discard(s)


def test_op5_targets_and_copies(spark, pairs):
    rows = pairs + [(100 + i, "w " * (i % 7)) for i in range(400)]
    docs = as_documents(spark, rows, sources=("a", "b", None, "é", "z", "a", "a", "a", "Ω"))
    got = op05_mixing.rates(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = shares(sizes)
    assert sum(want.values()) == sum(sizes.values())
    by = {(r.source_size, round(r.target, 6)) for r in got}
    assert by == {(sizes[s], round(float(want[s]), 6)) for s in sizes}
    assert all(r.taken == r.size * r.copies and r.taken <= 3 * r.size for r in got)
    again = op05_mixing.rates(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = op05_mixing.emit(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_op5_without_words(spark):
    assert op05_mixing.rates(as_documents(spark, [])).count() == 0
    got = op05_mixing.rates(as_documents(spark, [(1, None), (2, ""), (None, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3


def test_op5_rows_without_an_id_and_of_very_unequal_size(spark):
    """No id, one id or many: no source is off by more than a large document."""
    rng = random.Random(7)
    sizes = [int(1.5 ** rng.uniform(0, 20)) for _ in range(3000)]
    for ids in (lambda i: None, lambda i: 5, lambda i: i):
        docs = as_documents(spark, [(ids(i), "w " * n) for i, n in enumerate(sizes)], sources=("a", "b", "c", None))
        sums = op05_mixing.rates(docs).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"))
        for r in sums.collect():
            assert abs(r.taken - r.target) <= r.most, r


def test_op5_taken_comes_near_the_targets(spark):
    rng = random.Random(2)
    docs = as_documents(spark, [(i, "w " * rng.randint(1, 40)) for i in range(6000)], sources=("a", "a", "a", "b", "c", "d"))
    sums = op05_mixing.rates(docs).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.06 * r.target for r in sums)


def test_op2_ties_copies_and_bad_vectors(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 1) for i in range(260)]
    rows += [(300 + i, [0.5] * 6, 1) for i in range(60)] + [(320, [0.5] * 6, 1), (401, None, 1), (400, [1.0, None], 1), (420, [float("nan")] * 6, 1),
                                                          (440, [float("inf")] * 6, 1), (460, [], 1), (None, [1.0] * 6, 1), (480, [1e7] * 6, 1)]
    monkeypatch.setattr(op02_topk, "ROWS_PER_BLOCK", 64)
    monkeypatch.setattr(op02_topk, "QUERIES_PER_BLOCK", 8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in op02_topk.top_k(table).collect())
    v = {i: [int(np.floor(64 * float(np.float32(x)))) for x in e] for i, e, _ in rows
         if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    want = []
    for q in (i for i in v if i % 20 == 0):
        best = sorted(((-sum(a * b for a, b in zip(v[q], v[r], strict=False)), r) for r in v if r != q))[:20]
        want += [(q, n + 1, r, -s) for n, (s, r) in enumerate(best)]
    assert got == sorted(want)


def test_op2_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert op02_topk.top_k(spark.createDataFrame([], schema)).count() == 0
    got = op02_topk.top_k(spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 64 * 128)]


def test_op2_sends_no_block_through_the_driver(spark, monkeypatch):
    """Query blocks are repeated for every row block: broadcast, they would grow with the square of the table."""
    ran, store = [], op02_topk.Scratch.store

    def kept(self, df):
        ran.append(df)
        return store(self, df)

    monkeypatch.setattr(op02_topk.Scratch, "store", kept)
    monkeypatch.setattr(op02_topk, "ROWS_PER_BLOCK", 64)
    monkeypatch.setattr(op02_topk, "QUERIES_PER_BLOCK", 8)
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(600)], "vec_id long, embedding array<float>")
    found = op02_topk.top_k(table)
    assert found.count() == 30 * 20
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*ran, found]]
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("components", [4, 1 << 20])
def test_op2_blocks_of_very_unequal_range_in_small_steps(spark, monkeypatch, components):
    """Scores in floats, doubles and whole numbers meet under one cutoff; wide vectors make smaller blocks."""
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.normal(size=3 + i % 3) * 10.0 ** int(rng.integers(0, 7) if i % 9 == 0 else 0)]) for i in range(200)]
    monkeypatch.setattr(op02_topk, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(op02_topk, "QUERIES_PER_BLOCK", 4)
    monkeypatch.setattr(op02_topk, "COMPONENTS_PER_BLOCK", components)
    monkeypatch.setattr(op02_topk, "SCORES_PER_STEP", 20)
    got = sorted(tuple(r) for r in op02_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=7, every=10).collect())
    v = {i: [int(np.floor(64 * x)) for x in e] for i, e in rows}
    want = []
    for q in (i for i in v if i % 10 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[r], strict=False)), r) for r in v if r != q)[:7]
        want += [(q, n + 1, r, -s) for n, (s, r) in enumerate(best)]
    assert got == sorted(want)


public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_op9_pieces_round_trip(spark, pairs, tokenizer):
    rows = pairs + [(70, "x " * 1023), (71, "y")]
    got = op09_packing.packed(as_documents(spark, rows)).collect()
    text, copies = dict(rows), defaultdict(int)
    for i, _ in rows:
        copies[i] += 1
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for i, n in copies.items():
        ids = tokenizer.encode(text[i] or "", add_special_tokens=False).ids + [0]
        seen = np.zeros(len(ids), int)
        for r in pieces[i]:
            part = ids[r.start:r.start + r.length]
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            seen[r.start:r.start + r.length] += 1
        assert (seen == n).all()
    padding = 0
    for rs in windows.values():
        end = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= 1024
        padding += 0 if end & (end - 1) == 0 else 1024 - end
    assert padding <= 1024


def test_op9_encoder_equals_the_tokenizer(tokenizer, pairs):
    odd = ["a  b", "a   b", "a\n \nb", " a", "  a ", "a \n b", "x　 y", "a 　 b c", "<|endoftext|> <|endoftext|>x y", "don't  won't 's", "\n\n a",
           "a ", "", "é ü  ñ", "a\n b c", "a\x1c b \x1c c", "a\x85 b", "1 2 345", "…— x"]
    texts = odd + [t or "" for _, t in pairs]
    encoder = op09_packing.Encoder()
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_op9_differencing_and_empty(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 1023) for _ in range(200)]
    parts = op09_packing.difference(sizes, 100)
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert sorted(i for p in parts for i in p) == list(range(200)) and max(sums) - min(sums) < 700
    whole = op09_packing.pack(sizes, 1024, cut=False)
    assert max(sum(n for _, _, n in p) for p in whole) <= 1024 and all(n == sizes[i] for p in whole for i, _, n in p)
    cut = op09_packing.pack(sizes)
    assert len(cut) == -(-sum(sizes) // 1024) <= len(whole)
    # The textbook example: sums 14 and 16.
    assert sorted(sorted(p) for p in op09_packing.difference([8, 7, 6, 5, 4], 2)) == [[0, 2], [1, 3, 4]]
    assert op09_packing.packed(as_documents(spark, [])).count() == 0
    only = op09_packing.packed(as_documents(spark, [(1, None), (None, "")])).collect()
    assert sorted((r.doc_tokens, r.length) for r in only) == [(1, 1), (1, 1)]


def toxic_rows(rng, n):
    bad = ["idiot", "worthless", "moron", "scumbag", "disgusting"]
    letters = "aeourstnhlb"
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 80))]
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_op6_held_out_rows_and_disguises(spark):
    rows, labels = toxic_rows(random.Random(6), 600)
    docs = as_documents(spark, rows + [(1000, None), (1001, ""), (None, "x")])
    model = op06_toxicity.fit(*op06_toxicity.sample(docs, spark.createDataFrame(labels + [(0, 1, None)], "doc_id long, quality int, toxic int")))
    got = op06_toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + 3
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    test = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in test) / len(test) > 0.95

    def score(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return float(model.probability(model.rows_margin(raw, np.array([0, len(raw)])))[0])

    # Marks, gaps between letters and digits for letters leave a word what it is.
    for plain, disguised in (("you idiot", ("you i.d.i.o.t", "you i d i o t", "you 1d10t")), ("worthless", ("worthl-ess", "w*orthless")), ("moron", ("mor*on", "M0R0N"))):
        assert score(plain) > 5 * score("a harmless thing")
        assert all(score(d) == pytest.approx(score(plain), abs=0.02) for d in disguised)
    assert score("worthless moron and idiot") >= 0.7
    assert score("worthxless thing") > 2 * score("a harmless thing") and score("idioot") > 2 * score("idea of it")
    kept = op06_toxicity.clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def test_op6_without_labels(spark):
    docs = as_documents(spark, [(1, "a b"), (2, None)])
    model = op06_toxicity.fit(*op06_toxicity.sample(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert [r.predicted for r in op06_toxicity.score(docs, model).collect()] == [0, 0]


def test_statements_run_in_duckdb():
    from cohortlens.llm.registry import load

    queries, statements = load()
    assert set(statements) <= set(queries) and len(queries) == 10
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT CAST(1 AS BIGINT) AS doc_id, 'a b' AS text, 'en' AS lang, 's' AS source, CAST(3 AS BIGINT) AS n_chars")
    con.execute("CREATE TABLE embeddings AS SELECT CAST(20 AS BIGINT) AS vec_id, [CAST(1 AS FLOAT)] AS embedding, 1 AS label")
    for sql in statements.values():
        con.execute(sql).fetchall()
