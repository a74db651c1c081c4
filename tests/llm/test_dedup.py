import hashlib
import random
from collections import defaultdict

import numpy as np

from cohortlens.llm import op01_suffix, op04_substring, op08_minhash
from cohortlens.llm.base import Scratch, components
from tests.llm.fixtures import as_documents, pairs, prose  # noqa: F401

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    out = (text or "").translate(FOLD)
    for c in SPACE:
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def shingle_set(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def smallest(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def cut(rows):
    """doc -> the four figures of op1, by a dictionary of all 50-byte strings."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            first.setdefault(raw[k:k + 50], i)
    out = {}
    for i, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49):
            if first[raw[k:k + 50].tobytes()] < i:
                gone[k:k + 50] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest())
    return out


def test_op1_equals_brute_force(spark, pairs):
    got = op01_suffix.remove_repeats(as_documents(spark, pairs)).collect()
    want = cut(pairs)
    assert len(got) == len(pairs)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert sum(r.n_removed for r in got) > 10_000


def test_op1_empty_table_and_missing_id(spark):
    assert op01_suffix.remove_repeats(as_documents(spark, [])).count() == 0
    text = "x" * 30 + "y" * 40
    got = {r.doc_id: r.n_removed for r in op01_suffix.remove_repeats(as_documents(spark, [(None, text), (2, text), (9, text)])).collect()}
    assert got == {None: 0, 2: 0, 9: 70}


def test_column_rounds_against_all_pairs():
    rng = np.random.default_rng(3)
    n, width = 40, op01_suffix.COLUMNS
    symbols = rng.integers(0, 2, (width, n)).astype(np.int16)
    symbols[:, 10:30] = symbols[:, [5]]
    symbols[70, 20] = 9
    symbols[5, 15] = 9
    group, doc = np.repeat([0, 1], [25, 15]), rng.permutation(n)
    got = op01_suffix.column_rounds(symbols, group, doc)
    for column in range(op01_suffix.WINDOW):
        for i in range(n):
            part = symbols[column:column + 50, i]
            same = [doc[j] for j in range(n) if group[j] == group[i] and (symbols[column:column + 50, j] == part).all()]
            assert got[column, i] == min(same)


def links(rows, numerator, low=0):
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    return sets, [(a, b) for x, a in enumerate(ids) for b in ids[:x]
                  if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])]


def test_op8_equals_brute_force(spark, pairs):
    got = op08_minhash.near_duplicates(as_documents(spark, pairs)).collect()
    sets, linked = links(pairs, 85)
    want = smallest(sets, linked)
    assert len(got) == len(pairs)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id), r
    assert len(linked) > 3


def test_op8_family_over_several_blocks(spark, monkeypatch):
    import random

    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    monkeypatch.setattr(op08_minhash, "RULE", op08_minhash.Rule(coordinates=64, min_matches=40, numerator=85, block=16))
    got = {r.doc_id: r.component_id for r in op08_minhash.near_duplicates(as_documents(spark, rows)).collect()}
    sets, linked = links(rows, 85)
    assert got == smallest(sets, linked)


def test_op8_empty_table_and_missing_id(spark):
    assert op08_minhash.near_duplicates(as_documents(spark, [])).count() == 0
    rows = [(None, "a b c d e f g"), (3, "a b c d e f g"), (4, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op08_minhash.near_duplicates(as_documents(spark, rows)).collect()}
    assert got[3] == (3, 3) and got[4] == (0, 4)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7)]
    found = components(Scratch(spark, "test"), spark.createDataFrame(edges, "u long, v long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_op4_paragraphs_and_passages(spark, pairs):
    got = op04_substring.repeated_parts(as_documents(spark, pairs)).collect()
    parts = {}
    for i, t in pairs:
        for k, line in enumerate((t or "").split("\n")):
            if len(words(line)) >= op04_substring.MIN_WORDS:
                parts[(i << 24) + k] = line
    sets, linked = links(list(parts.items()), 80)
    want = smallest(sets, linked)
    members = defaultdict(set)
    for p, c in want.items():
        members[c].add(p >> 24)
    expected = {(p >> 24, p & (2**24 - 1), c) for p, c in want.items() if len(members[c]) > 1}
    assert {(r.doc_id, r.position, r.cluster_id) for r in got if r.unit == "paragraph"} == expected
    passages = {r.doc_id for r in got if r.unit == "passage"}
    assert {3, 5, 6, 9, 10, 11, 12} <= passages and not passages & {1, 2, 8, 16, *range(20, 32)}
    assert {r.doc_id for r in got if r.unit == "passage" and r.removed} >= {5, 6, 10, 12}


def test_op4_empty_table(spark):
    assert op04_substring.repeated_parts(as_documents(spark, [(None, "x " * 60), (1, None), (2, "")])).count() == 0


def removed_words(rows, window=25):
    """doc -> words under a window that an earlier place holds, by a dictionary of all windows."""
    first, out = {}, {}
    for i, t in sorted(rows):
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            at = first.setdefault(tuple(w[k:k + window]), (i, k))
            if at[0] < i or k >= at[1] + window:
                gone.update(range(k, k + window))
        out[i] = gone
    return out


def marked(got):
    out = defaultdict(set)
    for r in got:
        if r.unit == "passage" and r.removed:
            out[r.doc_id].update(range(r.position, r.position + r.n_words))
    return out


def test_op4_removes_the_words_that_an_earlier_place_holds(spark):
    rng = random.Random(2)
    a, body, tail, own = prose(rng, 60), prose(rng, 80), prose(rng, 70), prose(rng, 26)
    five = body + " " + a + " " + tail
    rows = [(1, prose(rng, 9) + " " + a), (5, five), (9, five), (12, prose(rng, 30) + " " + own), (13, own + " " + prose(rng, 30)),
            (20, "x " * 90), (21, body + " " + prose(rng, 40) + " " + body), (2, prose(rng, 24))]
    got = op04_substring.repeated_parts(as_documents(spark, rows)).collect()
    want, found = removed_words(rows), marked(got)
    assert {i: found[i] for i, _ in rows} == want
    # The first holder keeps the body around the passage, and loses the passage.
    assert want[5] == set(range(80, 140)) and want[9] == set(range(210)) and want[20] == set(range(25, 90)) and len(want[13]) == 26
    clusters = {(r.doc_id, r.removed): r.cluster_id for r in got if r.unit == "passage" and r.doc_id in (12, 13)}
    assert len(clusters) == 2 and len(set(clusters.values())) == 1


def test_op4_wide_ids(spark):
    rng = random.Random(4)
    line, other = prose(rng, 30), prose(rng, 30)
    low, high = 2**62 + 1, 2**62 + 1 + 2**40
    rows = [(low, line), (high, other + "\n" + line), (2**62 + 7, prose(rng, 30)), (7, prose(rng, 30)), (-(2**62), other)]
    got = [r for r in op04_substring.repeated_parts(as_documents(spark, rows)).collect() if r.unit == "paragraph"]
    assert {(r.doc_id, r.position, r.first_doc_id, r.removed) for r in got} == {
        (low, 0, low, False), (high, 1, low, True), (-(2**62), 0, -(2**62), False), (high, 0, -(2**62), True)}
    assert {r.cluster_id for r in got} == {low << 24, -(2**62) << 24}


def test_op4_wrapped_and_short_paragraphs_and_copies_in_a_document(spark):
    rng = random.Random(6)
    w, short = prose(rng, 60).split(), prose(rng, 7)
    near = list(w)
    near[24] = "changed"
    wrap = lambda ws, n: "\n".join(" ".join(ws[k:k + n]) for k in range(0, len(ws), n))
    rows = [(1, wrap(w, 12) + "\n\n" + short), (2, prose(rng, 11) + "\n\n" + wrap(near, 17)), (3, " ".join(w)),
            (4, short + "\n\n" + prose(rng, 9) + "\n\n" + short), (5, prose(rng, 30) + "\nend")]
    got = {(r.doc_id, r.unit, r.position): r for r in op04_substring.repeated_parts(as_documents(spark, rows)).collect() if r.unit != "passage"}
    assert {k: (r.first_doc_id, r.removed) for k, r in got.items()} == {
        (1, "block", 0): (1, False), (2, "block", 2): (1, True), (3, "paragraph", 0): (1, True),
        (1, "paragraph", 6): (1, False), (4, "paragraph", 0): (1, True), (4, "paragraph", 4): (1, True)}


def test_op4_reads_the_windows_of_equal_blocks_once_and_keeps_no_table(spark):
    class Kept(Scratch):
        def store(self, df):
            stored = super().store(df)
            sizes.append((set(stored.columns), stored.count()))
            return stored

    sizes, rng = [], random.Random(8)
    text = prose(rng, 60).split()
    rows = [(i, " ".join(text)) for i in range(1, 31)] + [(40, " ".join(text[:50])), (41, " ".join(text[8:]) + " " + prose(rng, 9)), (50, prose(rng, 70))]
    docs = as_documents(spark, rows).selectExpr("doc_id", "text", "xxhash64(text) as part")
    scratch = Kept(spark, "test")
    got = op04_substring.passage_clusters(docs, scratch).collect()
    found = marked(got)
    assert {i: found[i] for i, _ in rows} == removed_words(rows)
    assert {r.cluster_id for r in got} == {1 << 24} and {r.first_doc_id for r in got} == {1}
    # 32 copies hold about 900 windows; what differs at three ends is read once for each of the three texts.
    assert max(n for columns, n in sizes if {"key", "start"} <= columns and "anchor" not in columns and "equal" not in columns) <= 3 * 4 * op04_substring.SPAN
    assert len([p for p in scratch.paths if p]) <= 3


def test_op4_passages_cut_at_random_places(spark):
    rng = random.Random(9)
    pool = [prose(rng, 90).split() for _ in range(3)]
    rows = []
    for i in rng.sample(range(-50, 10**6), 60):
        w = []
        for _ in range(3):
            p, a = rng.choice(pool), rng.randrange(60)
            w += p[a:a + rng.randint(5, 80)] + prose(rng, rng.choice((0, 0, 3, 20))).split()
        rows.append((i, " ".join(w)))
    got = op04_substring.repeated_parts(as_documents(spark, rows)).collect()
    want, found = removed_words(rows), marked(got)
    assert {i: found[i] for i, _ in rows} == want and sum(map(len, want.values())) > 3000


def test_op4_lists_keep_the_rows_whose_key_comes_again():
    import pyarrow as pa

    batch = lambda doc, key: pa.record_batch({"doc": pa.array(doc, pa.int64()), "key": pa.array(key, pa.int64())})
    out = pa.Table.from_batches(op04_substring._shared(iter([batch([1, 2, 3], [7, -2, 5]), batch([4, 5, 6], [-2, 9, 7]), batch([8], [7])])))
    assert sorted(zip(out["key"].to_pylist(), out["doc"].to_pylist(), strict=True)) == [(-2, 2), (-2, 4), (7, 1), (7, 6), (7, 8)]
    assert not list(op04_substring._shared(iter([]))) and next(op04_substring._shared(iter([batch([], [])]))).num_rows == 0
