import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from cohortlens.llm import op11_search, op12_filters, op13_html
from tests.llm.fixtures import as_documents, pairs, prose  # noqa: F401

ITEM_COLUMNS = "item_id long, text string, item int, doc_id long, print long, rank int, score long"


def as_items(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], ITEM_COLUMNS)


def terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def ranked(documents, items):
    """Score every document for every item."""
    bags = [(d, Counter(terms(t))) for d, t in documents]
    with_terms = [b for _, b in bags if b]
    n_docs, n_terms = len(with_terms), sum(sum(b.values()) for b in with_terms)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for doc, bag in bags:
            n, score = sum(bag.values()), 0
            for t in terms(text):
                if bag[t]:
                    df = sum(t in b for b in with_terms)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -score) for k, (score, none, doc) in enumerate(sorted(scores)[:10])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus(pairs):  # noqa: F811
    rng = random.Random(11)
    passage = prose(rng, 25)
    rows = pairs + [(None, "one two three"), (None, passage), (200, "two " * 70 + "three"), (201, "ONE-two_three " * 9)]
    # Many copies of one text and equal scores at the tenth place.
    return rows + [(300 + i, passage + " the end") for i in range(40)] + [(2**62 + 1, passage)]


def test_op11_against_all_scores(spark, corpus):
    base = dict(corpus)[3]
    items = [(0, base[:300]), (1, "one two"), (1, "two three two"), (2, None), (3, ""), (4, "...  "), (5, "nowhere-to-be-found"),
             (6, dict(corpus)[2**62 + 1]), (6, dict(corpus)[2**62 + 1]), (None, "ONE Three é"), (7, "0 1 2 the end " + base[:40])]
    got = op11_search.search(as_documents(spark, corpus), as_items(spark, items))
    assert found(got) == ranked(corpus, items)


def test_op11_small_blocks(spark, corpus, monkeypatch):
    """Several blocks of items and of documents, and sums in several steps."""
    rng = random.Random(3)
    texts = [t for _, t in corpus if t and len(t) > 200]
    items = [(i, " ".join(rng.choice(texts)[:400].split()[:12])) for i in range(7)]
    for name, value in (("ITEMS", 3), ("TERM_STEP", 5), ("BLOCK_DOCS", 8)):
        monkeypatch.setattr(op11_search, name, value)
    assert found(op11_search.search(as_documents(spark, corpus), as_items(spark, items))) == ranked(corpus, items)


def test_op11_bounds_are_above_the_scores(corpus):
    import pyarrow as pa

    docs = [(d, t) for d, t in corpus if t is not None]
    batch = pa.record_batch({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs]),
                             "print": pa.array(range(len(docs)), pa.int64())})
    rows = [r for b in op11_search._index([batch]) for r in b.to_pylist()]
    assert sorted(p for r in rows for p in r["prints"]) == [i for i, (_, t) in enumerate(docs) if terms(t)]
    words = sorted({w.encode() for _, t in docs for w in terms(t)})
    hashes, _ = op11_search.word_hashes(*op11_search._bytes(words), op11_search._TERM)
    order = hashes.argsort()
    names = [words[i] for i in order]
    block = op11_search.Block([(0, 0, Counter(names[:40])), (1, 1, Counter(names[20:90]))], names, hashes[order])
    block.n_docs, block.n_terms = 50, 9000
    block.weight = 100 + 0 * order
    for r in rows:
        bounds = op11_search._upper_bounds(block, block.weights(), r)
        for at, p in enumerate(r["prints"]):
            bag = Counter(w.encode() for w in terms(docs[p][1]))
            m = 25 + 75 * r["sizes"][at] * 50 // 9000
            for i, (_, _, q) in enumerate(block.items):
                score = sum(c * 100 * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, c in q.items() if bag[t])
                assert score <= bounds[i, at]


def test_op11_empty_tables(spark, corpus):
    some = [(1, "one")]
    assert found(op11_search.search(as_documents(spark, []), as_items(spark, some))) == []
    assert found(op11_search.search(as_documents(spark, [(1, None), (2, " -")]), as_items(spark, some))) == []
    assert found(op11_search.search(as_documents(spark, corpus), as_items(spark, []))) == []


# --- op12 ---------------------------------------------------------------------------

def failing(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {name for name, fails in (("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                                     ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", re.search(r"[#$%&*|]", text))) if fails}


def audited(rows, labels):
    """rows: (doc_id, text, lang). Runs every order over every document."""
    low = {}
    for doc, text, _ in rows:
        if doc is not None:
            low[text or ""] = min(doc, low.get(text or "", doc))
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    docs = [(lang or "", failing(text or "") | ({"E"} if doc is not None and doc > low[text or ""] else set()), doc in good, doc in toxic)
            for doc, text, lang in rows]
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                fails = [d for d in docs if d[0] == part and name in d[1]]
                out[part, order, step] = [len(left), len(gone), len(fails) - len(gone), sum(d[1] == {name} for d in fails),
                                          sum(d[2] for d in gone), sum(d[3] for d in gone)]
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_of(spark, rows, labels):
    columns = "doc_id long, text string, lang string, source string, row long, part string, bit int, print string, good int, low long"
    docs = spark.createDataFrame([(*r, "s", 1, "p", 2, "x", 3, 4) for r in rows], columns)
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, row long")
    got = op12_filters.audit(docs, marks).collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(out) == len(got)
    return out


def test_op12_against_all_orders(spark, pairs):  # noqa: F811
    rng = random.Random(4)
    rows = [(d, t, rng.choice(["en", "de", "", None])) for d, t in pairs]
    rows += [(100 + i, rng.choice([prose(rng, 120), "A B C " * 40, "x # " * 9, prose(rng, 110) + " |"]), rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(None, "one two", "en"), (None, "one two", "en"), (900, rows[3][1], "fr"), (901, "clean " + prose(rng, 150), "it")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in range(0, 170)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (10_000, 1, 1)]
    assert audit_of(spark, rows, labels) == audited(rows, labels)


def test_op12_hot_texts_both_ways(spark, monkeypatch):
    rows = [(i, "same text", "en") for i in range(30)] + [(100 + i, f"text {i // 2}", "en") for i in range(20)]
    for keys in (1, 10**9):
        monkeypatch.setattr(op12_filters, "HOT_KEYS", keys)
        assert audit_of(spark, rows, [(3, 1, 0)]) == audited(rows, [(3, 1, 0)])


def test_op12_no_rows_and_no_labels(spark):
    assert audit_of(spark, [], []) == {}
    rows = [(1, None, None), (2, "", None)]
    got = audit_of(spark, rows, [])
    assert got == audited(rows, []) and len(got) == 600


# --- op13 ---------------------------------------------------------------------------

PAGE_COLUMNS = "page_id long, url string, html string, text string, blocks string, n_chars int"


def texts_of(spark, pages):
    df = spark.createDataFrame([(i, u, h, "t", "b", 0) for i, u, h in pages], PAGE_COLUMNS)
    got = op13_html.extract(df).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return sorted(((r.page_id, r.url, r.text) for r in got), key=str)


def test_op13_pages_of_other_layouts(spark):
    rng = random.Random(8)
    long = [prose(rng, n) + "." for n in (30, 45, 60, 25)]
    body = f"<p>{long[0]}</p><p>{long[1]}</p><p>{long[2]}</p>"
    pages = {
        # An article with everything around and in it.
        1: (f"""<!DOCTYPE html><html><head><title>t</title><style>p {{}}</style><script>if (a < b) x("</p><p>no</p>")</script></head><body class="has-sidebar">
         <header id="top"><a href="/">Site</a><p>{long[3]}</p></header><nav><li><a href=/>Home</a></nav><div class="cookie-banner">We use cookies, {long[3]}</div>
         <article><h1>A &lt;title&gt;</h1>{body}<div class="ad-slot"><p>{long[3]}</p></div><p>Short.<br>Line &amp; more&nbsp;&#233;&eacute;</p>
         <ul><li>one<li><a href="/x">two</a></ul><form><p>{long[3]}</p><input><button>Go</button></form><section id="comments"><h2>Comments</h2><p>{long[3]}</p></section>
         </article><aside><p>{long[3]}</p></aside><footer>&copy; {long[3]}</footer></body></html>""",
            "\n\n".join(["A <title>", *long[:3], "Short. Line & more éé", "one", "two"])),
        # No article element.
        2: (f"""<div class="topbar"><a href="/">A</a></div><div><a href="/1">One story</a></div><div><a href="/2">Another</a></div><div id="c"><h1>Some heading words</h1>{body}</div>
         <div id="footer"><p>{long[3]}</p></div>""", "\n\n".join(["Some heading words", *long[:3]])),
        # Unfinished: unclosed elements, a comment and a tag at the end.
        3: (f"<main><p>{long[0]}<p>{long[1]} <b>bold <i>text</b> end<!-- not closed <p>{long[3]}</p>", "\n\n".join([long[0], long[1] + " bold text end"])),
        4: (f"<article><p>{long[0]}</p><p>last &am</p></article><footer>x</footer><script>never closed {long[3]}", "\n\n".join([long[0], "last &am"])),
        5: (None, ""), 6: ("", ""), 7: ("   \n ", ""), 8: ("<nav><a href='/'>Only a menu</a></nav>", ""),
        9: ("<article>" + "<p>word word</p>" * 20_000 + "</article>", "\n\n".join(["word word"] * 20_000)),
        10: (f"<article><p>{long[0]} 1 < 2 and 3 > 2 <3</p></article>", long[0] + " 1 < 2 and 3 > 2 <3"),
        11: (f"<form><div class='nav'>menu</div><article><p>{long[0]}</p><p>x</p></article></form>", long[0] + "\n\nx"),
    }
    want = [(i, f"u{i}", t) for i, (_, t) in pages.items()] + [(None, None, ""), (6, "u6", "")]
    rows = [(i, f"u{i}", h) for i, (h, _) in pages.items()] + [(None, None, None), (6, "u6", "")]
    got = texts_of(spark, rows)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert a == b


def test_op13_blocks_and_features():
    blocks = op13_html.text_blocks("<nav><a href='/'>Go home</a> now</nav><article><h1>T</h1>a<b>b</b> <p>c d</article>")
    assert [(t, f[0], round(f[1], 3), f[6], f[9]) for t, f in blocks] == [
        ("Go home now", 3, 0.667, 0, 0), ("T", 1, 0, 3, 1), ("ab", 1, 0, 3, 0), ("c d", 2, 0, 3, 0)]
    assert blocks[1][1][2:6] == [3, 2 / 3, 1, 0]


def test_op13_held_out_pages_of_the_labelled_table(spark):
    """Trained on one half of the layouts, nearly all blocks of the other half are told apart."""
    hits = defaultdict(list)
    for half in (0, 1):
        model = op13_html.train(spark, op13_html.PAGES[half::2])
        from pyspark.ml.linalg import Vectors

        for label, features in op13_html.labelled_blocks(op13_html.PAGES[1 - half::2]):
            hits[label].append(model.predict(Vectors.dense(features)) == label)
    assert all(sum(h) >= 0.95 * len(h) for h in hits.values())


def test_op13_empty_table(spark):
    assert texts_of(spark, []) == []
