import collections
import hashlib
import random
import re

import numpy as np
import pytest

from cohortlens.llm import op03_license, op07_imatch, op10_pii
from tests.llm.fixtures import as_documents, pairs  # noqa: F401

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_op3_base_places(spark, pairs):
    extra = [(50, "Released under the MIT License. mit  license; MIT-LICENSE"), (51, "gnu general public license general public public license"),
             (52, "the Apache, License"), (53, "mit licence İmit license"), (54, "Licensed under CC BY-NC 4.0."),
             (55, "Permission is hereby granted, free of charge, to any other person obtaining a copy of this software and associated documentation files"),
             (56, "of this software and the rights"), (57, "license mit"), (58, None)]
    rows = pairs + extra
    got = op03_license.scan(as_documents(spark, rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        w = WORD.findall((text[r.doc_id] or "").translate(FOLD))
        places, labels = [], set()
        for phrase, label in op03_license.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))), r
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert by[54].labels == "cc-by-nc" and by[55].labels == "mit" and by[55].n_base == 0
    assert by[56].labels == "" and by[57].labels == "" and by[50].n_base == 3 and by[50].score == 1


def test_op3_empty_table(spark):
    assert op03_license.scan(as_documents(spark, [])).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


ODD = [(60, "a@b.c_d@e.f g@h.i.j.k 1.2.3.4.5.6.7.8 256.1.1.1 007.08.255.0 4111 1111 1111 1111 +1 (212) 555-0100. +12"),
       (61, "a@b.co é 1.1.1.1"), (62, "9" * 3000 + " 1" * 3000 + " a" * 10 + "%" * 2000 + "@x.y"), (63, "a@b a@b. .@-.- +1--2 +1234567890123456"),
       (64, "+1.2.3.4.5.6.7.8.9.0.1 4111-1111-1111-1111@x.y"), (65, "0000000000000000"), (66, None), (67, "")]


def test_op10_base_equals_brute_force(spark, pairs):
    rows = pairs + ODD
    text, names = dict(rows), list(BASE)
    got = op10_pii.personal_data(as_documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = base_spans(text[r.doc_id] or "")
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (r.doc_id, listed, r.spans)
        count = collections.Counter(names[k] for _, k, _ in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[n] for n in names)
        assert r.spans == listed


def test_op10_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please write to user{i}@mail.example.org soon, room {i}") for i in range(8)]
    rows += [(i, f"please write to user{i}@intranet soon") for i in range(8, 11)] + [(20, "row 12 of 40 in table 7")]
    got = {r.doc_id: r.spans for r in op10_pii.personal_data(as_documents(spark, rows)).collect()}
    start = len("please write to ")
    assert got[8] == f"email:{start}:{start + len('user8@intranet')}"
    assert got[20] == "" and got[3] == f"email:{start}:{start + len('user3@mail.example.org')}"


def test_op10_redaction(spark):
    rows = [(1, "call +1 (212) 555-0100 now"), (2, None), (3, "clean 12"), (4, "x a@b.co,1.2.3.4"), (4, "x a@b.co,1.2.3.4"), (5, "")]
    out = op10_pii.redact(as_documents(spark, rows))
    assert out.columns == as_documents(spark, rows).columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert got == [(1, "call [PHONE] now", 16), (2, None, None), (3, "clean 12", 8), (4, "x [EMAIL],[IP]", 14), (4, "x [EMAIL],[IP]", 14), (5, "", 0)]


def test_op10_empty_table(spark):
    assert op10_pii.personal_data(as_documents(spark, [])).count() == 0


@pytest.mark.parametrize("partitions", [1, 4])
def test_op7_edits_and_order(spark, pairs, partitions):
    rows = [p for i, p in enumerate(pairs) if p not in pairs[:i]]
    got = {r.doc_id: r for r in op07_imatch.fingerprints(as_documents(spark, rows).repartition(partitions)).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(ordered)
    prints = {}
    for n, (i, t) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest()), i
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[8].fingerprint == got[16].fingerprint
    distinct = [i for i in range(20, 32)]
    assert sum(got[i].near_edited for i in distinct) > 2 * sum(got[i].near_next for i in distinct)


def test_op7_single_repeated_and_missing(spark):
    assert op07_imatch.fingerprints(as_documents(spark, [])).count() == 0
    one = op07_imatch.fingerprints(as_documents(spark, [(5, "a b c d")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"a ba b"[:0] + "a b a b".encode()).hexdigest() or one[0].n_chars == 7
    rows = op07_imatch.fingerprints(as_documents(spark, [(None, "x y"), (1, "x y"), (1, "x y"), (2, None)])).collect()
    assert len(rows) == 4


def test_op7_likeness():
    assert op07_imatch.likeness("ab12" * 128, "ab12" * 128) == 1
    assert op07_imatch.likeness("ab12" * 128, "cd34" * 128) == 0
    assert op07_imatch.likeness("----" * 128, "cd34" * 128) == 0
    assert op07_imatch.likeness("----" * 128, "----" * 128) == 0 and op07_imatch.likeness("----" * 128, "----" * 128, True) == 1


def test_op7_band_and_fields_by_brute_force(spark):
    """The lexicon counted in Python, and fields that agree exactly where the subsets' terms do."""
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(0, 25))) for _ in range(120)] + [None, ""]
    known, n = op07_imatch.lexicon(as_documents(spark, list(enumerate(texts))))
    df = {w: sum(w in (t or "").split() for t in texts) for w in vocabulary}
    low, high = max(2.0, op07_imatch.LEAST * n), max(2.0, op07_imatch.MOST * n)
    code = {w: int(op07_imatch.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) for w in vocabulary}
    assert n == len(texts) and sorted(known.tolist()) == sorted(code[w] for w in vocabulary if low <= df[w] <= high)
    used = {code[w]: w for w in vocabulary if code[w] in set(known.tolist())}
    draws = op07_imatch.mix(np.array(sorted(used), np.uint64)[:, None] ^ op07_imatch._LEVEL_SALT[None, :])
    subset = [{t for t, d in zip(sorted(used), draws[:, k].tolist(), strict=True) if d >> (63 - op07_imatch.LEVELS) < 1 << (op07_imatch.LEVELS - k // op07_imatch.PER_LEVEL)}
              for k in range(op07_imatch.SUBSETS)]
    sets = [{code[w] for w in (t or "").split()} for t in texts]
    prints = [op07_imatch.fingerprint(np.array(sorted(s), np.uint64), known) for s in sets]
    by_chance = 0  # a field has 16 bits
    for i in range(0, len(texts), 7):
        for j in range(i + 1, len(texts), 5):
            for k in range(op07_imatch.SUBSETS):
                a, b = (prints[x][4 * k:4 * k + 4] for x in (i, j))
                assert (a == "----") == (not sets[i] & subset[k])
                same = sets[i] & subset[k] == sets[j] & subset[k]
                assert a == b or not same, (i, j, k)
                by_chance += a == b and not same
    assert by_chance <= 10


def test_op3_votes_are_distinct_positions_in_order(spark):
    whole = "licensed under the GNU Lesser General Public License today"
    rows = [(1, "general public license general public license"), (2, "the public " * 8), (3, whole),
            (4, "public domain into the public released into software released free and is free this is unencumbered software"),
            (5, "This is free and really unencumbered software released into the public domain"), (6, (whole + " ") * 3)]
    got = {r.doc_id: r for r in op03_license.scan(as_documents(spark, rows)).collect()}
    assert got[1].labels == "gpl" and got[2].labels == "" and got[2].score < 0.2
    assert got[3].labels == got[6].labels == "gpl,lgpl" and got[3].n_base == 1 and got[6].n_base == 3
    assert got[4].labels == "" and got[5].labels == "unlicense"
    assert [s.start for s in got[3].spans if s.label == "lgpl"] == [3]
    assert [s.start for s in got[6].spans if s.label == "lgpl"] == [3, 12, 21]


def test_op3_whole_paragraphs_with_words_put_in_and_left_out(spark):
    """Every template is found as it is, with up to its slack of other words, and with a fifth of its end cut off; not with its words shuffled."""
    rng = random.Random(12)
    rows, want = [], {}
    for n, (label, text) in enumerate(op03_license.TEMPLATES):
        w = text.split()
        longer = list(w)
        for _ in range(max(op03_license.SLACK, (len(w) - 1) // 10)):
            longer.insert(len(longer) // 2, "x")
        shuffled = list(w)
        rng.shuffle(shuffled)
        fill = " ".join("zz%d" % rng.randrange(99) for _ in range(40))
        for k, words in enumerate((w, longer if len(w) > 16 else w, w[:len(w) - len(w) // 5] if len(w) > 16 else w)):
            rows.append((10 * n + k, fill + " " + " ".join(words) + " " + fill))
            want[10 * n + k] = label
        if len(w) > 16:
            rows.append((10 * n + 5, " ".join(reversed(w))))
            want[10 * n + 5] = None
    got = {r.doc_id: r.labels.split(",") for r in op03_license.scan(as_documents(spark, rows)).collect()}
    wrong = {i: (got[i], label) for i, label in want.items() if (label not in got[i] if label else got[i] != [""])}
    assert not wrong


def test_op6_learns_in_a_task(spark, monkeypatch):
    """The model of the driver's sample, without a text on the driver; no labels, no rejection."""
    from cohortlens.llm import op06_toxicity as T

    texts = [("you stupid idiot, shut up " if i % 3 == 0 else "a fine day at the lake ") + f"number {i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    here = T.fit(*T.sample(docs, labels))
    monkeypatch.setattr(T, "sample", None)
    there = T.learn(docs, labels)
    assert here.size == there.size > 0 and (here.alpha == there.alpha).all() and (here.weights == there.weights).all()
    assert (here.bias, here.slope, here.shift) == (there.bias, there.slope, there.shift)
    assert T.clean(docs, T.learn(docs, labels.limit(0))).count() == 60
