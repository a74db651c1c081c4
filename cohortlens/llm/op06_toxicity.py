"""Toxicity by a subsequence string kernel with Nystroem landmarks and a linear SVM.

Words are compared by their common subsequences of three symbols with at most two
symbols in between, weighted by ``DECAY`` per symbol spanned, so gaps and inserted
characters lower a match instead of losing it.  Inside a word, digits that stand
for letters are read as letters, other marks are dropped, and single letters in a
row are one word.  Landmarks are words typical of toxic rows; a sentence is the
vector of its best match with every landmark, whitened by the landmarks' own
kernel matrix.  A hinge-loss SVM is trained on sentences; a toxic row's sentence is
the one that the model of the round before scores highest.  A text's score is the
calibrated score of its highest sentence.

Fitting uses at most ``PER_CLASS`` rows of each class, the first by hash of the id,
of at most ``TRAIN_CHARS`` characters, and runs on the driver; scoring reads every
whole text once, in one pass without a shuffle.  Labels are learned only from
rows with crc32(id) mod 3 other than 1.

Null and empty texts are scored like texts without a word; a null id is hashed as
an empty one; labels may repeat (a row is toxic if any label says so) or be
missing; without both classes every score is 0.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import chunks, runs, table
from cohortlens.llm.registry import query

PER_CLASS = 1500
TRAIN_CHARS = 20_000
LANDMARKS = 128
RIDGE = 0.1
#: The kernel is raised to this power, which lowers chance matches against near ones; powers of a kernel are kernels.
POWER = 3
COST = 10.0
#: Sentences that a clean row gives, and those with the best matches among which a row's sentences are chosen.
HARD = 2
CANDIDATES = 8
#: Kernel value from which two candidate landmarks are variants of one.
VARIANT = 0.6
DECAY = 0.7
THRESHOLD = 0.7
SPAN = 5
#: Bytes of text whose words are matched at once (words x landmarks values are held).
SCORED = 1 << 16

#: Symbols: 26 letters, six classes of other letters' bytes; digits as the letters they stand for; -1 is dropped.
_SYMBOL = np.full(256, -1, np.int16)
_SYMBOL[ord("a"):ord("z") + 1] = np.arange(26)
_SYMBOL[ord("A"):ord("Z") + 1] = np.arange(26)
_SYMBOL[128:] = 26 + np.arange(128) % 6
for _mark, _letter in zip("013457@", "oieasta", strict=True):
    _SYMBOL[ord(_mark)] = ord(_letter) - ord("a")
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True
_TRIPLES = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, start and end of each word in them, its row and its sentence (numbered over all rows)."""
    starts, ends, row = runs(~_BLANK[data], bounds)
    symbols = _SYMBOL[data]
    kept = np.concatenate([[0], np.cumsum(symbols >= 0)])
    first, last = kept[starts], kept[ends]
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    # A sentence ends where a stop mark stands at a word's end or between words.
    at_end = _STOP[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    between = np.append(stops[starts[1:]] > stops[ends[:-1]], False) if len(starts) else at_end
    fresh = np.ones(len(starts), bool)
    if len(starts) > 1:
        fresh[1:] = (row[1:] != row[:-1]) | at_end[:-1] | between[:-1]
    sentence = np.cumsum(fresh) - 1
    # Single letters in a row are one word.
    single = last - first == 1
    head = np.ones(len(starts), bool)
    if len(starts) > 1:
        head[1:] = ~(single[1:] & single[:-1] & (row[1:] == row[:-1]))
    at = np.flatnonzero(head)
    until = np.append(at[1:], len(starts)) - 1
    return symbols[symbols >= 0].astype(np.int64), first[at], last[until] if len(at) else first[at], row[at], sentence[at]


def _subsequences(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of the three-symbol subsequences; only codes that ``wanted`` marks."""
    n = len(symbols)
    end = np.zeros(n, np.int64)
    word = np.zeros(n, np.int64)
    size = last - first
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    end[at] = np.repeat(last, size)
    word[at] = np.repeat(np.arange(len(first)), size)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for j, k in _TRIPLES:
        if n <= k:
            continue
        code = (symbols[:n - k] << 10) | (symbols[j:n - k + j] << 5) | symbols[k:]
        ok = np.arange(k, n) < end[:n - k]
        if wanted is not None:
            ok &= wanted[code]
        hit = np.flatnonzero(ok)
        out.append((word[hit], code[hit], np.full(len(hit), DECAY ** (k + 1))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _norms(size: np.ndarray) -> np.ndarray:
    """Square root of a word's kernel with itself, as if no subsequence occurred twice."""
    total = np.zeros(len(size))
    for _, k in _TRIPLES:
        total += np.maximum(size - k, 0) * DECAY ** (2 * (k + 1))
    return np.sqrt(np.maximum(total, 1e-12))


class Model:
    """Landmarks as a sparse table of subsequence codes, weights of the SVM, and the calibration."""

    def __init__(self, landmarks: list[str]):
        self.size = len(landmarks)
        text = " ".join(landmarks).encode()
        data = np.frombuffer(text, np.uint8)
        symbols, first, last, _, _ = _words(data, np.array([0, len(data)]))
        word, code, weight = _subsequences(symbols, first, last, None)
        # Sparse rows: the landmarks that hold a code, and the normed weight there.
        pair, at = np.unique(code * self.size + word, return_inverse=True) if self.size else (code, code)
        self.weights = np.bincount(at, weight, len(pair)) / _norms(last - first)[pair % max(1, self.size)] if self.size else weight
        self.landmark = pair % max(1, self.size)
        self.first = np.searchsorted(pair, np.arange((1 << 15) + 1) * max(1, self.size))
        self.gram = self.match(symbols, first, last) if self.size else np.zeros((0, 0))
        self.alpha, self.bias, self.slope, self.shift = np.zeros(self.size), 0.0, 1.0, 0.0

    def match(self, symbols: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Kernel values (words x landmarks)."""
        count = np.diff(self.first)
        word, code, weight = _subsequences(symbols, first, last, count > 0)
        n = count[code]
        each = np.repeat(np.arange(len(code)), n)
        entry = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + self.first[code][each]
        values = np.bincount(word[each] * self.size + self.landmark[entry], weight[each] * self.weights[entry], len(first) * self.size)
        values = np.minimum(values.reshape(len(first), self.size) / _norms(last - first)[:, None], 1.0).astype(np.float32)
        out = values
        for _ in range(POWER - 1):
            out = out * values
        return out

    def sentences(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and best matches of every sentence."""
        symbols, first, last, row, sentence = _words(data, bounds)
        if not len(first) or not self.size:
            return np.zeros(0, np.int64), np.zeros((0, self.size), np.float32)
        edge = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
        return row[edge], np.maximum.reduceat(self.match(symbols, first, last), edge, axis=0)

    def margin(self, features: np.ndarray) -> np.ndarray:
        return features @ self.alpha.astype(np.float32) + self.bias

    def rows_margin(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row, features = self.sentences(data, bounds)
        return self.combined(row, self.margin(features), len(bounds) - 1)

    def combined(self, row: np.ndarray, margin: np.ndarray, n: int) -> np.ndarray:
        """A text's margin is that of its highest sentence."""
        best = np.full(n, self.bias)
        np.maximum.at(best, row, margin)
        return best

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _svm(x: np.ndarray, y: np.ndarray, cost: float, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Hinge-loss SVM by dual coordinate descent; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    top = cost * share
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    squares = (x * x).sum(axis=1)
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            step = (1 - y[i] * (x[i] @ w)) / squares[i]
            new = min(max(a[i] + step, 0.0), top[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-3:
            break
    return w[:-1], float(w[-1])


def _calibrate(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression on the margin with smoothed targets (Platt)."""
    p, n = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (p + 1) / (p + 2), 1 / (n + 2))
    x = np.stack([margin, np.ones(len(margin))])
    at = np.array([1.0, 0.0])
    loss = lambda c: np.logaddexp(0, c @ x).sum() - (target * (c @ x)).sum() + 1e-3 * (c @ c)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(at @ x, -40, 40)))
        slope = x @ (q - target) + 2e-3 * at
        step = np.linalg.solve((x * (q * (1 - q))) @ x.T + 2e-3 * np.eye(2), slope)
        size, now = 1.0, loss(at)
        while size > 1e-6 and loss(at - size * step) > now:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    a, b = at
    return max(float(a), 1e-3), float(b)


def _typical(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Words that stand in toxic rows more often than in others, without close variants."""
    n = {True: {}, False: {}}
    for text, flag in zip(texts, toxic.tolist(), strict=True):
        seen = {w for w in ("".join(c for c in t if c.isalpha()) for t in text.lower().split()) if 3 <= len(w) <= 24}
        for piece in seen:
            n[flag][piece] = n[flag].get(piece, 0) + 1
    p, q = int(toxic.sum()), int((~toxic).sum())
    gain = {w: a * (np.log((a + 0.5) / (p + 1)) - np.log((n[False].get(w, 0) + 0.5) / (q + 1))) for w, a in n[True].items() if a >= 2 or p < 10}
    most = max(8, min(LANDMARKS, p // 3))
    ranked = sorted((w for w, g in gain.items() if g > 0), key=lambda w: (-gain[w], -len(w), w))[:16 * most]
    if not ranked:
        return []
    gram = Model(ranked).gram
    chosen: list[int] = []
    for i in range(len(ranked)):
        if len(chosen) < most and all(gram[i, c] < VARIANT for c in chosen):
            chosen.append(i)
    return [ranked[i] for i in chosen]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Model from labelled texts (a bounded sample)."""
    model = Model(_typical(texts, toxic) if toxic.any() and not toxic.all() else [])
    if not model.size:
        model.shift = -40.0
        return model
    raw = [t.encode() for t in texts]
    parts = []
    for i, r in enumerate(raw):
        _, best = model.sentences(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        best = best[np.argsort(-best.max(axis=1, initial=0), kind="stable")[:CANDIDATES]]
        parts.append((np.full(len(best), i), best))
    row, features = (np.concatenate(x) for x in zip(*parts, strict=True))
    values, vectors = np.linalg.eigh(model.gram.astype(np.float64) + RIDGE * np.eye(model.size))
    white = vectors / np.sqrt(np.maximum(values, RIDGE))
    z = features.astype(np.float64) @ white
    margin = features.max(axis=1)
    for _ in range(3):
        # Toxic rows: their highest sentence.  Others: their highest ones, the hard cases.
        order = np.lexsort((-margin, row))
        start = np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        place = np.empty(len(order), np.int64)
        place[order] = rank
        used = place < np.where(toxic[row], 1, HARD)
        # A text without a word is the zero vector.
        x, y = np.vstack([z[used], np.zeros((1, model.size))]), np.append(np.where(toxic[row[used]], 1.0, -1.0), -1.0)
        w, model.bias = _svm(x, y, COST)
        model.alpha = white @ w
        margin = model.margin(features)
    model.slope, model.shift = _calibrate(model.combined(row, margin, len(texts)), toxic)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Rows to learn from, ``doc_id, text, toxic``: at most ``per_class`` of each class."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    short = docs.where(F.length("text") <= TRAIN_CHARS).select("doc_id").distinct()
    usable = known.join(short, "doc_id")
    parts = [usable.where(F.col("toxic") == t).orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(per_class) for t in (0, 1)]
    # At most 2 * per_class ids, so the side can be broadcast.
    picked = docs.where(F.length("text") <= TRAIN_CHARS).join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")
    return picked.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[list[str], np.ndarray]:
    """Texts and labels to learn from, on the driver."""
    got = labelled(docs, labels, per_class).orderBy("doc_id").collect()
    return [r.text for r in got], np.array([r.toxic == 1 for r in got], bool)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model fitted to the bounded sample in one task; only the model reaches the driver."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        rows = pa.Table.from_batches(parts).sort_by("doc_id") if parts else None
        texts = rows["text"].to_pylist() if rows else []
        model = fit(texts, np.array([t == 1 for t in rows["toxic"].to_pylist()] if rows else [], bool))
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = labelled(docs, labels).repartition(1).mapInArrow(job, "model binary").first()
    # Spark runs no task over a sample that it knows to be empty.
    return pickle.loads(found["model"]) if found else fit([], np.zeros(0, bool))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column("text"), SCORED):
                p = model.probability(model.rows_margin(data, bounds))
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(first, end - first),
                                       "held_out": batch.column("held_out").slice(first, end - first), "score": pa.array(p, pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(job, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their columns."""
    schema = docs.schema

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column("text"), SCORED):
                p = model.probability(model.rows_margin(data, bounds))
                yield batch.slice(first, end - first).filter(pa.array(p < THRESHOLD))

    return docs.mapInArrow(job, schema)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
