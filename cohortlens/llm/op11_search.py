"""Ranked lexical search over bit-sliced Bloom signatures.

*Index.*  Every document with a term has a Bloom signature: each of its terms sets
``HASHES`` bits, and a term that occurs ``LEVELS[l]`` times or more sets those of level
``l`` too.  Signatures are as wide as the document needs (a power of two), documents
of one width are put together in blocks, and a block is stored bit-sliced: one bitmap
over its documents for each bit of the signature.

*Search.*  The bitmaps of a term's bits, and-ed, tell a superset of the documents that
hold it, and the levels a limit from above on how often.  The weighted sum of these
limits over an item's terms is an upper bound of the score; all terms of a block of
items go through a block of documents at once.  The documents with the highest bounds
are scored first, on their texts; their tenth score is a cutoff that the final tenth
cannot fall below.  In a second pass every document whose bound reaches the cutoff is
scored exactly, so only provably excluded documents are left out, whatever their number.

Items are read in blocks of at most ``ITEMS`` items and about ``TERMS`` terms; those
are what the driver holds and the tasks are sent.  Statistics and signatures compare
terms by 64-bit hashes (exact counting compares bytes).

Null and empty texts have no term and no part in the statistics; items without terms
have no rows; equal rows of ``benchmark`` are one item, differing texts of one id are
items of their own; equal rows of ``documents`` are ranked one by one, rows without an
id after others of the same score.  A very long text is a row of its own width, packed
with at most seven others.  An empty table gives no row.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import Scratch, chunks, mix, table, word_hashes
from cohortlens.llm.registry import query

K = 10
HASHES = 4
BITS_PER_ENTRY = 12
#: Occurrences from which a term is entered at a level; a longer list only costs time.
LEVELS = np.array([1, 2, 3, 4, *[b << s for s in range(40) for b in (6, 8)]], np.int64)
#: Bits of a block, and the documents it has at most.
BLOCK_BITS, BLOCK_DOCS = 1 << 23, 1024
ITEMS, TERMS = 256, 16384
#: Terms whose bounds are summed at once.
TERM_STEP = 1024

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SALT = mix(np.arange(1, len(LEVELS) * HASHES + 1, dtype=np.uint64)).reshape(len(LEVELS), HASHES)


def terms_of(text: str) -> list[bytes]:
    """Terms of a text in order, A-Z folded, as UTF-8."""
    return _TERM_BYTES.findall(text.encode("utf-8").lower())


# --- index ----------------------------------------------------------------------

INDEX = "width long, levels int, docs array<long>, prints array<long>, sizes array<long>, slices binary"


def _bits(terms: np.ndarray, level: int, width: int) -> np.ndarray:
    """Positions of the bits of each term at a level: one row for each hash."""
    shift = np.uint64(64 - int(width).bit_length() + 1)
    return (mix(terms[None, :] ^ _SALT[level][:, None]) >> shift).astype(np.int64)


class _Block:
    """Documents of one width on their way into a block."""

    def __init__(self, width: int):
        self.width = width
        self.limit = min(BLOCK_DOCS, max(8, BLOCK_BITS // width))
        self.clear()

    def clear(self) -> None:
        self.docs, self.prints, self.sizes, self.set, self.levels = [], [], [], [], 0

    def row(self) -> pa.RecordBatch:
        places = -(-len(self.docs) // 8) * 8
        flags = np.zeros((self.width, places), bool)
        for at, bits in enumerate(self.set):
            flags[bits, at] = True
        out = pa.record_batch({
            "width": pa.array([self.width], pa.int64()), "levels": pa.array([self.levels], pa.int32()),
            "docs": pa.array([self.docs], pa.list_(pa.int64())), "prints": pa.array([self.prints], pa.list_(pa.int64())),
            "sizes": pa.array([self.sizes], pa.list_(pa.int64())), "slices": pa.array([np.packbits(flags, axis=1).tobytes()], pa.binary())})
        self.clear()
        return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Block] = {}
    for batch in batches:
        docs, prints = batch.column("doc_id").to_pylist(), batch.column("print").to_pylist()
        for first, end, data, bounds in chunks(batch.column("text")):
            hashes, starts = word_hashes(data, bounds, _TERM)
            for i in range(end - first):
                words = hashes[starts[i]:starts[i + 1]]
                if not len(words):
                    continue
                distinct, counts = np.unique(words, return_counts=True)
                levels = int(np.searchsorted(LEVELS, counts.max(), "right"))
                kept = [distinct] + [distinct[counts >= LEVELS[level]] for level in range(1, levels)]
                entries = sum(map(len, kept))
                width = 1 << max(6, (BITS_PER_ENTRY * entries - 1).bit_length())
                block = blocks.setdefault(width, _Block(width))
                block.docs.append(docs[first + i])
                block.prints.append(prints[first + i])
                block.sizes.append(len(words))
                block.set.append(np.concatenate([_bits(x, level, width).ravel() for level, x in enumerate(kept)]))
                block.levels = max(block.levels, levels)
                if len(block.docs) == block.limit:
                    yield block.row()
    for block in blocks.values():
        if block.docs:
            yield block.row()


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of bit-sliced signatures of all documents with a term."""
    read = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("print"))
    return read.mapInArrow(_index, INDEX)


# --- statistics -------------------------------------------------------------------

_N, _L = -1, -2


def _frequencies(watched: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term (place in ``watched``, which is sorted), count: documents with the term; N and L under their own numbers."""
    found = np.zeros(len(watched), np.int64)
    with_terms = n_terms = 0
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column("text")):
            hashes, starts = word_hashes(data, bounds, _TERM)
            sizes = np.diff(starts)
            with_terms += int((sizes > 0).sum())
            n_terms += len(hashes)
            at = np.minimum(np.searchsorted(watched, hashes), len(watched) - 1)
            hit = watched[at] == hashes
            row = np.repeat(np.arange(end - first), sizes)[hit]
            once = np.unique(row * len(watched) + at[hit])
            found += np.bincount(once % len(watched), minlength=len(watched))
    place = np.flatnonzero(found)
    yield pa.record_batch({"term": pa.array(np.append(place, [_N, _L]), pa.int64()),
                           "count": pa.array(np.append(found[place], [with_terms, n_terms]), pa.int64())})


# --- bounds -------------------------------------------------------------------------

@dataclass
class Block:
    """Items that are searched together. Terms are ordered by hash."""

    items: list[tuple[int, int | None, Counter]]
    terms: list[bytes]
    hashes: np.ndarray
    weight: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    def weights(self) -> np.ndarray:
        """Items by terms: weight times occurrences in the item."""
        at = {t: i for i, t in enumerate(self.terms)}
        out = np.zeros((len(self.items), len(self.terms)))
        for i, (_, _, counts) in enumerate(self.items):
            for t, q in counts.items():
                out[i, at[t]] = float(q * int(self.weight[at[t]]))
        return out


def _m(n: int | np.ndarray, block: Block) -> int | np.ndarray:
    return 100 - 75 + (75 * n * block.n_docs) // block.n_terms


def _upper_bounds(block: Block, weights: np.ndarray, row: dict) -> np.ndarray:
    """Items by documents of the row: sums that no score exceeds (whole numbers, exact in doubles)."""
    width, n = row["width"], len(row["docs"])
    slices = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
    # Python numbers: 75 * size * N may leave 64 bits where a term is far from the others.
    m = np.array([_m(int(s), block) for s in row["sizes"]], np.int64)
    top = LEVELS[1:row["levels"] + 1] - 1
    gain = [(1_000_000_000 * int(t)) // (1000 * int(t) + 8 * m) for t in top]
    out = np.zeros((len(block.items), n))
    for first in range(0, len(block.hashes), TERM_STEP):
        terms = np.arange(first, min(first + TERM_STEP, len(block.hashes)))
        total, present, below = None, None, 0
        for level in range(row["levels"]):
            found = np.bitwise_and.reduce(slices[_bits(block.hashes[terms], level, width)], axis=0)
            if present is not None:
                found &= present
            some = found.any(axis=1)
            if not some.any():
                break
            terms, present = terms[some], found[some]
            step = np.unpackbits(present, axis=1, count=n) * (gain[level] - below).astype(float)
            if total is None:
                total, base = step, terms
            else:
                total[np.searchsorted(base, terms)] += step
            below = gain[level]
        if total is not None:
            out += weights[:, base] @ total
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


PAIRS = "item int, doc_id long, print long, bound double"


def _pairs(item, docs, prints, bound) -> pa.RecordBatch:
    return pa.record_batch({"item": pa.array(item, pa.int32()), "doc_id": pa.array(docs, pa.int64()),
                            "print": pa.array(prints, pa.int64()), "bound": pa.array(bound, pa.float64())})


def _highest(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's documents with the highest bounds for each item."""
    weights = block.weights()
    high = np.zeros((len(block.items), 0))
    where = np.zeros((len(block.items), 0), np.int64)
    known: dict[int, tuple] = {}
    n = 0
    for row in _rows(batches):
        bounds = np.concatenate([high, _upper_bounds(block, weights, row)], axis=1)
        at = np.concatenate([where, np.broadcast_to(n + np.arange(len(row["docs"])), (len(block.items), len(row["docs"])))], axis=1)
        known |= {n + i: pair for i, pair in enumerate(zip(row["docs"], row["prints"], strict=True))}
        n += len(row["docs"])
        if bounds.shape[1] > K:
            best = np.argpartition(-bounds, K - 1, axis=1)[:, :K]
            bounds, at = np.take_along_axis(bounds, best, 1), np.take_along_axis(at, best, 1)
        high, where = bounds, at
        known = {i: known[i] for i in np.unique(where).tolist()}
    item, place = np.nonzero(high > 0)
    pairs = [known[i] for i in where[item, place].tolist()]
    yield _pairs(item, [p[0] for p in pairs], [p[1] for p in pairs], high[item, place])


def _reaching(block: Block, cutoff: list[tuple[int, int | None]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs whose bound reaches the item's cutoff (score and document of its tenth place so far)."""
    weights = block.weights()
    least = np.array([[max(score, 1)] for score, _ in cutoff], float)
    # A bound that only equals the cutoff cannot win against a smaller id.
    last = np.array([[np.iinfo(np.int64).max if doc is None else doc] for _, doc in cutoff], np.int64)
    for row in _rows(batches):
        bounds = _upper_bounds(block, weights, row)
        docs = np.array([np.iinfo(np.int64).min if d is None else d for d in row["docs"]], np.int64)
        item, at = np.nonzero((bounds > least) | ((bounds == least) & (docs[None, :] <= last)))
        if len(item):
            yield _pairs(item, [row["docs"][i] for i in at.tolist()], [row["prints"][i] for i in at.tolist()], bounds[item, at])


# --- exact scores ------------------------------------------------------------------

def _exact(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, doc_id, score: the task's ten best of each item among the offered pairs."""
    weight = dict(zip(block.terms, block.weight.tolist(), strict=True))
    best: dict[int, list] = defaultdict(list)
    serial = 0
    for batch in batches:
        for doc, text, items in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist(), strict=True):
            words = terms_of(text.as_py())
            counts = Counter(words)
            m = _m(len(words), block)
            gain = {t: weight[t] * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in counts.keys() & weight.keys()}
            for item in set(items):
                score = sum(q * gain[t] for t, q in block.items[item][2].items() if t in gain)
                if score > 0:
                    serial += 1
                    rank = (score, doc is None and -math.inf or -(doc or 0), serial, doc)
                    (heapq.heappush if len(best[item]) < K else heapq.heappushpop)(best[item], rank)
    found = [(item, rank[3], rank[0]) for item, ranks in best.items() for rank in ranks]
    yield pa.record_batch({"item": pa.array([f[0] for f in found], pa.int32()), "doc_id": pa.array([f[1] for f in found], pa.int64()),
                           "score": pa.array([f[2] for f in found], pa.int64())})


def _best(rows: DataFrame, *order) -> DataFrame:
    """The first K rows of each item with their rank; first within slices of an item, then over those."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(32))
    for keys in (["item", "part"], ["item"]):
        rows = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= K)
    return rows.drop("part")


def _scored(block: Block, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """item, doc_id, score, rank of the ten best of the pairs, scored on the texts."""
    offered = pairs.groupBy(F.col("doc_id").alias("doc"), "print").agg(F.collect_set("item").alias("items"))
    read = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("print"))
    # Two texts of one id and one print are both scored; the print only selects.
    wanted = read.join(offered, (read["print"] == offered["print"]) & read["doc_id"].eqNullSafe(F.col("doc")))
    scores = wanted.select("doc_id", "text", "items").mapInArrow(lambda b: _exact(block, b), "item int, doc_id long, score long")
    return _best(scores, F.col("score").desc(), F.col("doc_id").asc_nulls_last())


# --- search ------------------------------------------------------------------------

def _blocks(items: DataFrame) -> Iterator[Block]:
    """Items with terms, streamed to the driver and handed on in blocks."""
    def block(rows: list[tuple[int, int | None, Counter]]) -> Block:
        terms = sorted(set().union(*[c.keys() for _, _, c in rows]))
        hashes, _ = word_hashes(*_bytes(terms), _TERM)
        order = np.argsort(hashes, kind="stable")
        return Block(rows, [terms[i] for i in order.tolist()], hashes[order])

    rows, seen = [], set()
    for n, r in enumerate(items.where("text is not null").select("item_id", "text").distinct().toLocalIterator()):
        counts = Counter(terms_of(r["text"]))
        if counts:
            rows.append((n, r["item_id"], counts))
            seen |= counts.keys()
        if len(rows) == ITEMS or len(seen) >= TERMS:
            yield block(rows)
            rows, seen = [], set()
    if rows:
        yield block(rows)


def _bytes(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(terms), np.uint8), np.cumsum([0, *map(len, terms)])


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best documents of each item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index, out = None, None
    for block in _blocks(items):
        if index is None:
            index = scratch.store(build_index(docs))
        counts = dict(docs.where("text is not null").select("text").mapInArrow(
            lambda b, w=block.hashes: _frequencies(w, b), "term long, count long").groupBy("term").agg(F.sum("count")).collect())
        block.n_docs, block.n_terms = counts.get(_N, 0), counts.get(_L, 0)
        if not block.n_docs:
            break
        block.weight = np.array([math.floor(1000 * math.log((2 * block.n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(block.terms))])
        seeds = _best(index.mapInArrow(lambda b, x=block: _highest(x, b), PAIRS), F.col("bound").desc(), F.col("doc_id").asc_nulls_last())
        cutoff = [(0, None)] * len(block.items)
        for r in _scored(block, docs, scratch.store(seeds.select("item", "doc_id", "print"))).where(F.col("rank") == K).collect():
            cutoff[r["item"]] = (r["score"], r["doc_id"])
        pairs = scratch.store(index.mapInArrow(lambda b, x=block, c=cutoff: _reaching(x, c, b), PAIRS))
        names = spark.createDataFrame([(i, item_id) for i, (_, item_id, _) in enumerate(block.items)], "item int, item_id long")
        found = scratch.store(_scored(block, docs, pairs).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = scratch.store(out)
    scratch.drop()
    return result


_RULE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_RULE}') AS ts FROM documents),
 s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
 i AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
 q AS (SELECT item, item_id, term, count(*) AS q FROM (SELECT item, item_id, unnest(regexp_extract_all({_FOLD.format("text")}, '{_RULE}')) AS term FROM i)
   GROUP BY ALL),
 o AS (SELECT row, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d),
 f AS (SELECT row, doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, s GROUP BY 1),
 x AS (SELECT item, item_id, row, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
   FROM f JOIN w USING (term) JOIN q USING (term), s GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@query("op11_ranked_search", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
