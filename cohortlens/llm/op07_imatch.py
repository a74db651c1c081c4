"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band: they
are neither in most documents nor rare.  Its lower frequency limit is a fraction
of the documents, so it has at most (mean distinct terms per document / fraction)
terms whatever the number of documents; that bound is checked before it is sent to
the tasks.  A fingerprint hashes, for each of ``SUBSETS`` randomised lexicon
subsets, the sorted distinct terms that a document has of the subset.  Subsets
come in ``LEVELS`` densities, each half the one before, so that short and long
documents both have subsets with few terms; a subset without a term is empty.

Two fingerprints are compared level by level: the share of subsets with equal,
non-empty hashes among those that are non-empty in one of both.  The likeness is
the highest level's share, and 1 for equal fingerprints (0 for two empty ones of different texts).

Null and empty texts have the empty fingerprint (every subset empty; equal texts,
equal fingerprints).  Documents are followed by id, ties by text; rows without an
id come first.  One document is followed by itself.  Very long texts are read whole; an empty
table gives no row; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import NOT_SPACE, Scratch, chunks, mix, table, word_hashes
from cohortlens.llm.registry import query

LEVELS, PER_LEVEL = 8, 16
SUBSETS = LEVELS * PER_LEVEL
#: A term of the lexicon stands in at least this share of the documents, and at most in that.
LEAST, MOST = 0.0005, 0.25
#: Fixed limit of the lexicon's size; the proven bound must not exceed it.
LARGEST = 4_000_000
EMPTY = "----" * SUBSETS
#: A level counts from so many non-empty subsets on.
ENOUGH = 4
#: Terms are the words without punctuation: runs of letters, digits and non-ASCII bytes.
_TERM = np.zeros(256, bool)
_TERM[128:] = True
for _a, _b in (("a", "z"), ("A", "Z"), ("0", "9")):
    _TERM[ord(_a):ord(_b) + 1] = True
assert NOT_SPACE[_TERM].all()
#: Distinct terms whose counts a task gathers before it sends them.
FLUSH = 1 << 20


def _terms(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    hashes, first = word_hashes(data, bounds, _TERM)
    for i in range(len(bounds) - 1):
        yield np.unique(hashes[first[i]:first[i + 1]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, summed per task before they are shuffled."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([keys, *held])
        weight = np.concatenate([counts, np.ones(len(every) - len(keys), np.int64)])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        start = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
        return every[start], np.add.reduceat(weight, start) if len(start) else weight

    def batch_of() -> pa.RecordBatch:
        return pa.record_batch({"term": pa.array(keys.view(np.int64)), "n": pa.array(counts)})

    for batch in batches:
        for _, _, data, bounds in chunks(batch.column("text")):
            for terms in _terms(data, bounds):
                held.append(terms)
                size += len(terms)
            if size >= FLUSH:
                keys, counts = summed()
                held, size = [], 0
                if len(keys) >= FLUSH:
                    yield batch_of()
                    keys, counts = keys[:0], counts[:0]
    keys, counts = summed()
    yield batch_of()


def lexicon(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Sorted term hashes of the band, over all documents, and the number of documents."""
    scratch = Scratch(docs.sparkSession, "imatch")
    counted = scratch.store(docs.select("text").mapInArrow(_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")))
    n_docs, occurrences = docs.count(), counted.agg(F.sum("n")).first()[0] or 0
    bound = occurrences / max(1, n_docs) / LEAST
    if bound > LARGEST:
        raise ValueError(f"documents have {occurrences / n_docs:.0f} distinct terms on average; raise LEAST so that the lexicon stays below {LARGEST}")
    low, high = max(2.0, LEAST * n_docs), max(2.0, MOST * n_docs)
    rows = counted.where((F.col("n") >= low) & (F.col("n") <= high)).select("term").toPandas()
    scratch.drop(0)
    return np.sort(rows["term"].to_numpy(np.int64).view(np.uint64)), n_docs


_LEVEL_SALT = mix(np.arange(1, SUBSETS + 1, dtype=np.uint64))


def fingerprint(terms: np.ndarray, known: np.ndarray) -> str:
    """128 fields of four hex digits, '----' for an empty subset."""
    if len(known) and len(terms):
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        terms = terms[known[at] == terms]
    else:
        terms = terms[:0]
    if not len(terms):
        return EMPTY
    draws = mix(terms[:, None] ^ _LEVEL_SALT[None, :])
    member = (draws >> np.uint64(64 - LEVELS - 1)) < (np.uint64(1) << (np.uint64(LEVELS) - (np.arange(SUBSETS) // PER_LEVEL).astype(np.uint64)))
    # Terms are sorted; a chained hash over those of the subset would do, a sum of mixed hashes is the same for sets.
    sums = np.where(member, mix(draws), np.uint64(0)).sum(axis=0, dtype=np.uint64)
    some = member.any(axis=0)
    return "".join(f"{int(s) >> 48:04x}" if e else "----" for s, e in zip(sums.tolist(), some.tolist(), strict=True))


def likeness(a: str, b: str, equal_texts: bool = False) -> float:
    """Two empty fingerprints say nothing of their texts; they are alike only where these are equal."""
    if a == b:
        return 1.0 if equal_texts or a != EMPTY else 0.0
    x, y = (np.frombuffer(s.encode(), "<u4").reshape(LEVELS, PER_LEVEL) for s in (a, b))
    blank = np.frombuffer(b"----", "<u4")[0]
    used = ((x != blank) | (y != blank)).sum(axis=1)
    same = ((x == y) & (x != blank)).sum(axis=1)
    share = same[used >= ENOUGH] / used[used >= ENOUGH]
    return float(share.max()) if len(share) else 0.0


_OUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _pairs(known: np.ndarray):
    """Rows of a range of ids in order; the last row of a range is only the successor of the one before."""

    def mark(text: str) -> str:
        raw = np.frombuffer(text.encode(), np.uint8)
        return fingerprint(next(_terms(raw, np.array([0, len(raw)]))), known)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            for part, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text")), strict=True):
                text = text or ""
                now = (part, doc, text, mark(text))
                if held is not None and held[0] == part:
                    out.append(_row(held, now, mark))
                held = now
            yield pa.record_batch({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(_FIELDS)})

    return job


_FIELDS = (("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))


def _row(one: tuple, after: tuple, mark) -> tuple:
    _, doc, text, print_ = one
    half = len(text) // 2
    edited = text[:len(text) - half] + after[2][:half]
    edited_print = mark(edited)
    return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_, edited_print, likeness(print_, edited_print, text == edited),
            likeness(print_, after[3], text == after[2]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "imatch")
    known, n_docs = lexicon(docs)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    # Ranges of ids from exact counts per prefix of the order: edges are quantiles of all ids.
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = ids.select(F.percentile_approx("doc_id", [i / n_parts for i in range(1, n_parts)], 10_000)).first()[0] if n_parts > 1 and n_docs else None
    cuts = np.array(sorted(set(edges or [])), np.int64)
    # Only the id column goes through these functions; texts stay in the JVM.
    part_of = F.pandas_udf(lambda x: pd.Series(np.searchsorted(cuts, x.to_numpy(np.int64)).astype(np.int32)), "int")
    order = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("long"))
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("part", part_of(order))
    heads = ids.select(order.alias("doc_id")).withColumn("part", part_of(F.col("doc_id"))).groupBy("part").agg(F.min("doc_id").alias("first")).orderBy("part").collect()
    if not heads:
        return spark.createDataFrame([], f"doc_id long, {_OUT}")
    # One row per range: its first document is also the successor of the range before (of the last one, for the first).
    parts, firsts = np.array([r.part for r in heads]), np.array([r["first"] for r in heads], np.int64)
    is_head = F.pandas_udf(lambda x: pd.Series(np.isin(x.to_numpy(np.int64), firsts)), "boolean")
    before = F.pandas_udf(lambda x: pd.Series(np.roll(parts, 1)[np.searchsorted(parts, x.to_numpy())].astype(np.int32)), "int")
    first_text = placed.where(is_head(order)).groupBy("part").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").alias("doc_id"))).alias("f"))
    tails = first_text.select(before(F.col("part")).alias("part"), F.col("f.doc_id").alias("doc_id"), F.col("f.text").alias("text"), F.lit(1).alias("tail"))
    rows = placed.withColumn("tail", F.lit(0)).unionByName(tails)
    sorted_ = rows.repartition(n_parts, "part").sortWithinPartitions("part", "tail", order, F.coalesce("text", F.lit("")))
    return sorted_.select("part", "doc_id", "text").mapInArrow(_pairs(known), f"doc_id long, {_OUT}")


@query("op7_imatch_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
