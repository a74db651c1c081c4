"""MinHash near-duplicates through an inverted index over signature coordinates.

Every document is posted under each (coordinate, value) pair of its MinHash
signature.  Two documents whose shingle sets are alike collide in about
``similarity * n_coordinates`` lists, so a pair counts as a candidate from
``min_matches`` collisions on.  As in T-occurrence search, lists are put in one
global order by length and a document is looked up only in its
``m - min_matches + 1`` shortest lists (prefix); the long lists are skipped and
their collisions are counted by probing the signatures of the pairs found.
Candidates are confirmed on the full shingle sets of the texts.

Only components are asked for, so candidates are not expanded into all pairs.
Each list offers its members to two centres; members with enough collisions form
families.  A family is compared inside tasks, in pairs of blocks of
documents, and only links between parts that are not joined yet leave the task.
Pairs of different families, which no centre has brought together, are taken from
the lists as they are; so every pair above the threshold is confirmed or already
joined.

Nulls and empty texts have no shingle and stay alone; equal texts (more exactly:
equal shingle sets) are one class, compared once; repeated ids are one document
(the union of links of their rows).  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import Scratch, chunks, components, mix, shingles, table, word_hashes
from cohortlens.llm.families import Rule, links
from cohortlens.llm.registry import query

#: Links have at least 85 in 100 shingles in common, so 54.4 +- 2.9 of 64 coordinates; below 40 with a probability near 1e-6.
RULE = Rule(coordinates=64, min_matches=40, numerator=85)


def _features(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column("text")):
            hashes, starts = word_hashes(data, bounds)
            sizes, prints, signatures = [], [], []
            for i in range(end - first):
                items = shingles(hashes[starts[i]:starts[i + 1]])
                sizes.append(len(items))
                if not len(items):
                    prints.append(None)
                    signatures.append(None)
                    continue
                prints.append(np.array([items.sum(), np.bitwise_xor.reduce(mix(items))], np.uint64).tobytes())
                signatures.append(rule.signature(items))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(first, end - first),
                "n_shingles": pa.array(sizes, pa.int64()),
                "print": pa.array(prints, pa.binary()),
                "signature": pa.array(signatures, pa.list_(pa.int32())),
            })


def _postings(rule: Rule, representatives: DataFrame) -> DataFrame:
    """(doc, key) of the prefix lists of each document that can have a partner."""
    posted = representatives.select("doc", F.posexplode("signature").alias("at", "value")).select(
        "doc", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long") + F.lit(2**31)).alias("key"))
    lengths = posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    found = posted.join(lengths, "key")
    # At most one row per coordinate and document, so the arrays are short.
    ordered = found.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("length", "key"))).alias("lists")).where(
        F.size("lists") >= rule.min_matches)
    return ordered.select("doc", F.explode(F.slice("lists", F.lit(1), F.size("lists") - (rule.min_matches - 1))).alias("x")).select(
        "doc", F.col("x.key").alias("key"))


def near_duplicates(docs: DataFrame, name: str = "minhash", rule: Rule | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept (doc_id = component_id)."""
    spark = docs.sparkSession
    rule = rule or RULE
    scratch = Scratch(spark, name)
    features = scratch.store(docs.select("doc_id", "text").mapInArrow(
        lambda batches: _features(rule, batches), "doc_id long, n_shingles long, print binary, signature array<int>"))
    classes = features.where("print is not null").groupBy("print").agg(F.min("doc_id").alias("doc"))
    signed = features.where("print is not null").select(F.col("doc_id").alias("doc"), "print", "signature")
    representatives = scratch.store(classes.join(signed, ["doc", "print"]).dropDuplicates(["doc", "print"]).select("doc", "signature"))
    prefix = scratch.store(_postings(rule, representatives))

    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    grown = components(scratch, links(rule, scratch, prefix, representatives, texts)).withColumnRenamed("node", "doc")
    named = classes.join(grown, "doc", "left").select("print", F.coalesce("component", "doc").alias("component"))
    out = features.select("doc_id", "n_shingles", "print").join(named, "print", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    result = scratch.store(out.withColumn("kept", F.col("doc_id") == F.col("component_id")))
    scratch.drop()
    return result


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
   ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
 reach AS (WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION
   SELECT r.a, x.v FROM r JOIN (SELECT u, v FROM e UNION ALL SELECT v, u FROM e) x ON x.u = r.b) SELECT a, min(b) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON a = d.doc_id
"""


@query("op8_minhash_near_dedup", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
