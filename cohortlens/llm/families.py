"""Links between alike texts from inverted lists, without expanding families into pairs of rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.base import CHUNK, Scratch, byte_column, components, mix, shingles, word_hashes

_SLICE = 4096


@dataclass(frozen=True)
class Rule:
    """When two texts are candidates (equal signature coordinates) and when they are linked (shared shingles)."""

    coordinates: int
    min_matches: int
    numerator: int
    denominator: int = 100
    #: Members of a list are offered to so many centres.
    centres: int = 2
    #: Documents of a family that one task compares with as many others.
    block: int = 256

    def signature(self, items: np.ndarray, bits: int = 32) -> np.ndarray:
        """MinHash values of a shingle set, their upper ``bits``."""
        a = mix(np.arange(1, self.coordinates + 1, dtype=np.uint64)) | np.uint64(1)
        b = mix(np.arange(1001, self.coordinates + 1001, dtype=np.uint64))
        low = np.full(self.coordinates, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(items), _SLICE):
            np.minimum(low, (items[i:i + _SLICE, None] * a + b).min(axis=0), out=low)
        return (low >> np.uint64(64 - bits)).astype(np.uint32).view(np.int32)


    def signatures(self, items: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int = 16) -> np.ndarray:
        """MinHash values of many ranges of one array of shingles, none of them empty: a row for each range."""
        out = np.empty((len(starts), self.coordinates), np.uint64)
        if not len(starts):
            return out
        a = mix(np.arange(1, self.coordinates + 1, dtype=np.uint64)) | np.uint64(1)
        b = mix(np.arange(1001, self.coordinates + 1001, dtype=np.uint64))
        edges = np.stack([starts, ends], axis=1).ravel()
        row = np.empty(len(items) + 1, np.uint64)
        for c in range(self.coordinates):
            np.multiply(items, a[c], out=row[:-1])
            row[:-1] += b[c]
            row[-1] = np.iinfo(np.uint64).max
            out[:, c] = np.minimum.reduceat(row, edges)[::2]
        return out >> np.uint64(64 - bits)


def _joined(rule: Rule, signatures: np.ndarray, sets: list[np.ndarray], left: int | None) -> list[tuple[int, int]]:
    """Links that join the documents of a block, or of its first ``left`` rows with the others, as far as they are alike."""
    n = len(sets)
    root = np.arange(n)
    links = []
    sizes = np.array([len(s) for s in sets])
    for i in range(n - 1 if left is None else left):
        others = np.arange(i + 1, n) if left is None else np.arange(left, n)
        others = others[root[others] != root[i]]
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[rule.denominator * small >= rule.numerator * large]
        others = others[(signatures[others] == signatures[i]).sum(axis=1) >= rule.min_matches]
        for j in others.tolist():
            if root[i] == root[j]:
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if rule.denominator * common >= rule.numerator * (sizes[i] + sizes[j] - common):
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


_LINKS = "u long, v long"


def _compare(rule: Rule, rows: pa.Table) -> pa.Table:
    """Links inside the families, or between the two blocks, of a bucket."""
    rows = rows.sort_by([("family", "ascending"), ("i", "ascending"), ("j", "ascending"), ("side", "ascending"), ("doc", "ascending")])
    keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("family", "i", "j")])
    edges = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))) if len(rows) else np.zeros(0, np.int64)
    docs, side = rows.column("doc").to_numpy(), rows.column("side").to_numpy()
    signatures = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(len(rows), rule.coordinates)
    data, bounds = byte_column(rows.column("text"))
    u, v = [], []
    # Families are mostly small: their words are hashed together, as far as they fit.
    together = word_hashes(data, bounds) if len(data) <= 4 * CHUNK else None
    for a, b in zip(edges, np.append(edges[1:], len(rows)), strict=True):
        hashes, starts = (together[0], together[1][a:b + 1]) if together else word_hashes(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
        sets = [shingles(hashes[starts[k]:starts[k + 1]]) for k in range(b - a)]
        one = keys[1, a] == keys[2, a]
        for x, y in _joined(rule, signatures[a:b], sets, None if one else int((side[a:b] == 0).sum())):
            u.append(docs[a + x])
            v.append(docs[a + y])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _matches(a: str, b: str) -> Column:
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda s, x: s + x)


def _in_blocks(rule: Rule, members: DataFrame, buckets: int) -> DataFrame:
    """Links inside families; members: doc, family, signature, text."""
    sizes = members.groupBy("family").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / rule.block).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    placed = members.join(sizes.withColumn("blocks", blocks), "family").withColumn("own", own)
    # A block meets every block of its family once; a family of one block is compared as it is.
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", "doc", "text", "signature", "blocks",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    bucket = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(F.xxhash64("family", "i", "j"))
    return spread.withColumn("bucket", bucket).drop("blocks").groupBy("bucket").applyInArrow(lambda rows: _compare(rule, rows), _LINKS)


def links(rule: Rule, scratch: Scratch, lists: DataFrame, representatives: DataFrame,
          texts: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) that join all alike texts.

    ``lists``: doc, key; ``representatives``: doc, signature; ``texts``: doc, text, or what gives
    them for a table of docs.
    Every pair that shares a list and has enough equal coordinates is confirmed on
    the full texts, or already joined by links found before.
    """
    # Members of a list against its centres: at most rule.centres pairs for a posting.
    centres = lists.groupBy("key").agg(*[
        F.min(F.struct(F.xxhash64(F.lit(c), F.col("doc")).alias("order"), F.col("doc").alias("doc"))).alias(f"c{c}") for c in range(rule.centres)])
    offered = lists.join(centres, "key").select("doc", F.explode(F.array(*[F.col(f"c{c}.doc") for c in range(rule.centres)])).alias("centre"))
    pairs = offered.where("doc != centre").select(F.greatest("doc", "centre").alias("u"), F.least("doc", "centre").alias("v")).distinct()
    side = {s: representatives.select(F.col("doc").alias(s), F.col("signature").alias(f"signature_{s}")) for s in "uv"}
    alike = pairs.join(side["u"], "u").join(side["v"], "v").where(_matches("signature_u", "signature_v") >= rule.min_matches).select("u", "v")
    families = components(scratch, alike).select(F.col("node").alias("doc"), F.col("component").alias("family"))

    # Lists that still hold several families: their pairs of different families, counted on the signatures.
    labelled = scratch.store(lists.join(families, "doc", "left").withColumn("family", F.coalesce("family", "doc")))
    mixed = labelled.groupBy("key").agg(F.min("family").alias("low"), F.max("family").alias("high")).where("low != high").select("key")
    open_lists = labelled.join(mixed, "key").join(representatives, "doc")
    other = open_lists.select("key", F.col("doc").alias("v"), F.col("family").alias("family_v"), F.col("signature").alias("signature_v"))
    apart = open_lists.join(other, "key").where((F.col("doc") > F.col("v")) & (F.col("family") != F.col("family_v")) & (
        _matches("signature", "signature_v") >= rule.min_matches)).select(F.col("doc").alias("u"), "v").distinct()
    apart = scratch.store(apart)
    scratch.discard(labelled)
    scratch.free()

    members = families.unionByName(apart.select(F.explode(F.array("u", "v")).alias("doc"), F.concat(F.lit("p"), "u", F.lit(":"), "v").alias("family")).select(
        "doc", F.xxhash64("family").alias("family")))
    wanted = scratch.store(members.join(representatives, "doc"))
    scratch.free()
    named = wanted.select("doc").distinct()
    texts = texts(named) if callable(texts) else texts.where("text is not null").join(named, "doc")
    buckets = 8 * int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    return scratch.store(_in_blocks(rule, wanted.join(texts, "doc"), buckets))
