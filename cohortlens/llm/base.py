"""Shared pieces: tables, intermediate tables in the shared folder, byte chunks and hashes, components."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import shared_dir

#: Bytes of text that a numpy step handles at once; a longer text is a chunk of its own.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_struct(docs: DataFrame) -> Column:
    """All columns of a row in one, so that names of a step's own cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


class Scratch:
    """Intermediate tables as Parquet below the shared folder.

    A stored table cuts the lineage, and a lost executor costs no more than the
    tasks it was running.  ``drop`` removes tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.places: dict[int, int] = {}

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.places[id(stored)] = len(self.paths) - 1
        return stored

    def discard(self, *tables: DataFrame) -> None:
        """Delete stored tables that nothing reads any more, and let their shuffle files go."""
        for df in tables:
            at = self.places.pop(id(df))
            self._delete(self.paths[at])
            self.paths[at] = ""

    def free(self) -> None:
        """Let Spark's cleaner remove shuffle files of finished steps; it acts when the driver collects garbage.

        The first collection leaves those of the step that has just finished.
        """
        for wait in (0.2, 0):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(wait)

    def drop(self, keep: int = 1) -> None:
        """Delete all stored tables but the last ``keep``."""
        gone = self.paths[:-keep] if keep else list(self.paths)
        for path in gone:
            if path:
                self._delete(path)
        self.paths = [""] * len(gone) + self.paths[len(gone):]

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def fold_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also changes other letters)."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# --- bytes and hashes in tasks --------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE = _BASE if _BASE % 8 == 5 else _BASE ^ 2
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK:
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Hash of any byte range of a buffer in constant time (polynomial over random byte values)."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _BYTE)[data] * _powers(_BASE, n), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) with about ``limit`` bytes each; whole rows only."""
    if not len(column):
        return
    data, bounds = byte_column(column)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[bounds[first]:bounds[end]], bounds[first:end + 1] - bounds[first]
        first = end


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of marked bytes that do not cross a row: start, end and row of each."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


#: White space of the word rule ``[^\\x20\\x09-\\x0D]+``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def word_hashes(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z folded) of several rows, and each row's first word as offsets."""
    starts, ends, row = runs(inside[data], bounds)
    first = np.searchsorted(row, np.arange(len(bounds)))
    return Rolling(data, fold=True).of(starts, ends), first


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct hashes of ``k`` consecutive words; a shorter text is one shingle, no word none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < k:
        k = len(words)
    n = len(words) - k + 1
    h = np.full(n, np.uint64(k))
    for j in range(k):
        h = (h * np.uint64(_BASE)) + words[j:j + n]
        h ^= h >> np.uint64(29)
    return np.unique(mix(h))


# --- connected components --------------------------------------------------------

def components(scratch: Scratch, edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges``.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until the
    edges no longer change.  Neighbourhood minima are aggregates with map-side
    combine and are joined back, so that no neighbourhood meets in one task.
    Nodes without an edge are not returned.
    """
    now = scratch.store(edges.where(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        before, now = now, scratch.store(small)
        scratch.discard(before)
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (state := tuple(row)) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
