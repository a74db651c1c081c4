"""Packing token ids into windows of equal length by multiway differencing.

A document's ids (and a closing id 0) are cut into whole windows; what is left
below a window is packed.  Remainders are dealt by a hash into groups of about
``GROUP`` windows.  A group of remainders with sum S starts with ceil(S / window)
windows and is packed by the Karmarkar-Karp method: every remainder is a partial
partition, and the two partitions with the largest imbalance are merged with
their imbalances opposed, until one is left.  Windows are then near-equal.  While one of
them exceeds the capacity the number of windows rises, by up to ``MORE_WINDOWS`` of it, which keeps
remainders whole; only what still exceeds a window then (a group of very large remainders) is
cut off and moved into windows with room (``cut=False``: the number rises until all fit).

Texts are read once.  Ids are those of the tokenizer file: its merges never cross
a space that follows a non-space, so units between such spaces are encoded once
and kept in a bounded cache.

Null and empty texts have the closing id only.  Repeated rows are packed each on
its own.  Very long texts are encoded whole.  An empty table gives no piece.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import Scratch, chunks, table
from cohortlens.llm.registry import query

WINDOW = 1024
GROUP = 128
#: Windows that a group may have beyond those its ids need, before anything is cut.
MORE_WINDOWS = 0.02
#: Units kept in a task's cache before it starts anew.
CACHE = 300_000
TOKENIZER = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"
_SPACE_RUN = re.compile(r"\s (?:\s|$)")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_AFTER_SPACE = ("  ", " \n", " \t", " \r", " \x0b", " \x0c")


class Encoder:
    """Ids of texts by a public vocabulary; the rank file is the same vocabulary as the tokenizer file."""

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(public_tokenizers.path(f"{name}.tiktoken"), "rb"))}
        self.units = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.clear()

    def clear(self) -> None:
        self.spaced: dict[str, int] = {}
        self.literal: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _learn(self, known: dict[str, int], missing: list[str], lead: str) -> None:
        plain = [u for u in missing if _SPECIAL not in u]
        odd = [u for u in missing if _SPECIAL in u]
        pieces, counts = [], []
        if plain and lead:
            # Every unit starts with the space, so the units can be encoded in one go.
            joined = np.array(self.units.encode_ordinary("".join(lead + u for u in plain)), np.uint32)
            ends = np.cumsum([len(u.encode()) + len(lead) for u in plain])
            at = np.searchsorted(np.cumsum(self.size[joined]), ends) + 1
            pieces.append(joined)
            counts += np.diff(at, prepend=0).tolist()
        else:
            for u in plain:
                pieces.append(np.array(self.units.encode_ordinary(u), np.uint32))
                counts.append(len(pieces[-1]))
        for u in odd:
            pieces.append(np.array(self.whole.encode(lead + u, add_special_tokens=False).ids, np.uint32))
            counts.append(len(pieces[-1]))
        base = len(self.first) - 1
        for i, u in enumerate(plain + odd):
            known[u] = base + i
        self.ids = np.concatenate([self.ids, *pieces])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts, dtype=np.int64)])

    def _index(self, known: dict[str, int], units: list[str], lead: str) -> np.ndarray:
        found = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        gone = np.flatnonzero(found < 0)
        if len(gone):
            # Sorted by first appearance; joined encoding is only safe for units that do not end in white space.
            missing = list(dict.fromkeys(units[i] for i in gone))
            safe = [u for u in missing if u and not u[-1].isspace() and not u[0].isspace()]
            self._learn(known, safe, lead)
            for u in missing:
                if u not in known:
                    ids = self.whole.encode(lead + u, add_special_tokens=False).ids
                    known[u] = len(self.first) - 1
                    self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
                    self.first = np.append(self.first, self.first[-1] + len(ids))
            found[gone] = [known[units[i]] for i in gone]
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.spaced) + len(self.literal) > CACHE:
            self.clear()
        literal: list[str] = []
        spaced: list[str] = []
        shape = []
        for text in texts:
            odd = any(p in text for p in _AFTER_SPACE) or text.endswith(" ") or not text.isascii() and _SPACE_RUN.search(text)
            if odd:
                parts = _BEFORE_SPACE.split(text)
                literal += parts
                shape.append((len(parts), 0))
            else:
                head, *rest = text.split(" ")
                literal.append(head)
                spaced += rest
                shape.append((1, len(rest)))
        a, b = self._index(self.literal, literal, ""), self._index(self.spaced, spaced, " ")
        out, i, j = [], 0, 0
        for n, m in shape:
            unit = np.concatenate([a[i:i + n], b[j:j + m]])
            i, j = i + n, j + m
            first = self.first[unit]
            size = self.first[unit + 1] - first
            shift = np.cumsum(size) - size
            out.append(self.ids[np.repeat(first - shift, size) + np.arange(size.sum())])
        return out


@lru_cache(1)
def encoder(name: str = TOKENIZER) -> Encoder:
    return Encoder(name)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = encoder().encode
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column("text")):
            raw = data.tobytes()
            texts = [raw[bounds[i]:bounds[i + 1]].decode() for i in range(end - first)]
            n, crcs, rest = [], [], []
            for ids in encode(texts):
                ids = np.append(ids, np.uint32(0))
                whole = len(ids) // WINDOW
                n.append(len(ids))
                crcs.append([_crc(ids[k * WINDOW:(k + 1) * WINDOW]) for k in range(whole)])
                rest.append(ids[whole * WINDOW:].astype("<u2").tobytes())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(first, end - first), "doc_tokens": pa.array(n, pa.int64()),
                "crcs": pa.array(crcs, pa.list_(pa.int64())), "rest": pa.array(rest, pa.binary())})


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of each of ``k`` parts with near-equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    # A partial partition holds its non-empty parts by falling sum, less the smallest sum of all k parts.
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Largest of one with smallest of the other: only parts beyond k meet.
        over = max(0, len(a) + len(b) - k)
        merged = a[:len(a) - over] + b[:len(b) - over]
        for x, y in zip(a[len(a) - over:], reversed(b[len(b) - over:]), strict=True) if over else ():
            merged.append((x[0] + y[0], x[1] + y[1]))
        merged.sort(key=lambda p: -p[0])
        low = merged[-1][0] if len(merged) == k else 0
        if low:
            merged = [(s - low, items) for s, items in merged]
        heapq.heappush(heap, (-merged[0][0], count, merged))
        count += 1
    parts = [items for _, items in heap[0][2]] if heap else []
    return parts + [[] for _ in range(k - len(parts))]


def pack(sizes: list[int], window: int = WINDOW, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length); no window exceeds ``window``."""
    total = sum(sizes)
    least = max(1, -(-total // window))
    most = least + int(least * MORE_WINDOWS) if cut else len(sizes) + 1
    for k in range(least, max(most, least) + 1):
        parts = difference(sizes, k)
        fill = [sum(sizes[i] for i in p) for p in parts]
        if max(fill) <= window:
            break
    out = [[(i, 0, sizes[i]) for i in p] for p in parts]
    loose: list[tuple[int, int, int]] = []
    for w, pieces in enumerate(out):
        while fill[w] > window:
            i, start, length = pieces.pop()
            off = min(length, fill[w] - window)
            if off < length:
                pieces.append((i, start, length - off))
            loose.append((i, start + length - off, off))
            fill[w] -= off
    at = 0
    for i, start, length in loose:
        while length:
            while fill[at] >= window:
                at += 1
            put = min(length, window - fill[at])
            out[at].append((i, start, put))
            fill[at] += put
            start, length = start + put, length - put
    return [p for p in out if p]


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_group(rows: pa.Table) -> pa.Table:
    x = rows.select(["doc_id", "doc_tokens", "rest", "bucket"]).to_pydict()
    ids = [np.frombuffer(r, "<u2") for r in x["rest"]]
    base = x["bucket"][0] << 20
    out = []
    for w, pieces in enumerate(pack([len(r) for r in ids])):
        offset = 0
        for i, start, length in pieces:
            n = x["doc_tokens"][i]
            out.append((x["doc_id"][i], n - len(ids[i]) + start, length, _crc(ids[i][start:start + length]), n, 2 * (base + w) + 1, offset))
            offset += length
    names = [c.split()[0] for c in _PIECES.split(", ")]
    return pa.table({c: pa.array([r[j] for r in out], pa.int64()) for j, c in enumerate(names)})


def packed(docs: DataFrame, name: str = "packing") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, name)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = scratch.store(texts.mapInArrow(_tokens, "doc_id long, doc_tokens long, crcs array<long>, rest binary"))
    whole = tokens.select("doc_id", "doc_tokens", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k").cast("long") * WINDOW).alias("start"), F.lit(WINDOW).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = tokens.where(F.octet_length("rest") > 0)
    total = left.agg(F.sum(F.octet_length("rest").cast("long"))).first()[0] or 0
    n_groups = max(1, -(-total // (2 * WINDOW * GROUP)))
    row = F.monotonically_increasing_id()
    dealt = left.select("doc_id", "doc_tokens", "rest", F.pmod(F.xxhash64(row), F.lit(n_groups)).alias("bucket"))
    return whole.unionByName(dealt.groupBy("bucket").applyInArrow(_pack_group, _PIECES))


@query("op9_sequence_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
