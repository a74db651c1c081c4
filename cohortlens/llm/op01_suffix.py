"""Removal of byte strings of 50 and more that an earlier document holds already.

A suffix order over the whole collection needs one round per byte of the longest
text.  Here the column-wise construction runs on aligned pieces instead, so that
the number of rounds is fixed by the string length:

1. *Anchors.*  Every 50-byte window has an anchor, the least of its 20-byte
   hashes; equal windows have equal anchors at equal offsets.  Windows with one
   anchor form a block.  Blocks are shuffled by anchor, in packed arrays.  A block
   that an earlier document holds too is removed as a whole; an anchor with one
   block needs no more.
2. *Columns.*  The first occurrences of different blocks of an anchor are a
   collection of short texts aligned at the anchor.  Each round inserts one symbol
   of every text, from the last column to the first, and updates the order of the
   collection (stable by symbol, as in column-wise Burrows-Wheeler construction)
   and the common prefixes of neighbours.  Neighbours with 50 bytes in common hold
   the same window; the smallest document of such a run is its first holder.
3. *Cut.*  The windows found go back to their documents, packed by document
   bucket, and their union is cut out.

The tables between the steps are Parquet in the shared folder; texts stay in
documents' order of arrival and nothing is gathered.  Bucket counts follow
``spark.sql.shuffle.partitions``, so a bucket keeps its size as data grow.

Null texts are empty, texts below 50 bytes are kept whole, rows without id are
kept whole and remove nothing, repeated rows (same id) do not remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import Rolling, Scratch, byte_column, chunks, table
from cohortlens.llm.registry import query

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
COLUMNS = LENGTH + WINDOW - 1
#: Bytes of text whose anchors a task gathers before it sends them.
FLUSH = 16 << 20
_POSITION = np.uint64((1 << 30) - 1)
_PACKED = "bucket int, doc binary, start binary, anchor binary, block binary, before binary, count binary"
_FIELDS = (("doc", np.int64), ("start", np.uint32), ("anchor", np.uint32), ("block", np.uint64), ("before", np.uint8), ("count", np.uint8))


def _least(key: np.ndarray) -> np.ndarray:
    """Minimum of each run of WINDOW neighbours, by doubling."""
    span, low = 1, key
    while 2 * span <= WINDOW:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = WINDOW - span
    return np.minimum(low[:len(key) - WINDOW + 1], low[rest:rest + len(key) - WINDOW + 1])


def _blocks(data: np.ndarray, bounds: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray] | None:
    n = len(data)
    if n < LENGTH:
        return None
    rolling = Rolling(data)
    at = np.arange(n - GRAM + 1)
    gram = rolling.of(at, at + GRAM)
    least = _least((gram & ~_POSITION) | at.astype(np.uint64)) & _POSITION
    row = np.repeat(np.arange(len(ids)), np.diff(bounds))[:n - LENGTH + 1]
    start = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= bounds[row + 1])
    if not len(start):
        return None
    anchor = least[start].astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    low, high, anchor = start[first], start[last], anchor[first]
    row = row[low]
    return {
        "doc": ids[row], "start": (low - bounds[row]).astype(np.uint32), "gram": gram[anchor],
        "block": rolling.of(low, high + LENGTH), "before": (anchor - low).astype(np.uint8), "count": (high - low).astype(np.uint8),
    }


def _packed(found: dict[str, np.ndarray], bucket: np.ndarray, fields: tuple) -> pa.RecordBatch:
    """One row per bucket with the bytes of each array."""
    order = np.argsort(bucket, kind="stable")
    keys, first = np.unique(bucket[order], return_index=True)
    edges = np.append(first, len(order))
    columns = {"bucket": pa.array(keys.astype(np.int32))}
    for name, kind in fields:
        sorted_ = found[name][order].astype(kind, copy=False)
        columns[name] = pa.array([sorted_[edges[i]:edges[i + 1]].tobytes() for i in range(len(keys))], pa.binary())
    return pa.record_batch(columns)


def _unpacked(rows: pa.Table, fields: tuple) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind) for name, kind in fields}


def _anchors(n_buckets: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            gram = found.pop("gram")
            found["anchor"] = (gram >> np.uint64(32)).astype(np.uint32)
            return _packed(found, ((gram & np.uint64(0xFFFFFFFF)) % np.uint64(n_buckets)).astype(np.int32), _FIELDS)

        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, end, data, bounds in chunks(batch.column("text")):
                if (found := _blocks(data, bounds, ids[first:end])) is not None:
                    held.append(found)
                    size += len(data)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return job


_SPAN = (("doc", np.int64), ("start", np.uint32), ("length", np.uint8))
_OPEN = (("doc", np.int64), ("start", np.uint32), ("anchor", np.uint32), ("home", np.int32), ("before", np.uint8), ("count", np.uint8))
_ROUTED = "bucket int, kind int, doc binary, start binary, length binary, anchor binary, home binary, before binary, count binary"


def _routed(kind: int, found: dict[str, np.ndarray], n_buckets: int, fields: tuple) -> list[pa.RecordBatch]:
    """Packed rows by document bucket, with empty bytes for fields of the other kind."""
    if not len(found["doc"]):
        return []
    batch = _packed(found, np.mod(found["doc"], n_buckets).astype(np.int32), fields)
    have = {n: batch.column(n) for n in batch.schema.names} | {"kind": pa.array([kind] * len(batch), pa.int32())}
    empty = pa.array([b""] * len(batch), pa.binary())
    names = [c.split()[0] for c in _ROUTED.split(", ")]
    return [pa.record_batch({n: have.get(n, empty) for n in names})]


def _table(batches: list[pa.RecordBatch]) -> pa.Table:
    schema = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.binary()) for c in _ROUTED.split(", ")])
    return pa.Table.from_batches(batches, schema)


def _repeats(n_buckets: int):
    """Per anchor bucket: whole blocks to cut (kind 0) and first occurrences of differing blocks (kind 1)."""

    def job(rows: pa.Table) -> pa.Table:
        home = rows.column("bucket")[0].as_py()
        x = _unpacked(rows, _FIELDS)
        order = np.lexsort((x["block"], x["anchor"]))
        x = {k: v[order] for k, v in x.items()}
        new_anchor = np.ones(len(order), bool)
        new_anchor[1:] = x["anchor"][1:] != x["anchor"][:-1]
        new_block = new_anchor.copy()
        new_block[1:] |= x["block"][1:] != x["block"][:-1]
        a_first, b_first = np.flatnonzero(new_anchor), np.flatnonzero(new_block)
        a_of, b_of = np.cumsum(new_anchor) - 1, np.cumsum(new_block) - 1
        a_low, a_high = np.minimum.reduceat(x["doc"], a_first), np.maximum.reduceat(x["doc"], a_first)
        b_low = np.minimum.reduceat(x["doc"], b_first)
        mixed = np.add.reduceat(new_block.astype(np.int64), a_first) > 1
        cut = x["doc"] > b_low[b_of]
        spans = {"doc": x["doc"][cut], "start": x["start"][cut], "length": x["count"][cut] + np.uint8(LENGTH)}
        still = ~cut & (mixed & (a_low != a_high))[a_of]
        left = {k: x[k][still] for k in ("doc", "start", "anchor", "before", "count")}
        left["home"] = np.full(len(left["doc"]), home, np.int32)
        return _table(_routed(0, spans, n_buckets, _SPAN) + _routed(1, left, n_buckets, _OPEN))

    return job


_TEXTS = (("doc", np.int64), ("start", np.uint32), ("anchor", np.uint32), ("before", np.uint8), ("count", np.uint8))
_TEXT_ROWS = "bucket int, doc binary, start binary, anchor binary, before binary, count binary, bytes binary"


def _lookup(docs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of a bucket of documents, its sorted ids and their rows (-1: no id)."""
    data, bounds = byte_column(docs.column("text"))
    ids = docs.column("doc_id").to_pandas()
    rows = np.flatnonzero(ids.notna().to_numpy())
    values = ids.iloc[rows].to_numpy(np.int64)
    order = np.argsort(values, kind="stable")
    return data, bounds, values[order], rows[order]


def _contexts(docs: pa.Table, rows: pa.Table) -> pa.Table:
    schema = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.binary()) for c in _TEXT_ROWS.split(", ")])
    if not len(docs) or not len(rows):
        return schema.empty_table()
    x = _unpacked(rows, _OPEN)
    data, bounds, ids, at = _lookup(docs)
    begin = bounds[at[np.searchsorted(ids, x["doc"])]] + x["start"]
    size = x["count"].astype(np.int64) + LENGTH
    order = np.argsort(x["home"], kind="stable")
    keys, first = np.unique(x["home"][order], return_index=True)
    edges = np.append(first, len(order))
    out = {"bucket": pa.array(keys.astype(np.int32))}
    for name, _ in _TEXTS:
        out[name] = pa.array([x[name][order[edges[i]:edges[i + 1]]].tobytes() for i in range(len(keys))], pa.binary())
    pieces = []
    for i in range(len(keys)):
        part = order[edges[i]:edges[i + 1]]
        shift = np.cumsum(size[part]) - size[part]
        pieces.append(data[np.repeat(begin[part] - shift, size[part]) + np.arange(size[part].sum())].tobytes())
    out["bytes"] = pa.array(pieces, pa.binary())
    return pa.table(out, schema=schema)


def column_rounds(symbols: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """First holders of the windows of aligned texts.

    ``symbols`` (columns x texts) has 256 outside a text; only texts of one group
    are compared.  Each round inserts the symbol of one column into all texts,
    keeps the texts in the order of what follows and the length of the prefix
    that neighbours share.  Returns (WINDOW x texts) the smallest doc whose text
    has the same LENGTH symbols from that column on.
    """
    n = len(doc)
    order = np.argsort(group, kind="stable")
    common = np.zeros(n + 1, np.int64)
    first_holder = np.zeros((WINDOW, n), np.int64)
    wide = group.astype(np.int64) * 257
    for column in range(len(symbols) - 1, -1, -1):
        key = wide[order] + symbols[column][order]
        step = np.argsort(key, kind="stable")
        key = key[step]
        same = np.flatnonzero(key[1:] == key[:-1])
        fresh = np.zeros(n + 1, np.int64)
        if len(same):
            between = np.empty(2 * len(same), np.int64)
            between[0::2], between[1::2] = step[same] + 1, step[same + 1] + 1
            fresh[same + 1] = np.minimum(np.minimum.reduceat(common, between)[::2] + 1, LENGTH)
        order, common = order[step], fresh
        if column < WINDOW:
            start = np.flatnonzero(common[:n] < LENGTH)
            low = np.minimum.reduceat(doc[order], start)
            first_holder[column, order] = np.repeat(low, np.diff(np.append(start, n)))
    return first_holder


_BATCH = 1 << 16


def _columns(n_buckets: int):
    def job(rows: pa.Table) -> pa.Table:
        x = _unpacked(rows, _TEXTS)
        data = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8)
        size = x["count"].astype(np.int64) + LENGTH
        begin = np.cumsum(size) - size
        order = np.argsort(x["anchor"], kind="stable")
        edges = np.flatnonzero(np.append(True, x["anchor"][order][1:] != x["anchor"][order][:-1]))
        out: list[pa.RecordBatch] = []
        i = 0
        while i < len(edges):
            # Whole groups, about _BATCH texts at once.
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + _BATCH)))
            part = order[edges[i]:edges[j] if j < len(edges) else len(order)]
            i = j
            group = np.unique(x["anchor"][part], return_inverse=True)[1]
            left = WINDOW - 1 - x["before"][part].astype(np.int64)
            symbols = np.full((COLUMNS, len(part)), 256, np.int16)
            text = np.repeat(np.arange(len(part)), size[part])
            inner = np.arange(size[part].sum()) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            symbols[np.repeat(left, size[part]) + inner, text] = data[np.repeat(begin[part], size[part]) + inner]
            holder = column_rounds(symbols, group, x["doc"][part])
            column = np.arange(WINDOW)[:, None]
            gone = (holder < x["doc"][part]) & (column >= left) & (column <= left + x["count"][part])
            at, text = np.nonzero(gone)
            out += _routed(0, {"doc": x["doc"][part][text], "start": x["start"][part][text] + (at - left[text]).astype(np.uint32),
                               "length": np.full(len(at), LENGTH, np.uint8)}, n_buckets, _SPAN)
        return _table(out)

    return job


def _cut(docs: pa.Table, rows: pa.Table) -> pa.Table:
    data, bounds, ids, at = _lookup(docs)
    gone = np.zeros(len(data), bool)
    if len(rows) and len(docs):
        x = _unpacked(rows, _SPAN)
        # Repeated rows of an id all get its spans.
        low, high = np.searchsorted(ids, x["doc"]), np.searchsorted(ids, x["doc"], "right")
        n = high - low
        each = np.repeat(np.arange(len(n)), n)
        row = at[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[each]]
        start = np.minimum(bounds[row] + x["start"][each], bounds[row + 1])
        end = np.minimum(start + x["length"][each], bounds[row + 1])
        depth = np.bincount(start, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
        gone = np.cumsum(depth)[:-1] > 0
    out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
    for i in range(len(docs)):
        part, off = data[bounds[i]:bounds[i + 1]], gone[bounds[i]:bounds[i + 1]]
        removed = int(off.sum())
        out["n_bytes"].append(len(part))
        out["n_removed"].append(removed)
        out["n_spans"].append(int(off[0]) + int((off[1:] & ~off[:-1]).sum()) if removed else 0)
        out["kept_sha256"].append(hashlib.sha256(part[~off].tobytes() if removed else part.tobytes()).hexdigest())
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                     "n_removed": pa.array(out["n_removed"], pa.int64()), "n_spans": pa.array(out["n_spans"], pa.int64()),
                     "kept_sha256": pa.array(out["kept_sha256"], pa.string())})


def remove_repeats(docs: DataFrame, name: str = "suffix") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, name)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.where("doc_id is not null and octet_length(text) >= 50").mapInArrow(_anchors(n_buckets), _PACKED)
    routed = scratch.store(found.groupBy("bucket").applyInArrow(_repeats(n_buckets), _ROUTED))
    scratch.free()
    by_bucket = texts.withColumn("bucket", F.coalesce(F.expr(f"pmod(doc_id, {n_buckets})"), F.lit(0)).cast("int"))
    first = routed.where("kind = 1").groupBy("bucket")
    pieces = by_bucket.where("doc_id is not null").groupBy("bucket").cogroup(first).applyInArrow(
        lambda a, b: _contexts(a, b), _TEXT_ROWS)
    windows = scratch.store(pieces.groupBy("bucket").applyInArrow(_columns(n_buckets), _ROUTED))
    scratch.free()
    spans = routed.where("kind = 0").unionByName(windows).select("bucket", "doc", "start", "length")
    result = scratch.store(by_bucket.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(
        lambda a, b: _cut(a, b), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    scratch.drop()
    return result


SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
 n AS (SELECT doc_id, x, CAST(len(x) // 2 AS BIGINT) AS n FROM h),
 w AS (SELECT doc_id, unnest(range(0, n - 49)) AS i, x FROM n WHERE n >= 50),
 g AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM w),
 m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS low FROM g),
 c AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS b FROM m WHERE low < doc_id),
 r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE NOT joined) AS n_spans FROM
   (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY b) = b - 1, false) AS joined FROM c) GROUP BY 1),
 k AS (SELECT n.doc_id, coalesce(string_agg(substr(x, 2 * j + 1, 2), '' ORDER BY j), '') AS kept FROM n, unnest(range(0, n)) t(j)
   LEFT JOIN c ON c.doc_id = n.doc_id AND c.b = j WHERE c.b IS NULL GROUP BY 1)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM n LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op1_suffix_dedup", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
