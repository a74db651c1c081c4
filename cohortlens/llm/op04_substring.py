"""Substring deduplication: paragraphs by MinHash banding, and passages inside longer paragraphs.

*Paragraphs* are the lines of a text with at least ``MIN_WORDS`` words, and *blocks* are
several lines up to the next line without a word (wrapped paragraphs).  Their MinHash
signatures are cut into 16 bands of 3 coordinates, so that a pair of Jaccard
similarity 0.8 collides in some band with a probability of 0.99999.  Equal paragraphs
are one class; classes that collide are joined, confirmed by the exact similarity of
their five-word shingle sets (0.8 or more) and clustered by components.

*Passages* are runs of ``WINDOW`` words and more that stand word for word in another
place.  A window is named by the least hash of ``ANCHOR`` words in it, so two copies
have the same name.  The up to 13 windows in a row that owe their name to the same
words are a block, kept as its place, size and the hash of its words.  Where all blocks of a name are
equal they are compared as they are (windows of a block differ, and stand at the same place in
each copy); only where they differ, at the ends of a passage, are single windows compared by
the hash of all their words.  Equal blocks have equal windows, so those of one are read for all.  The
first place (document, then position) of each block or window is
found, and it is removed where an earlier place holds it.  Only then are
neighbours with one first holder and one decision merged, so spans of
different holders can overlap; words under any removed span go.  Spans with a block or window
in common are one cluster.

Of a cluster the first member (document, then line) and what overlaps it stay; all
others are removed, also in the same document.  Windows are counted with map-side combine before a shuffle; frequent ones
are joined as the long side of a join that Spark can split.

Nulls, empty and short texts have no paragraph; rows without an id take no part;
equal rows of one id are one text, differing ones are places of one document; very long
texts are read whole; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.llm.base import _BASE, _INVERSE, CHUNK, NOT_SPACE, Scratch, _powers, chunks, components, mix, table, word_hashes
from cohortlens.llm.families import Rule, links
from cohortlens.llm.registry import query

MIN_WORDS = SHINGLE = 5
ROWS, BANDS = 3, 16
#: Pairs at 0.8 have 38.4 +- 2.8 of 48 coordinates in common.
RULE = Rule(coordinates=ROWS * BANDS, min_matches=25, numerator=80)
WINDOW = 25
#: Two copies of a window have the same least hash of so many words in a row.
ANCHOR = 13
#: At most so many windows in a row owe their name to the same words.
SPAN = WINDOW - ANCHOR + 1
#: Cluster ids are the first member's document and position in one number.
LINE_BITS = 24
#: Signatures travel as so many longs of four coordinates each, which Spark can aggregate without sorting.
PACKED = [f"s{i}" for i in range(ROWS * BANDS // 4)]
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, part, line, last, n_words, print, packed signature of lines and of blocks of lines (``last`` > ``line``)."""
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column("text")):
            breaks = np.flatnonzero(data == 10)
            edges = np.unique(np.concatenate([bounds, breaks, [len(data)]]))
            hashes, starts = word_hashes(data, edges)
            row = np.searchsorted(bounds, edges[:-1], "right") - 1
            # A line's number is the count of breaks before it in its text.
            line = np.searchsorted(breaks, edges[:-1], "right") - np.searchsorted(breaks, bounds[row], "left")
            filled = np.flatnonzero(np.diff(starts))
            new = np.append(True, (np.diff(filled) > 1) | (np.diff(row[filled]) > 0))[:len(filled)]
            low, high = filled[new], filled[np.append(new[1:], True)[:len(filled)]]
            low, high = (np.concatenate([filled, x[high > low]]) for x in (low, high))
            use = starts[high + 1] - starts[low] >= MIN_WORDS
            low, high = low[use], high[use]
            begin, stop = starts[low], starts[high + 1]
            prints = _prints(hashes, begin, stop)
            # Copies within the chunk are told by their print; one of them carries the signature.
            first_of = _firsts(prints)
            signed = RULE.signatures(_grams(hashes, SHINGLE), begin[first_of], stop[first_of] - SHINGLE + 1)
            values = np.zeros((len(low), RULE.coordinates), np.uint16)
            values[first_of] = signed
            packed = values.view(np.int64)
            absent = np.ones(len(low), bool)
            absent[first_of] = False
            at = pa.array(first + row[low], pa.int64())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(at), "part": batch.column("part").take(at),
                "line": pa.array(line[low], pa.int64()), "last": pa.array(line[high], pa.int64()),
                "n_words": pa.array(stop - begin, pa.int64()), "print": _binary(prints),
                **{name: pa.array(packed[:, i], mask=absent) for i, name in enumerate(PACKED)}})


def _prints(words: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Two hashes of each range of words."""
    return np.stack([_ranges(mix(words + np.uint64(k)), begin, stop) for k in (0, 1)], axis=1)


def _firsts(prints: np.ndarray) -> np.ndarray:
    """Places of the first row of each print, in order (which the ranges of the signatures need)."""
    order = np.lexsort((prints[:, 1], prints[:, 0]))
    new = np.append(True, (np.diff(prints[order], axis=0) != 0).any(axis=1))[:len(order)]
    return np.sort(order[new])


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of two longs as 16 bytes each."""
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])
    return fixed.cast(pa.binary())


def _ranges(words: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each range of words (a polynomial in their hashes)."""
    powers, inverse = _powers(_BASE, len(words)), _powers(_INVERSE, len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers, out=sums[1:])
    return mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))


def _unit_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, text of the units (doc, line, last) of each row's text."""
    for batch in batches:
        for text, units in zip(batch.column("text"), batch.column("units"), strict=True):
            lines = text.as_py().split("\n")
            docs, texts, size = [], [], 0
            for u in units.as_py():
                docs.append(u["doc"])
                texts.append("\n".join(lines[u["line"]:u["last"] + 1]))
                size += len(texts[-1])
                if size > CHUNK:
                    yield pa.record_batch({"doc": pa.array(docs, pa.int64()), "text": pa.array(texts, pa.string())})
                    docs, texts, size = [], [], 0
            yield pa.record_batch({"doc": pa.array(docs, pa.int64()), "text": pa.array(texts, pa.string())})


def _least(key: np.ndarray, width: int) -> np.ndarray:
    span, low = 1, key
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    n = len(key) - width + 1
    return np.minimum(low[:n], low[rest:rest + n])


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on."""
    n = max(len(words) - k + 1, 0)
    key = np.zeros(n, np.uint64)
    for j in range(k):
        key = key * _PRIME + words[j:j + n]
    return mix(key)


def _windows_of(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window that does not cross a text, and the number of its text."""
    sizes = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(len(text)) - before[text] + starts[:-1][text], text


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, part, anchor, start, count, key of the blocks of windows of each text."""
    for batch in batches:
        for first, _end, data, bounds in chunks(batch.column("text")):
            words, starts = word_hashes(data, bounds, NOT_SPACE)
            at, text = _windows_of(words, starts)
            if not len(at):
                continue
            grams = _grams(words, ANCHOR)
            low = _least(grams, SPAN)
            # The leftmost place of the least hash; windows that share it are one block.
            step = np.full(len(low), SPAN - 1, np.int8)
            for k in range(SPAN - 2, -1, -1):
                step[grams[k:k + len(low)] == low] = k
            low, where = low[at], at + step[at]
            new = np.append(True, (np.diff(where) > 0) | (np.diff(text) > 0))
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(at)))
            start = at[begin]
            row = pa.array(first + text[begin], pa.int64())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(row), "part": batch.column("part").take(row),
                "anchor": pa.array(low[begin].view(np.int64)), "start": pa.array((start - starts[text[begin]]).astype(np.int32)),
                "count": pa.array(count.astype(np.int32)), "key": pa.array(_ranges(words, start, start + count + WINDOW - 1).view(np.int64))})


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, offset, key, first and last place of the windows of the blocks in the row's ``ranges``."""
    for batch in batches:
        for first, end, data, bounds in chunks(batch.column("text")):
            words, starts = word_hashes(data, bounds, NOT_SPACE)
            wanted = batch.column("ranges").slice(first, end - first)
            sizes = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            of = {c: flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (
                "block", "start", "count", "last_doc", "last_part", "last_start")}
            count = of["count"]
            each = np.repeat(np.arange(len(count)), count)
            offset = np.arange(len(each)) - (np.cumsum(count) - count)[each]
            text = np.repeat(np.arange(end - first), sizes)[each]
            start = of["start"][each] + offset
            at = starts[text] + start
            row = pa.array(first + text, pa.int64())
            yield pa.record_batch({
                "block": pa.array(of["block"][each]), "offset": pa.array(offset.astype(np.int32)),
                "key": pa.array(_ranges(words, at, at + WINDOW).view(np.int64)),
                "doc_id": batch.column("doc_id").take(row), "part": batch.column("part").take(row), "start": pa.array(start.astype(np.int32)),
                "last_doc": pa.array(of["last_doc"][each]), "last_part": pa.array(of["last_part"][each]),
                "last_start": pa.array((of["last_start"][each] + offset).astype(np.int32))})


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition whose key another row has."""
    if not (found := list(batches)):
        return
    doc, key = (np.concatenate([b.column(c).to_numpy() for b in found]) for c in ("doc", "key"))
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    kept = order[np.append(same, False) | np.append(False, same)] if len(order) else order
    yield pa.record_batch({"doc": pa.array(doc[kept]), "key": pa.array(key[kept])})


def _band_keys() -> Column:
    """The bits of each band's coordinates, and its number."""
    def bits(b: int) -> Column:
        low, shift = divmod(16 * ROWS * b, 64)
        found = F.shiftrightunsigned(PACKED[low], shift)
        if shift + 16 * ROWS > 64:
            found = found.bitwiseOR(F.shiftleft(PACKED[low + 1], 64 - shift))
        return F.shiftleft(found, 64 - 16 * ROWS).bitwiseOR(F.lit(b))

    return F.array(*[bits(b) for b in range(BANDS)])


def _signature() -> Column:
    """The coordinates of a packed signature, as shorts."""
    def coordinate(c: int) -> Column:
        bits = F.shiftright(PACKED[c // 4], 16 * (c % 4)).bitwiseAND(F.lit(0xFFFF))
        return (bits.bitwiseXOR(F.lit(0x8000)) - 0x8000).cast("short")

    return F.array(*[coordinate(c) for c in range(ROWS * BANDS)])


def _place_id(doc: str, position: str) -> Column:
    """One number for a document and a position in it, whatever the two are."""
    number = lambda x: F.lit(Decimal(x))
    wide = F.col(doc).cast("decimal(20,0)")
    return F.when(F.col(position) < 1 << LINE_BITS, wide * number(1 << LINE_BITS) + F.col(position)).otherwise(
        number(1 << 100) + (wide + number(1 << 63)) * number(1 << 32) + F.col(position)).cast("decimal(38,0)")


def paragraph_clusters(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, unit, position (line), n_words, cluster_id, first_doc_id, removed of near-equal paragraphs and blocks."""
    # Each row has a number of its own, fixed by storing it, whatever the ids are; a class goes by its least one.
    longs = ", ".join(f"{c} long" for c in PACKED)
    found = docs.mapInArrow(_paragraphs, f"doc_id long, part long, line long, last long, n_words long, print binary, {longs}")
    found = scratch.store(found.withColumn("doc", F.monotonically_increasing_id()))
    # Any signature of a class will do: they are equal where present.
    classes = scratch.store(found.groupBy("print").agg(F.min("doc").alias("doc"), F.count("*").alias("places"), *[F.max(c).alias(c) for c in PACKED]))
    # Signatures are most of these tables; each is rewritten without them once they have been read.
    members_of = scratch.store(found.drop(*PACKED))
    scratch.discard(found)
    scratch.free()
    posted = classes.select("doc", F.explode(_band_keys()).alias("key"))
    # Nearly all keys stand alone: counting them in an aggregate would hold each twice, and join them all again.
    lists = scratch.store(posted.repartition("key").mapInArrow(_shared, "doc long, key long"))
    scratch.free()
    representatives = classes.join(lists.select("doc").distinct(), "doc", "left_semi").select("doc", _signature().alias("signature"))
    representatives = scratch.store(representatives)
    names = scratch.store(classes.select("print", "doc", "places"))
    scratch.discard(classes)
    classes = names
    scratch.free()

    def texts(wanted: DataFrame) -> DataFrame:
        units = members_of.join(wanted, "doc", "left_semi").groupBy("doc_id", "part").agg(F.collect_list(F.struct("doc", "line", "last")).alias("units"))
        rows = docs.join(units, ["doc_id", "part"]).dropDuplicates(["doc_id", "part"]).select("text", "units")
        return rows.mapInArrow(_unit_texts, "doc long, text string")

    joined = components(scratch, links(RULE, scratch, lists, representatives, texts)).withColumnRenamed("node", "doc")
    # What stands in one place and is linked with nothing has no copy.
    named = classes.join(joined, "doc", "left").where("places > 1 or component is not null").select("print", F.coalesce("component", "doc").alias("component"))
    scratch.free()
    members = members_of.select("doc_id", "part", "line", "last", "n_words", "print").join(named.hint("shuffle_hash"), "print").drop("print")
    members = scratch.store(members.distinct())
    # A copy starts after the end of the first unit; a block and its own lines are no copies of each other.
    first = members.groupBy("component").agg(F.min(F.struct("doc_id", "part", "line", (-F.col("last")).alias("last"))).alias("first"))
    later = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("part") != F.col("first.part")) | (F.col("line") > -F.col("first.last"))
    decided = members.join(first, "component").withColumn("removed", later)
    names = decided.groupBy("component").agg(F.min(_place_id("doc_id", "line")).alias("cluster_id"), F.max("removed").alias("several")).where("several")
    return decided.join(names, "component").select(
        "doc_id", F.when(F.col("last") > F.col("line"), "block").otherwise("paragraph").alias("unit"), F.col("line").alias("position"),
        "n_words", "cluster_id", F.col("first.doc_id").alias("first_doc_id"), "removed")


def passage_clusters(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, unit, position (word), n_words, cluster_id, first_doc_id, removed of repeated passages.

    A row is a longest run of windows with one first holder and one decision.
    """
    blocks = scratch.store(docs.mapInArrow(_blocks, "doc_id long, part long, anchor long, start int, count int, key long"))
    shared = blocks.groupBy("anchor").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).where("n > 1")
    shared = shared.select("anchor", (F.col("low") == F.col("high")).alias("equal"))
    named = scratch.store(blocks.join(shared.hint("shuffle_hash"), "anchor").drop("anchor"))
    scratch.discard(blocks)
    scratch.free()
    place = F.struct("doc_id", "part", "start")
    several = f"first.doc_id != last.doc_id or first.part != last.part or last.start >= first.start + {WINDOW}"
    # Blocks with one key are equal, window by window: what holds at the first place holds at each.
    classes = scratch.store(named.groupBy("key", "count", "equal").agg(F.min(place).alias("first"), F.max(place).alias("last")))
    ranges = classes.where("not equal").groupBy("first.doc_id", "first.part").agg(F.collect_list(F.struct(
        F.col("key").alias("block"), "first.start", "count", F.col("last.doc_id").alias("last_doc"), F.col("last.part").alias("last_part"),
        F.col("last.start").alias("last_start"))).alias("ranges"))
    open_texts = docs.join(ranges, ["doc_id", "part"]).dropDuplicates(["doc_id", "part"])
    windows = scratch.store(open_texts.mapInArrow(
        _single_windows, "block long, offset int, key long, doc_id long, part long, start int, last_doc long, last_part long, last_start int"))
    scratch.free()

    last = F.struct(F.col("last_doc").alias("doc_id"), F.col("last_part").alias("part"), F.col("last_start").alias("start"))
    held = windows.groupBy("key").agg(F.min(place).alias("first"), F.max(last).alias("last")).where(several).select("key", "first")
    # Windows of a block in a row whose first places are in a row too are one piece.
    runs = windows.select("block", "offset", "key").join(held, "key").groupBy(
        "block", F.col("first.doc_id").alias("first_doc_id"), F.col("first.part").alias("first_part"),
        (F.col("first.start") - F.col("offset")).alias("shift")).agg(F.expr("bit_or(shiftleft(1, offset))").alias("mask"))
    runs = runs.withColumn("offset", F.explode(F.expr(
        f"filter(sequence(0, {SPAN - 1}), i -> (shiftright(mask, i) & 1) = 1 and (shiftright(shiftleft(mask, 1), i) & 1) = 0)")))
    runs = runs.withColumn("rest", F.expr("shiftright(mask, offset)"))
    pieces = classes.where("equal").where(several).select(
        "key", F.lit(0).alias("offset"), "count", F.lit(True).alias("whole"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.part").alias("first_part"), F.col("first.start").alias("first_start")).unionByName(runs.select(
            F.col("block").alias("key"), "offset", F.expr("bit_count((~rest & (rest + 1)) - 1)").cast("int").alias("count"), F.lit(False).alias("whole"),
            "first_doc_id", "first_part", (F.col("shift") + F.col("offset")).alias("first_start")))
    pieces = scratch.store(pieces)
    scratch.discard(classes, windows)
    scratch.free()

    hits = named.select("key", "doc_id", "part", "start").join(pieces, "key").withColumn("start", F.col("start") + F.col("offset")).drop("key", "offset")
    elsewhere = (F.col("doc_id") != F.col("first_doc_id")) | (F.col("part") != F.col("first_part"))
    # Overlapping windows of one text (a repeated word) are no copies of each other.
    hits = hits.withColumn("removed", elsewhere | (F.col("start") >= F.col("first_start") + WINDOW)).withColumn(
        "is_first", ~elsewhere & (F.col("start") == F.col("first_start")))
    order = Window.partitionBy("doc_id", "part").orderBy("start")
    before = {c: F.lag(x).over(order) for c, x in (
        ("start", F.col("start")), ("end", F.col("start") + F.col("count")), ("doc", F.col("first_doc_id")), ("part", F.col("first_part")),
        ("shift", F.col("first_start") - F.col("start")), ("removed", F.col("removed")))}
    follows = (before["end"] == F.col("start")) & (before["doc"] == F.col("first_doc_id")) & (before["removed"] == F.col("removed"))
    along = (before["part"] == F.col("first_part")) & (before["shift"] == F.col("first_start") - F.col("start"))
    placed = hits.withColumns({"same": before["start"].eqNullSafe(F.col("start")), "new": ~F.coalesce(follows, F.lit(False)),
                               "along": F.coalesce(along, F.lit(False))})
    # Equal rows of one id are one text.
    placed = placed.where("not same").drop("same")
    placed = placed.withColumn("position", F.max(F.when(F.col("new"), F.col("start"))).over(order)).withColumn(
        "span", F.xxhash64("doc_id", "part", "position"))
    placed = scratch.store(placed.withColumn("asks", (F.col("new") | ~F.col("along")) & ~F.col("is_first")).drop("new", "along"))
    scratch.discard(named, pieces)
    scratch.free()
    # Spans with a window in common are one cluster.  What stands in a row at its first place too is in one span there, so its beginning asks for all.
    first_at = ("first_doc_id", "first_part", "first_start")
    steps = F.sequence(F.lit(0), F.when(F.col("whole"), F.lit(0)).otherwise(F.col("count") - 1))
    holders = placed.where("is_first").select(F.col("span").alias("v"), "first_doc_id", "first_part", F.col("first_start").alias("at"), F.explode(steps).alias("step"))
    holders = holders.select("v", "first_doc_id", "first_part", (F.col("at") + F.col("step")).alias("first_start"))
    edges = placed.where("asks").select(F.col("span").alias("u"), *first_at).join(holders, list(first_at)).where("u != v").select("u", "v").distinct()
    joined = components(scratch, edges).withColumnRenamed("node", "span")
    spans = placed.groupBy("doc_id", "part", "position", "span", "first_doc_id", "removed").agg(
        (F.max(F.col("start") + F.col("count")) - 1 + WINDOW - F.col("position")).cast("long").alias("n_words")).join(joined, "span", "left").withColumn("component", F.coalesce("component", "span"))
    spans = scratch.store(spans)
    names = spans.groupBy("component").agg(F.min(_place_id("doc_id", "position")).alias("cluster_id"))
    return spans.join(names, "component").select(
        "doc_id", F.lit("passage").alias("unit"), F.col("position").cast("long").alias("position"), "n_words", "cluster_id", "first_doc_id", "removed")


def repeated_parts(docs: DataFrame) -> DataFrame:
    """doc_id, unit, position, n_words, cluster_id, first_doc_id, removed: one row per repeated paragraph or passage."""
    scratch = Scratch(docs.sparkSession, "substring")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("part")).where(
        "doc_id is not null and text is not null")
    paragraphs = scratch.store(paragraph_clusters(texts, scratch))
    scratch.drop()
    scratch.free()
    result = scratch.store(paragraphs.unionByName(passage_clusters(texts, scratch)))
    scratch.drop()
    return result


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_parts(table(spark, sf_dir, "documents"))
