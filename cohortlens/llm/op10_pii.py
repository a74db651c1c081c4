"""Personal data by patterns, and by contexts bootstrapped from them (DataFrame functions only).

Base entities (e-mail, IP address, card, phone) are found by expressions.  They are
the seeds: the words left of an entity, and its left and right neighbour, are
lexical patterns.  Tokens that look like identifiers (they hold a digit or @) and
are no base entity are the unknown instances.  Patterns and instances form a
bipartite graph that is scored in rounds: a pattern's confidence is the share of
its distinct instances that are known to be of one kind, an instance's score is
1 - prod(1 - confidence) over its confident patterns, and instances above the
threshold count as known in the next round.  Instances found this way are added
with the kind of their patterns; base entities always stay.

Texts are read once and never shuffled; the graph holds digests of texts' tokens.
Hot patterns and tokens are counted with map-side combine, and only the confident
patterns are joined back.

Null texts are empty; rows are told apart by a row number, so repeated ids are
separate results; no entity gives the digest of the empty string.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import Scratch, as_struct, table
from cohortlens.llm.registry import query

#: Fixed values of the contract, in the order of listing; possessive forms of its expressions (same matches, no backtracking).
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A token with a digit or @, read once from its start.
IDENTIFIER = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_MARK, _OTHER = "\uE000", "\uE001"
CONTEXT = 64
ROUNDS = 3
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.6
MIN_SCORE = 0.8

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, value>> of all matches, in code points.

    Matches are put between marks (a mark in the text is swapped for another private
    character first) and the text is cut at the marks: every second piece is a match.
    """
    plain = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, _OTHER)).otherwise(text)
    pieces = F.split(F.regexp_replace(plain, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.array().cast("array<struct<start:int,value:string>>").alias("found"))
    folded = F.aggregate(pieces, start, lambda s, p: F.struct(
        (s["at"] + F.length(p)).alias("at"), (~s["hit"]).alias("hit"),
        F.when(s["hit"], F.concat(s["found"], F.array(F.struct(s["at"].alias("start"), p.alias("value"))))).otherwise(s["found"]).alias("found"),
    ), lambda s: s["found"])
    return folded


def _of_kind(number: int, match: Column) -> Column:
    start, value = match["start"], match["value"]
    return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + F.length(value)).alias("end"), value.alias("value"))


def _valid(kind: str, match: Column) -> Column:
    value = match["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
            F.lpad(F.substring(F.ltrim(p, F.lit("0")), 1, 3), 3, "0").cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base entities, by start, then kind as listed."""
    has_digit = text.rlike("[0-9]")
    guard = {"email": F.contains(text, F.lit("@")), "ip": has_digit, "card": has_digit, "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast(_SPAN)
    found = []
    for number, kind in enumerate(KINDS):
        valid = partial(_valid, kind)
        of_kind = partial(_of_kind, number)
        spans = F.transform(F.filter(matches(text, PATTERNS[kind]), valid), of_kind)
        found.append(F.when(guard[kind], spans.cast(_SPAN)).otherwise(none))
    return F.array_sort(F.concat(*found))


def identifiers(text: Column) -> Column:
    """Tokens with a digit or @, without the punctuation around them, as spans of kind -1."""
    lead, trail = r"^[\"'(<\[{=]+", r"[\"'.,;:!?)>\]}%&$*#|]+$"
    spans = F.transform(matches(text, IDENTIFIER), lambda m: F.struct(
        (m["start"] + F.length(m["value"]) - F.length(F.regexp_replace(m["value"], lead, ""))).alias("start"), F.lit(-1).alias("kind"),
        (m["start"] + F.length(F.regexp_replace(m["value"], trail, ""))).alias("end"),
        F.regexp_replace(F.regexp_replace(m["value"], lead, ""), trail, "").alias("value")))
    return F.when(text.rlike("[0-9@]"), F.filter(spans.cast(_SPAN), lambda s: s["start"] < s["end"])).otherwise(F.array().cast(_SPAN))


def _with_context(text: Column, spans: Column) -> Column:
    left = lambda s: F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
    right = lambda s: F.lower(F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
    before = r"(\S+)\s*$"
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("value"),
        F.regexp_extract(left(s), r"(\S+\s+\S+)\s*$", 1).alias("two"),
        F.concat(F.regexp_extract(left(s), before, 1), F.lit(" _ "), F.regexp_extract(right(s), r"^\S*\s+([^\s.,;:!?]+)", 1)).alias("around")))


def extract(docs: DataFrame, scratch: Scratch, whole: bool = False) -> DataFrame:
    """row, doc_id (or ``doc``, all columns), base (spans), all (these and identifiers that overlap none of them, with contexts).

    Rows are numbered once, by storing the table.
    """
    text, carried = F.coalesce(F.col("text"), F.lit("")), as_struct(docs).alias("doc") if whole else F.col("doc_id")
    found = docs.select(F.monotonically_increasing_id().alias("row"), carried, text.alias("text")).withColumn(
        "base", base_spans(F.col("text"))).withColumn("ids", identifiers(F.col("text")))
    free = F.filter("ids", lambda i: ~F.exists("base", lambda b: (b["start"] < i["end"]) & (i["start"] < b["end"])))
    return scratch.store(found.select("row", "doc" if whole else "doc_id", "base", _with_context(F.col("text"), F.concat("base", free)).alias("all")))


def bootstrap(found: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """row, added (array of start, kind, end): identifiers that confident patterns point to."""
    seen = found.select("row", F.explode("all").alias("s")).select("row", "s.*")
    edges = scratch.store(seen.select(
        "value", "kind", F.explode(F.array(F.concat(F.lit("L "), "two"), F.concat(F.lit("N "), "around"))).alias("pattern")
    ).where("pattern not in ('L ', 'N  _ ')").groupBy(F.xxhash64("pattern").alias("pattern"), "value").agg(F.max("kind").alias("seed")))
    known = edges.withColumn("kind", F.col("seed"))
    scored = None
    for _ in range(rounds):
        counted = known.groupBy("pattern").agg(F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(len(KINDS))])
        best = F.greatest(*[F.struct(F.col(f"k{k}").alias("n"), F.lit(k).alias("kind")) for k in range(len(KINDS))])
        confident = counted.withColumn("best", best).withColumn("confidence", F.col("best.n") / F.col("n")).where(
            (F.col("best.n") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE)).select("pattern", F.col("best.kind").alias("to"), "confidence")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        per_kind = edges.where("seed = -1").join(confident, "pattern").groupBy("value", "to").agg((1 - doubt).alias("score"))
        scored = per_kind.where(F.col("score") >= MIN_SCORE).groupBy("value").agg(
            F.max(F.struct("score", (-F.col("to")).alias("order"))).alias("m")).select("value", (-F.col("m.order")).alias("found"))
        scored = scratch.store(scored)
        known = edges.join(scored, "value", "left").select("pattern", "value", F.coalesce("found", "seed").alias("kind"))
    return seen.where("kind = -1").join(scored, "value").groupBy("row").agg(
        F.collect_list(F.struct("start", F.col("found").alias("kind"), "end")).alias("added"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    scratch = scratch or Scratch(docs.sparkSession, "pii")
    found = extract(docs, scratch)
    out = found.join(bootstrap(found, scratch), "row", "left")
    short = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    every = F.array_sort(F.concat(short, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(every).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; columns stay, n_chars follows the text."""
    scratch = Scratch(docs.sparkSession, "pii")
    found = extract(docs, scratch, whole=True)
    spans = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    joined = found.join(bootstrap(found, scratch), "row", "left").select("doc", F.when(F.size(spans) > 0, spans).alias("spans"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.col("doc.text")
    piece = lambda s, x: F.concat(F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.element_at(names, x["kind"] + 1))
    # A span that begins inside the one before only lengthens it.
    cut = F.aggregate("spans", start, lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when((x["start"] < s["at"]), s["out"]).otherwise(F.concat(s["out"], F.array(piece(s, x)))).alias("out"),
    ), lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    changed = joined.select("doc", F.when(F.col("spans").isNotNull(), cut).alias("cut"))
    out = {"text": F.coalesce("cut", "doc.text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("cut").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    result = scratch.store(changed.select(*[out.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]))
    scratch.drop()
    return result


@query("op10_pii_bootstrap")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
