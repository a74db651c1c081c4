"""Main text of web pages from flat text blocks.

A page is cut into a flat list of text blocks, at every tag that starts or ends a block
(:func:`text_blocks`).  A block's features are its words and link density, those of the
block before and after it, and where it stands (:data:`FEATURES`).  A decision tree,
trained on the small labelled table of :data:`op13_labelled.PAGES`, tells main text from
the rest.  The tree becomes a column expression, so after the blocks have been read,
classifying and joining them needs neither Python nor a shuffle: a page stays one row.

A null or empty page has an empty text; broken pages are read as far as they go (unclosed
and stray tags, references without a semicolon, an unfinished tag or script at the
end); very long pages are one value of a row and read once from left to right; equal
rows stay; ``page_id`` and ``url`` may be null; other columns are not read; an empty
table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.base import CHUNK, table
from cohortlens.llm.op13_labelled import PAGES
from cohortlens.llm.registry import query

#: What the tree sees of a block.  ``region``: 0 page furniture, 1 outside the article of a page that has one, 2 a page
#: without an article element, 3 in the article; the last three are 0 or 1.
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "region", "header", "form", "heading")
MAX_DEPTH = 8
#: Blocks of the labelled table behind a decision.
LEAST = 3

CHROME, HEADER, ARTICLE, FORM = 1, 2, 4, 8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z0-9]+")

#: Elements whose content is no text of the page.
_SKIPPED = {x: re.compile(rf"</{x}\b[^>]*(?:>|\Z)", re.I) for x in (
    "script", "style", "title", "textarea", "noscript", "template", "svg", "math", "iframe", "object", "select", "canvas", "audio", "video")}
_TO_THE_END = {"script", "style", "title", "textarea"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = _HEADINGS | set(
    "p li blockquote pre td th dd dt figcaption html head body div section article main aside nav header footer form fieldset legend address center details summary dialog menu "
    "ul ol dl table caption thead tbody tfoot tr figure hr button label option search hgroup".split())
#: An element that ends where another of its kind starts, and what it cannot reach beyond.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_ELEMENT_FLAGS = {
    **dict.fromkeys("nav footer aside menu dialog head search".split(), CHROME), **dict.fromkeys("form fieldset".split(), FORM),
    **dict.fromkeys("button label option".split(), CHROME | FORM), "header": HEADER, "article": ARTICLE, "main": ARTICLE}
#: Words of class, id and role that name page furniture.
_CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login signin share sharing social sidebar widget widgets related recommended "
    "breadcrumb breadcrumbs menu nav navbar navigation toolbar footer copyright comment comments disqus reply replies respond pagination pager "
    "skip search contentinfo complementary alert dialog tags byline-tools".split())
_COMMENT_NAMES = {"comment", "comments", "comment-body", "comment-list", "commentlist", "reply", "replies"}
_HEADER_WORDS = {"header", "masthead", "topbar"}


def _own_flags(name: str, attributes: str) -> int:
    flags = _ELEMENT_FLAGS.get(name, 0)
    if not attributes or name in ("html", "body"):
        return flags
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            flags |= CHROME
        elif key == "role" and value == "main" or key == "itemprop" and value == "articlebody":
            flags |= ARTICLE
        elif key in ("class", "id", "role"):
            if name in ("article", "main"):
                flags |= CHROME if _COMMENT_NAMES & set(value.split()) else 0
                continue
            words = set(_NAME.findall(value))
            flags |= (CHROME if words & _CHROME_WORDS else 0) | (HEADER if words & _HEADER_WORDS else 0)
    return flags


class _Reader:
    """Collects the text blocks of one page."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, int, bool]] = []
        self.open: list[tuple[str, int]] = []
        self.pieces: list[str] = []
        self.link_pieces: list[str] = []
        self.link: int | None = None

    def text(self, raw: str) -> None:
        piece = unescape(raw) if "&" in raw else raw
        self.pieces.append(piece)
        if self.link is not None:
            self.link_pieces.append(piece)

    def flush(self) -> None:
        """End the block."""
        if self.pieces:
            words = "".join(self.pieces).split()
            if words:
                name, flags = self.open[-1] if self.open else ("", 0)
                linked = len("".join(self.link_pieces).split())
                self.blocks.append((" ".join(words), len(words), min(linked, len(words)), flags, name in _HEADINGS))
        self.pieces, self.link_pieces = [], []

    def shrink(self, size: int) -> None:
        del self.open[size:]
        if self.link is not None and self.link > size:
            self.link = None

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.link = len(self.open) if "href" in attributes.lower() else None
            self.link_pieces.append(" ")
        elif name == "br":
            self.text(" ")
        if name not in _BLOCKS:
            return
        self.flush()
        if self.open and self.open[-1][0] == "p":
            self.shrink(len(self.open) - 1)
        ends, bounds = _CLOSES.get(name, ((), ()))
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in bounds or not ends:
                break
            if self.open[at][0] in ends:
                self.shrink(at)
        if name in _VOID:
            return
        own, outer = _own_flags(name, attributes), self.open[-1][1] if self.open else 0
        if own & FORM and outer & ARTICLE:  # a form inside an article; one around it says nothing
            own |= CHROME
        self.open.append((name, (outer & ~FORM if own & ARTICLE else outer) | own))

    def end(self, name: str) -> None:
        if name == "a":
            self.link = None
        if name not in _BLOCKS:
            return
        self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == name:
                self.shrink(at)
                break


def text_blocks(html: str) -> list[tuple[str, list[float]]]:
    """(text, features) of the page's blocks in page order."""
    reader, at = _Reader(), 0
    while (m := _TOKEN.search(html, at)) is not None:
        if m.start() > at:
            reader.text(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                reader.text(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = m[2].lower()
        if m[1]:
            reader.end(name)
            continue
        if name in _SKIPPED and not m[3].endswith("/"):
            end = _SKIPPED[name].search(html, at)
            if end is not None or name in _TO_THE_END:
                at = len(html) if end is None else end.end()
                continue
        reader.start(name, m[3])
    reader.text(html[at:])
    reader.flush()
    found = reader.blocks
    has_article = any(flags & ARTICLE and not flags & CHROME for _, _, _, flags, _ in found)
    size = [(float(n), linked / n) for _, n, linked, _, _ in found]
    out = []
    for i, (text, _, _, flags, heading) in enumerate(found):
        before, after = size[i - 1] if i else (0.0, 0.0), size[i + 1] if i + 1 < len(size) else (0.0, 0.0)
        region = 0 if flags & CHROME else 3 if flags & ARTICLE else 1 if has_article else 2
        out.append((text, [*size[i], *before, *after, *map(float, (region, bool(flags & HEADER), bool(flags & FORM), heading))]))
    return out


# --- the tree ---------------------------------------------------------------------

def labelled_blocks(pages: list[str] | None = None) -> list[tuple[float, list[float]]]:
    """(label, features) of the labelled pages: a block's text starts with + (main text) or - (the rest)."""
    found = [b for page in (PAGES if pages is None else pages) for b in text_blocks(page)]
    return [({"+": 1.0, "-": 0.0}[text[0]], features) for text, features in found]


def train(spark: SparkSession, pages: list[str] | None = None) -> DecisionTreeClassificationModel:
    """The decision tree over the labelled table (a fixed, small number of rows)."""
    rows = spark.createDataFrame([(label, Vectors.dense(f)) for label, f in labelled_blocks(pages)], ["label", "features"]).coalesce(1)
    return DecisionTreeClassifier(maxDepth=MAX_DEPTH, minInstancesPerNode=LEAST, seed=1).fit(rows)


def as_column(model: DecisionTreeClassificationModel, features: Column) -> Column:
    """The tree's decision (main text or not) as an expression over an array of features."""
    def rule(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        left, right = rule(node.leftChild()), rule(node.rightChild())
        return F.when(F.get(features, F.lit(split.featureIndex())) <= F.lit(split.threshold()), left).otherwise(right)

    return rule(model._java_obj.rootNode())


# --- extraction ------------------------------------------------------------------------

_BLOCKS_TYPE = pa.list_(pa.struct([("text", pa.string()), ("features", pa.list_(pa.float64()))]))
_SCHEMA = "page_id long, url string, blocks array<struct<text: string, features: array<double>>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, first, size = [], 0, 0
        for i in range(len(batch)):
            html = batch.column("html")[i].as_py() or ""
            blocks.append([{"text": t, "features": f} for t, f in text_blocks(html)])
            size += len(html)
            if size > CHUNK or i + 1 == len(batch):
                part = batch.slice(first, i + 1 - first)
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "blocks": pa.array(blocks, _BLOCKS_TYPE)})
                blocks, first, size = [], i + 1, 0


def extract(pages: DataFrame, model: DecisionTreeClassificationModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or train(pages.sparkSession)
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_read, _SCHEMA)
    main = F.filter("blocks", lambda b: as_column(model, b["features"]))
    text = F.array_join(F.transform(main, lambda b: b["text"]), "\n\n")
    return read.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
