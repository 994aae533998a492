"""Main text of web pages: flat text blocks, told apart by a decision tree over their own and their neighbours' shallow features.

A page is cut into flat text blocks: the text between two tags of block level, with inline markup taken out. Each block has a word count and
a link density (share of its words inside links). The tree sees both for the block, the one before and the one after it,
and three marks of the block's place: inside the page's main part (article, main or a class or id that says so; -1 for a block
outside it on a page that has one), inside a part that is named as menu, header, footer, sidebar, notice, advert, form or
comments, and heading. It is trained here, by Spark ML, on the blocks of the small labelled pages in block_examples.py; pages
without any such names are decided by counts and densities alone.

Tags, comments and character references follow HTML's own reading: script, style and the like are raw text up to their end tag, an unclosed one
takes the rest; references are decoded once, per run of text; a "<" that opens no tag is text; br is white space. White space of any kind
inside a block becomes one space; blocks without a word are none; blocks of the main text are joined by one line feed.

One pass over the pages without a shuffle; Python cuts a page into blocks, the rest are Spark expressions. Null and empty html give an
empty text, pages without main text too. Rows that repeat a page_id or html are pages of their own. An empty table
gives no rows. A page is held whole by one task. page_id, url and html are read.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.block_examples import labelled_pages
from freightlens.llm.common import in_batches, steps, table
from freightlens.session import Workspace

DEPTH = 8
LEAST = 2  # labelled blocks per leaf

# HTML's elements by kind, and the words in class and id that name a part of a page.
BLOCK = set("""address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre
search section select summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes noscript xmp template svg math object audio video canvas".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = set("article main".split())
OTHER_TAGS = set("nav header footer aside menu dialog select button search".split())
MAIN_WORDS = set("article post entry story content main".split())
OTHER_WORDS = set("""ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
breadcrumbs header masthead topbar footer sidebar sidenav aside widget widgets cookie cookies consent gdpr notice notices notification alert
popup modal overlay newsletter subscribe subscription signup login search form share sharing social comment comments reply replies
respond disqus related recommended pagination pager toolbar copyright legal disclaimer""".split())
UNSAID = set("with has no without".split())  # the word after one of these names no part

TOKEN = re.compile(
    r"""<(?:!--(?:.*?--!?>|.*\Z)                                                      # comment
    |(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)(?:>|\Z)  # tag
    |[!?/][^>]*+(?:>|\Z))                                                            # doctype and the like""",
    re.S | re.X,
)
NAMES = re.compile(r"""(?:^|[\s/"'])(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I) for name in RAW}


def part_of(name: str, attributes: str) -> str:
    """'main', 'other', 'header', 'form' or '' for the part of a page that an element is named as."""
    if name not in ("html", "body") and attributes:
        words = []
        for match in NAMES.finditer(attributes):
            for one in (match[1] or match[2] or match[3] or "").split():
                said = [w.lower() for w in WORDS.findall(one)]
                words += [w for w, before in zip(said, ["", *said]) if before not in UNSAID and w not in UNSAID]
        if name not in MAIN_TAGS or "comment" in words or "comments" in words:
            if OTHER_WORDS.intersection(words):
                return "header" if name in ("header", "hgroup") else "other"
        if MAIN_WORDS.intersection(words) and name not in OTHER_TAGS:
            return "main"
    if name in MAIN_TAGS:
        return "main"
    return name if name in ("header", "form") else "other" if name in OTHER_TAGS else ""


class _Page:
    """Open elements, the link that is open, and the blocks ended so far, as (text, words, linked words, main, other, heading)."""

    def __init__(self):
        self.open: list[tuple[str, bool, bool]] = []  # name, inside main, inside another part
        self.count: Counter = Counter()
        self.link: int | None = None  # how many elements were open when it began
        self.runs: list[str] = []
        self.linked: list[str] = []
        self.blocks: list[tuple] = []

    def end_block(self) -> None:
        if self.runs:
            words = "".join(self.runs).split()
            if words:
                main, other = self.open[-1][1:] if self.open else (False, False)
                heading = any(self.count[h] for h in HEADINGS)
                linked = min(len(words), len("".join(self.linked).split()))
                self.blocks.append((" ".join(words), len(words), linked, main and not other, other, heading))
            self.runs, self.linked = [], []

    def text(self, run: str) -> None:
        run = references.unescape(run) if "&" in run else run
        self.runs.append(run)
        if self.link is not None:
            self.linked.append(run)

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.link = len(self.open)
        elif name == "br":
            self.text(" ")
        if name not in BLOCK or name in VOID:
            if name in BLOCK:
                self.end_block()
            return
        self.end_block()
        while self.open and self.open[-1][0] == "p":  # a block ends a paragraph
            self.close()
        if name in ("li", "dd", "dt", "td", "th", "tr", "option") and self.open and self.open[-1][0] == name:
            self.close()
        main, other = self.open[-1][1:] if self.open else (False, False)
        part = part_of(name, attributes)
        if part == "main":
            main, other = True, other and not self.count["form"]  # a form around the whole page is no part of it
        elif part in ("other", "form") or part == "header" and not main:
            other = True
        self.open.append((name, main, other))
        self.count[name] += 1

    def close(self) -> None:
        self.count[self.open.pop()[0]] -= 1
        if self.link is not None and len(self.open) < self.link:
            self.link = None

    def end(self, name: str) -> None:
        if name == "a":
            self.link = None
        elif name in BLOCK:
            self.end_block()
            if self.count[name]:
                while self.open[-1][0] != name:
                    self.close()
                self.close()


def text_blocks(page: str | None) -> list[tuple]:
    """(text, words, linked words, main 1, 0 or -1, other 0 or 1, heading 0 or 1) per flat text block of a page."""
    state, at = _Page(), 0
    page = page or ""
    while match := TOKEN.search(page, at):
        if match.start() > at:
            state.text(page[at : match.start()])
        at = match.end()
        if match[2]:
            name = match[2].lower()
            if match[1]:
                state.end(name)
            elif name in RAW and not match[3].endswith("/"):
                if name in BLOCK:
                    state.end_block()
                end = ENDS[name].search(page, at)
                at = end.end() if end else len(page)
            else:
                state.start(name, match[3])
    state.text(page[at:])
    state.end_block()
    split = any(b[3] for b in state.blocks)
    return [(t, n, k, 1 if main else -1 if split else 0, int(other), int(heading)) for t, n, k, main, other, heading in state.blocks]


BLOCKS = "array<struct<text: string, words: int, linked: int, main: int, other: int, heading: int>>"
FEATURES = "words density words_before density_before words_after density_after main other heading".split()


def with_blocks(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as (page_id, url, blocks)."""
    fields = [("text", pa.string()), *[(f, pa.int32()) for f in ("words", "linked", "main", "other", "heading")]]
    kind = pa.list_(pa.struct(fields))
    names = [f for f, _ in fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = pa.array([[dict(zip(names, b)) for b in text_blocks(page)] for page in batch.column("html").to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), blocks], names=["page_id", "url", "blocks"])

    page_id, url = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return in_batches(pages.select("page_id", "url", "html"), cut, f"page_id {page_id}, url {url}, blocks {BLOCKS}")


def features(block: Column, nr: Column, blocks: Column) -> list[Column]:
    """The features in the order of FEATURES; 0 for the neighbours that a page's first and last block lack."""

    def own(b: Column) -> list[Column]:
        words = F.coalesce(b["words"], F.lit(0)).cast("double")
        return [words, F.coalesce(b["linked"] / b["words"], F.lit(0.0))]

    place = [block[f].cast("double") for f in ("main", "other", "heading")]
    return [*own(block), *own(F.get(blocks, nr - 1)), *own(F.get(blocks, nr + 1)), *place]


def trained_tree(ws: Workspace, depth: int = DEPTH, least: int = LEAST) -> list:
    """Nodes of the tree learned from the labelled pages, by id; a few dozen rows, as the labelled pages are fixed."""
    marked = ws.spark.createDataFrame(enumerate(labelled_pages()), "page_id int, html string").withColumn("url", F.lit(""))
    rows = with_blocks(marked).select("blocks", F.posexplode("blocks").alias("nr", "block"))
    rows = rows.select(
        array_to_vector(F.array(*features(F.col("block"), F.col("nr"), F.col("blocks")))).alias("features"),
        F.col("block")["text"].startswith("main").cast("double").alias("label"),
    )
    path = ws.path(ws.fresh("tree"))
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=least, maxBins=64, seed=1).fit(ws.write(rows, ws.fresh("labelled")))
    model.save(path)
    return ws.spark.read.parquet(f"{path}/data").orderBy("id").collect()


def decision(nodes: list, values: list[Column], at: int = 0) -> Column:
    """The tree as nested conditions on the features."""
    node = nodes[at]
    if node.leftChild < 0:
        return F.lit(node.prediction > 0.5)
    left, right = decision(nodes, values, node.leftChild), decision(nodes, values, node.rightChild)
    return F.when(values[node.split.featureIndex] <= node.split.leftCategoriesOrThreshold[0], left).otherwise(right)


def main_texts(ws: Workspace, pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of pages (page_id, url, html)."""
    nodes = trained_tree(ws)
    blocks = F.col("blocks")
    kept = F.filter(blocks, lambda block, nr: decision(nodes, features(block, nr, blocks)))
    return with_blocks(pages).select("page_id", "url", F.array_join(F.transform(kept, lambda block: block["text"]), "\n").alias("text"))


def op13_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = steps(spark)
    texts = main_texts(ws, table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
