"""Block extraction against an HTML parser of another kind, odd markup, odd rows, and layouts that the tree was not trained on."""

import random
from html.parser import HTMLParser

import duckdb
import pytest

from freightlens.llm import block_examples, text_blocks
from freightlens.llm.common import steps, table
from freightlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


class Article(HTMLParser):
    """The text blocks inside article elements."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.run = 0, [], ""
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join(self.run.split())
        self.run = ""
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article", "div"):
            self.flush()
        self.run += " " if tag == "br" else ""
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article", "div"):
            self.flush()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.run += data


def expected(page):
    return "\n".join(Article(page or "").blocks)


def texts(spark, pages):
    df = spark.createDataFrame([(i, f"http://h/{i}", p, "x", 1) for i, p in enumerate(pages)], "page_id long, url string, html string, text string, blocks int")
    return [r.text for r in sorted(text_blocks.main_texts(steps(spark), df).collect(), key=lambda r: r.page_id)]


def test_pages_of_every_size(spark):
    for folder in (FOLDER, "/root/testdata/sf0.1"):
        pages = {r[0]: r for r in duckdb.sql(f"SELECT page_id, url, html FROM '{folder}/pages.parquet'").fetchall()}
        got = QUERIES["op13_text_blocks"](spark, folder).collect()
        assert len(got) == len(pages)
        for r in got:
            assert (r.url, r.text, r.n_chars) == (pages[r.page_id][1], expected(pages[r.page_id][2]), len(r.text))


def blocks(page):
    return [b[0] for b in text_blocks.text_blocks(page)]


@pytest.mark.parametrize(
    "page, found",
    [
        (None, []),
        ("", []),
        (" \n\t", []),
        ("a  b\n c", ["a b c"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("a<b>b</b>c <i>d</i>", ["abc d"]),
        ("a<br>b<br/>c", ["a b c"]),
        ("<script>var t='</p><p>x';</script>y<style>p{}</style>", ["y"]),
        ("x<SCRIPT src=a>1<2</script >y", ["xy"]),
        ("x<script>never ends <p>y", ["x"]),
        ("x<!-- <p>no --> y<!-- open <p>z", ["x y"]),
        ("<!DOCTYPE html><?xml ?>x", ["x"]),
        ("1 < 2 <3 a<b> c", ["1 < 2 <3 a c"]),
        ("&amp;lt; &copy; &eacute;&#233;&#xE9; &amp x &unknown; &#xD800;", ["&lt; © ééé & x &unknown; �"]),
        ("a&nbsp;b", ["a b"]),
        ("<p title=\"a>b\" x='c>d'>e", ["e"]),
        ("<p title=it's>e</p><p>f's", ["e", "f's"]),
        ("<p title=\"open>e", ["e"]),
        ("x<p class=", ["x"]),
        ("<td>a<td>b<tr><li>c<li>d", ["a", "b", "c", "d"]),
        ("<my-tag>a</my-tag>b</p></div>c", ["ab", "c"]),
        ("<div><b>a<div>b</b></div>c</div>", ["a", "b", "c"]),
    ],
)
def test_blocks(page, found):
    assert blocks(page) == found


def test_marks():
    def marks(page):
        return [b[1:] for b in text_blocks.text_blocks(page)]

    assert marks("<a href=x>a b</a> c d") == [(4, 2, 0, 0, 0)]
    assert marks("<p><a>a <p>b</p>") == [(1, 1, 0, 0, 0), (1, 0, 0, 0, 0)]  # a link ends with the paragraph that it begins in
    assert marks("<a><p>a</p></a><p>b") == [(1, 1, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert marks("<article><h1>a</h1><nav>b</nav></article>c") == [(1, 0, 1, 0, 1), (1, 0, -1, 1, 0), (1, 0, -1, 0, 0)]
    assert marks("<div class='post-comments'>a</div><div id=mainContent>b</div>") == [(1, 0, -1, 1, 0), (1, 0, 1, 0, 0)]
    assert marks("<body class=sidebar><div class='content with-sidebar'>a</div>") == [(1, 0, 1, 0, 0)]
    assert marks("<form><main>a</main>b</form>") == [(1, 0, 1, 0, 0), (1, 0, -1, 1, 0)]
    assert marks("<header>a</header><main><header>b</header></main>") == [(1, 0, -1, 1, 0), (1, 0, 1, 0, 0)]
    assert marks("<article class=comment>a</article>") == [(1, 0, 0, 1, 0)]


def test_odd_rows(spark):
    long = "<p>" + " ".join(f"w{n % 97}" for n in range(300_000)) + "</p>"
    deep = "<div>" * 20_000 + "deep word" + "</div>" * 20_000 + "</span></nav>" * 20_000
    pages = [None, "", "<nav><a>x</a></nav>", f"<article>{long}<p>end</p></article><footer>f</footer>", "<article><p>same</article>", "<article><p>same</article>", deep]
    got = texts(spark, pages)
    assert got[:3] == ["", "", ""] and got[4] == got[5] == "same"
    assert got[3] == expected(pages[3]) and len(got[3]) > 900_000
    assert texts(spark, []) == []
    assert table(spark, FOLDER, "pages").limit(0).transform(lambda df: text_blocks.main_texts(steps(spark), df)).count() == 0


def test_parts_by_name(spark):
    """Menus, headers, footers, sidebars, notices, adverts, forms and comments go whatever their length; all of the article stays."""
    prose = lambda n: " ".join(["word"] * n)
    others = [
        f"<header><p>{prose(30)}</p></header>", f"<div class='sidebar-left'><p>{prose(80)}</p></div>", f"<div id='cookieNotice'>{prose(50)}</div>",
        f"<form action=x><label>{prose(4)}</label><p>{prose(40)}</p></form>", f"<section class='comments'><p>{prose(60)}</p><p>{prose(3)}</p></section>",
        f"<aside>{prose(45)}</aside>", f"<div role='navigation'>{prose(25)}</div>", f"<div class='advert'>{prose(33)}</div>", f"<footer>{prose(70)}</footer>",
    ]
    article = f"<article><h1>Title here</h1><p>{prose(3)}</p><p>{prose(90)} <a href=x>link</a></p><p><a href=y>all link</a></p><p>x</p></article>"
    kept = "\n".join(["Title here", prose(3), prose(90) + " link", "all link", "x"])
    pages = ["".join(others[:n]) + article + "".join(others[n:]) for n in range(len(others) + 1)] + [article]
    assert texts(spark, pages) == [kept] * len(pages)


def test_flat_pages_by_length_and_links(spark):
    """Pages without any name: menus of links before and after prose, told apart by counts and densities of blocks and neighbours."""
    r = random.Random(11)
    pages, kept = [], []
    for n in range(60):
        link = lambda: f"<div><a href=x>{' '.join(['menu'] * r.randint(1, 3))}</a></div>"
        body = [" ".join(["text"] * (r.randint(25, 120) if k % 3 else r.randint(6, 30))) for k in range(1, r.randint(4, 9))]
        pages.append("".join(link() for _ in range(r.randint(3, 8))) + "".join(f"<p>{b}</p>" for b in body) + "".join(link() for _ in range(r.randint(2, 6))))
        kept.append(body)
    right = wrong = missed = 0
    for got, body in zip(texts(spark, pages), kept):
        lines = got.split("\n") if got else []
        wrong += sum("menu" in line for line in lines)
        found = sum("text" in line for line in lines)
        right, missed = right + found, missed + len(body) - found
    assert wrong == 0 and missed < 0.05 * (right + missed)


def test_tree_uses_neighbours(spark):
    nodes = text_blocks.trained_tree(steps(spark))
    used = {text_blocks.FEATURES[n.split.featureIndex] for n in nodes if n.leftChild >= 0}
    assert "density" in used and used & {"words_before", "words_after"} and used & {"density_before", "density_after"}
    wrong = sum(min(n.impurityStats) for n in nodes if n.leftChild < 0)
    assert len(block_examples.labelled_pages()) > 50 and wrong <= 0.02 * nodes[0].rawCount
