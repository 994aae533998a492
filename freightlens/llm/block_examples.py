"""Labelled pages for the block classifier: page layouts with the length of every text, and which texts are main text.

{12} stands for twelve plain words of other text, {12+} for twelve of main text, {3@} for a link of three words of other text, {3@+} of main text. The
words themselves carry no information, only their number; a main text begins with the word "main". Every layout occurs once per scale of its lengths.
"""

from __future__ import annotations

import re

# Layouts, more than half of them without any name that gives a part away.
LAYOUTS = """
<nav><ul><li>{1@}</li><li>{1@}</li><li>{2@}</li></ul></nav><div class="ad">{7}</div><article><h1>{9+}</h1><p>{60+}</p><p>{4+}</p><p>{1+}</p><p>{110+}</p></article><footer>{12}</footer>
<nav>{1@}</nav><div class="banner">{14}</div><article><h1>{5+}</h1><p>{1+}</p></article><footer>{5}</footer>
<header>{4}<p>{18}</p></header><main><h1>{6+}</h1><p>{2+}</p><p>{30+}</p><ul><li>{3+}</li><li>{2@+}</li></ul></main><aside><p>{25}</p><p>{3@}</p></aside><footer><p>{40}</p></footer>
<div class="cookie-notice">{35}</div><div id="menu">{2@}{2@}{1@}</div><div class="post-content"><h2>{7+}</h2><p>{80+}</p><p>{12+}</p><p>{5+} {4@+}</p></div><div class="sidebar"><p>{45}</p>{3@}</div><div id="comments"><p>{28}</p><p>{50}</p></div><div class="footer">{10}</div>
<header>{3@}{1@}</header><article><header><h1>{8+}</h1></header><p>{15+}</p><p>{55+}</p><form>{4}<p>{9}</p></form><p>{6+}</p><aside>{30}</aside><p>{20+}</p></article><section class="comments"><article class="comment"><p>{33}</p></article><article class="comment"><p>{6}</p></article></section>
<div>{20}</div><main><p>{14+}</p><p>{3+}</p></main><div>{35}</div><p>{6}</p>
<p>{11}</p><article><p>{25+}</p><p>{1@+}</p><p>{10+}</p></article><div><p>{50}</p></div>
<form><div class="nav">{2@}{1@}</div><div id="content"><h1>{6+}</h1><p>{70+}</p><p>{2+}</p></div></form><div class="newsletter">{16}</div>
<div class="promo"><p>{22}</p></div><div class="entry"><p>{40+}</p><p>{40+}</p></div><div class="related"><p>{9@}</p><p>{11@}</p></div>
<div class="modal"><p>{65}</p></div><p>{45+}</p><p>{38+}</p><div class="legal"><p>{90}</p></div>
<div><div>{1@}</div><div>{1@}</div><div>{1@}</div></div><div><h1>{6+}</h1><p>{45+}</p><p>{70+}</p><p>{8+}</p><p>{52+}</p></div><div><p>{4}</p></div>
<table><tr><td>{1@}</td><td>{2@}</td><td>{1@}</td></tr></table><div><h2>{5+}</h2><div>{120+}</div><div>{3+}</div><div>{33+}</div></div><div>{2@}</div><div>{3@}</div><div>{6}</div>
<div>{3}</div><div>{1@}</div><div>{2@}</div><p>{28+}</p><p>{31+} {2@+} {10+}</p><p>{48+}</p><div>{6@}</div><div>{8@}</div><div>{7@}</div><div>{5}</div>
<div>{2@}</div><div>{2@}</div><h1>{10+}</h1><div>{26+}</div><div>{90+} {3@+}</div><div>{18+}</div><div>{41+}</div><p>{2@} {2@} {2@}</p><p>{8}</p>
<ul><li>{1@}</li><li>{1@}</li><li>{3@}</li><li>{2@}</li></ul><p>{150+}</p><p>{1+}</p><p>{64+}</p><p>{22+}</p><ul><li>{4@}</li><li>{5@}</li></ul><p>{7}</p>
<p>{4}</p><p>{2} {3@}</p><p>{3@}</p><h2>{4+}</h2><p>{36+}</p><p>{27+}</p><p>{1} {2@}</p><p>{3}</p><p>{2@}</p>
<div>{5@} {2}</div><div>{4@} {3}</div><div>{6@}</div><div>{33+} {1@+} {30+}</div><div>{57+}</div><div>{19+}</div><div>{3@} {1}</div><div>{4@}</div>
<div>{1@}</div><div>{2@}</div><h1>{7+}</h1><p>{24+}</p><p>{2+}</p><p>{9+}</p><p>{38+}</p><p>{13+}</p><p>{30+}</p><div>{3@}</div><div>{4}</div>
<div>{3@}</div><div>{9}</div><div>{2@}</div><h1>{6+}</h1><p>{16+}</p><p>{6+}</p><p>{40+}</p><p>{4+}</p><p>{21+}</p><p>{2@}</p><p>{3@}</p><div>{7}</div>
<p>{2@}</p><p>{1@}</p><p>{12+}</p><p>{60+}</p><p>{10+}</p><p>{7+}</p><p>{44+}</p><p>{5}</p><p>{4@}</p><p>{4@}</p>
<div>{5}</div><div>{1@}</div><div>{1@}</div><div>{1@}</div><div>{50+}</div><div>{5+}</div><div>{5+}</div><div>{58+}</div><div>{2@}</div><div>{9}</div><div>{2@}</div>
<ul><li>{2@}</li><li>{2@}</li></ul><div>{6}</div><ul><li>{3@}</li></ul><h1>{8+}</h1><div>{32+}</div><h2>{3+}</h2><div>{47+}</div><h2>{4+}</h2><div>{9+}</div><div>{36+}</div><h3>{2}</h3><ul><li>{6@}</li><li>{7@}</li><li>{5@}</li></ul>
<p>{3@}</p><p>{14} {6@}</p><p>{3@}</p><p>{66+}</p><p>{11+} {2@+} {9+}</p><p>{23+} {1@+}</p><p>{10} {8@}</p><p>{5@}</p><p>{6}</p>
<p>{1@} {1@} {1@} {1@}</p><h1>{5+}</h1><p>{3+}</p><p>{85+}</p><p>{3+}</p><p>{95+}</p><p>{1@} {1@}</p><p>{9}</p>
<td>{2@}</td><td>{11}</td><td>{2@}</td><td>{5}</td><td>{2@}</td><h2>{5+}</h2><p>{29+}</p><p>{18+}</p><p>{33+}</p><td>{2@}</td><td>{8}</td><td>{2@}</td>
<nav>{1@}</nav><article><h1>{4+}</h1><p>{50+}</p><p>{3+}</p></article>
<nav><p>{20}</p><p>{30}</p></nav><main><p>{1+}</p></main>
<article><p>{3@+}</p><p>{2@+}</p><p>{30+}</p><ul><li>{1@+}</li><li>{2@+}</li></ul><p>{7+}</p></article>
<article><h1>{5+}</h1><p>{2+}</p><p>{2@+}</p><p>{4+}</p></article><footer>{3@}{2}</footer>
<div class="sidebar"><p>{30}</p><p>{60}</p><p>{12}</p></div><p>{50+}</p><p>{70+}</p><div class="footer"><p>{80}</p><p>{40}</p></div>
<form><p>{26}</p><p>{48}</p></form><div class="notice"><p>{33}</p></div><div class="ad"><p>{27}</p><p>{52}</p></div><p>{61+}</p><p>{34+}</p>
<footer><p>{70}</p><p>{30}</p></footer>
<article><p>{12+}</p><p>{20+} {2@+} {9+}</p><p>{2@+}</p><p>{5+} {1@+}</p></article>
<main><p>{6+}</p><p>{3+} {4@+}</p><p>{3+}</p></main>
<article><h1>{3+}</h1><p>{2@+} {4+}</p></article><p>{9@}</p>
<article><p>{40+} {6@+}</p><p>{22+}</p></article><p>{14}</p>
<p>{75+}</p><p>{44+}</p>
<p>{30+}</p>
<p>{1@}</p><p>{1@}</p><p>{2}</p><p>{1@}</p>
"""


SCALES = (1.0, 0.6, 1.7)


def _page(layout: str, scale: float) -> str:
    def words(match: re.Match) -> str:
        text = " ".join(["main" if "+" in match[2] else "other"] * max(1, round(int(match[1]) * scale)))
        return f'<a href="#">{text}</a>' if "@" in match[2] else text

    return re.sub(r"\{(\d+)([@+]*)\}", words, layout)


def labelled_pages() -> list[str]:
    return [_page(layout, scale) for scale in SCALES for layout in LAYOUTS.strip().split("\n")]
