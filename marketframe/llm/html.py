"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read into flat blocks of text, cut at block-level tags.  A block is described by its number of words and its
link density, those of the blocks before and after it, and what its enclosing tags say (article, navigation, class
and id names).  A decision tree, grown from a small labelled table, tells main text from the rest.

The labelled table is ``training_pages``: invented pages of several layouts in which every block is marked.  Growing
takes a fraction of a second on the driver, and tasks get the finished tree.  A page is one row and needs no other
row, so there is no shuffle.

Defined results: a null or empty page, and one without main text, has an empty text; unclosed tags end with their
parent; scripts, styles, templates, comments, form fields, frames, drawings (svg, canvas) and the fallbacks of noscript, audio
and video are never text; formulas and the fallback of an object are; equal rows give equal rows; an empty table gives
an empty result; other columns are not looked at.
"""

import re
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

#: ``annotation`` holds the source of a formula that is there already.
SKIPPED = frozenset(
    "script style noscript template svg iframe select option textarea button head title canvas audio video annotation annotation-xml".split()
)
#: Formulas are inline text with a space before each element, so that the parts of a fraction are no number.
MATH = frozenset(
    "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
INLINE = MATH | frozenset(
    "a abbr acronym annotation annotation-xml b bdi bdo big br cite code data del dfn em font i img ins kbd label mark object param q s "
    "samp small span strike strong sub sup time tt u var wbr input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A tag that opens ends these, if they are open and nothing of the second list lies between.
IMPLIED_END = {
    "p": (frozenset(["p"]), frozenset("div article section td th li blockquote button".split())),
    "li": (frozenset(["p", "li"]), frozenset(["ul", "ol"])),
    "dt": (frozenset(["p", "dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["p", "dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["p", "tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["p", "td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["p", "td", "th"]), frozenset(["table", "tr"])),
}
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol pre section table ul".split()
)
BOILER_NAMES = re.compile(
    r"(?<!\bhas)(?<!\bwith)(?<!\bno)(^|[\s_-])(ads?|adbox|adsense|adslot|advert\w*|alert|banner\w*|breadcrumbs?|comment\w*|consent|cookie\w*|"
    r"copyright|disqus|footer\w*|form|gdpr|header|legal|login|masthead|menu\w*|modal|nav\w*|newsletter\w*|notice\w*|notification\w*|"
    r"pagination|popup|promo\w*|recommend\w*|related|repl(y|ies)|respond|search|share|sharing|side-?bar\w*|signup|social\w*|sponsor\w*|"
    r"subscribe|subscription|tags|teaser|toolbar|top-?bar|tracking|trending|widget\w*|discussion)($|[\s_-])",
    re.IGNORECASE,
)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
MAIN_NAMES = re.compile(r"(^|[\s_-])(article|body|content|entry|main|post|story|text)($|[\s_-])", re.IGNORECASE)
ROLES = {"navigation": 1, "banner": 1, "contentinfo": 1, "complementary": 1, "search": 1, "form": 1, "dialog": 1, "alert": 1, "main": 2, "article": 2}


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    boiler: int
    main: int
    heading: int
    listed: int
    mark: str | None


#: A comment, a tag with its attributes, or a declaration.  Attribute values longer than 4,096 characters, and quotes
#: that never end, are left to the second form of a tag: it takes all up to the next ``>``.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]{0,4096}+"|'[^']{0,4096}+')*+)>
    |<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>
    |<[!?][^>]*+>""",
    re.DOTALL | re.VERBOSE,
)
#: An attribute, read in order, so that nothing inside a value counts as a name.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in ("script", "style", "textarea", "title", "iframe", "noscript")}


def attributes_of(written: str) -> dict[str, str]:
    """Attributes by lower-cased name; of a repeated name the first counts, one without a value is empty."""
    given: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(written):
        given.setdefault(name.lower(), double or single or bare)
    return given


class Flattener:
    """Collects the blocks of a page, in time proportional to its length.

    An open tag is ``(name, boiler, main, skipped)``: whether it, or a tag around it, is navigation and the like, main
    text, or not text at all.  Tags of an article start afresh: a header inside an article is part of it.  ``places``
    has the positions of each name among the open tags, so that no tag is looked for by walking through them.
    """

    def __init__(self):
        self.open, self.blocks, self.text, self.links, self.mark = [("", 0, 0, 0)], [], [], 0, None
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]
        self.headings = 0

    def read(self, html: str) -> list[Block]:
        at, last = 0, html.rfind(">") + 1  # behind the last ``>`` there is no tag
        while token := TOKEN.search(html, at, last):
            if token.start() > at:
                self.data(html[at : token.start()])
            at = token.end()
            closing, tag, attributes = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
            if not tag:
                if token[0].startswith("<!--") and not token[0].endswith("-->"):
                    at = len(html)  # a comment that never ends
                continue
            tag = tag.lower()
            if closing:
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in RAW:
                end = RAW[tag].search(html, at)
                at = end.start() if end else len(html)
        if at < len(html):
            self.data(html[at:])
        self.flush()
        return self.blocks

    def start(self, tag, attributes):
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES_P:
                self._end_implied(*IMPLIED_END["p"])
        if tag in IMPLIED_END:
            self._end_implied(*IMPLIED_END[tag])
        if tag == "br" or tag in MATH:
            self.text.append(" ")
        if tag in VOID:
            return
        _, boiler, main, skipped = self.open[-1]
        given = attributes_of(attributes) if attributes else {}
        role = ROLES.get(given.get("role"), 0)
        if tag in ("article", "main") or role == 2:
            boiler, main = boiler if tag == "article" and boiler == 2 else 0, 1
        if tag in BOILER_TAGS or role == 1 or tag == "header" and not main or "hidden" in given:
            boiler = max(boiler, 1)
        if given and tag not in ("html", "body") and (names := f"{given.get('class', '')} {given.get('id', '')}".strip()):
            names = CAMEL.sub("-", names)
            named = bool(MAIN_NAMES.search(names))
            if BOILER_NAMES.search(names) and not (named and (tag in ("article", "main") or "wrap" in names)):
                boiler = 2
            elif named and tag not in INLINE:
                main = 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.block_places.append(len(self.open))
            self.headings += tag in HEADINGS
        self.open.append((tag, boiler, main, int(skipped or tag in SKIPPED)))
        if "data-mark" in given:
            self.mark = given["data-mark"]

    def _last(self, tag) -> int:
        """The innermost open tag of a name; 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def end(self, tag):
        inline = tag in INLINE
        if not inline:
            self.flush()
        # an inline tag doesn't end a block
        if (place := self._last(tag)) and not (inline and place < self.block_places[-1]):
            self._cut(place)

    def _cut(self, place):
        while len(self.open) > place:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.block_places.pop()
                self.headings -= tag in HEADINGS

    def _end_implied(self, ended, borders):
        place = max(map(self._last, ended))
        if place and place > max(map(self._last, borders)):
            self._cut(place)

    def data(self, data):
        if not self.open[-1][3]:
            data = unescape(data) if "&" in data else data
            self.text.append(data)
            if self.places.get("a"):
                self.links += len(data.split())

    def flush(self):
        text = " ".join("".join(self.text).split()) if self.text else ""
        if text:
            _, boiler, main, _ = self.open[-1]
            words = text.count(" ") + 1
            heading, listed = int(self.headings > 0), int(bool(self.places.get("li")))
            self.blocks.append(Block(text, words, min(self.links, words), boiler, main, heading, listed, self.mark))
        self.text, self.links, self.mark = [], 0, None


def blocks_of(html: str | None) -> list[Block]:
    return Flattener().read(html or "")


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "boiler", "main", "heading", "listed", "page_has_main",
)


def features(blocks: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` per block."""
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked / b.words for b in blocks], float)
    before = lambda x: np.r_[0.0, x[:-1]]
    after = lambda x: np.r_[x[1:], 0.0]
    flags = np.array([(b.boiler, b.main, b.heading, b.listed) for b in blocks], float).reshape(-1, 4)
    main = np.full(len(blocks), float(any(b.main for b in blocks)))
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), flags, main])


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 10, least: int = 2):
    """A decision tree by Gini impurity: a share of positive labels, or ``(feature, threshold, lower, upper)``."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0) or len(labels) < 2 * least:
        return share
    best = None
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values, positive = rows[order, feature], labels[order].cumsum()
        left = np.arange(1, len(labels))
        cuts = (values[1:] > values[:-1]) & (left >= least) & (len(labels) - left >= least)
        p, q = positive[:-1] / left, (positive[-1] - positive[:-1]) / (len(labels) - left)
        impurity = np.where(cuts, left * p * (1 - p) + (len(labels) - left) * q * (1 - q), np.inf)
        i = int(impurity.argmin())
        if cuts[i] and (best is None or impurity[i] < best[0] - 1e-12):
            best = (impurity[i], feature, (values[i] + values[i + 1]) / 2)
    if best is None:
        return share
    _, feature, threshold = best
    low = rows[:, feature] <= threshold
    return feature, threshold, grow_tree(rows[low], labels[low], depth - 1, least), grow_tree(rows[~low], labels[~low], depth - 1, least)


def classify(tree, rows: np.ndarray) -> np.ndarray:
    """The tree's share of positive labels for each row."""
    if isinstance(tree, float):
        return np.full(len(rows), tree)
    feature, threshold, lower, upper = tree
    low = rows[:, feature] <= threshold
    out = np.empty(len(rows))
    out[low], out[~low] = classify(lower, rows[low]), classify(upper, rows[~low])
    return out


# Layouts of the labelled pages.  {m...} stands for main text of so many words, {b...} for other text, {l...} for links.
LAYOUTS = (
    "<nav><ul><li>{l1}<li>{l2}<li>{l1}</ul></nav><div class='ad'>{b9}</div><article><h1>{m6}</h1><p>{m40}</p><p>{m2}</p><p>{m90}</article><footer>{b7}</footer>",
    "<header>{b3}<nav>{l4}</nav></header><main><h1>{m8}</h1><p>{m60}</p><div class='ad-box'>{b25}</div><p>{m1}</p><ul><li>{m7}<li>{m12}</ul></main><aside>{b30}{l5}</aside><footer>{l6}{b5}</footer>",
    "<div id='header'>{b4}</div><div class='menu'>{l3}{l3}</div><div id='content'><h2>{m5}</h2><p>{m30}</p><p>{m4}</p><p>{m70}</p></div><div class='sidebar'><p>{b40}</p>{l8}</div><div id='footer'>{b12}</div>",
    "<div class='cookie-notice'><p>{b35}</p></div><article><header><h1>{m7}</h1></header><p>{m25}</p><p>{m3}</p><blockquote>{m15}</blockquote></article><section class='comments'><h3>{b2}</h3><p>{b50}</p><p>{b8}</p></section>",
    "<h1>{m6}</h1><p>{m45}</p><p>{m20}</p><p>{m3}</p><p>{m80}</p><ul><li>{l2}<li>{l3}<li>{l2}</ul><form>{b6}<label>{b2}</label></form><footer>{b9}</footer>",
    "<p>{l2}</p><p>{l1}</p><p>{m50}</p><p>{m35}</p><p>{m6}</p><p>{m55}</p><p>{l3}</p><p>{l2}</p>",
    "<article><h1>{m4}</h1><p>{m1}</p><p>{m2}</p><form class='newsletter'><p>{b14}</p></form><p>{m3}</p><table><tr><td>{m4}<td>{m2}</table><div class='share'>{l3}</div></article><div id='comments'><article><p>{b30}</p></article></div><footer>{b20}</footer>",
    "<div role='banner'>{b5}</div><div role='main'><p>{m12}</p><p>{m28}</p><aside>{b18}</aside><p>{m9}</p></div><div role='complementary'>{b22}</div><div class='related'><h3>{b2}</h3>{l7}{l5}</div>",
    "<nav>{l2}{l2}</nav><article><h2>{m3}</h2><p>{m18}{q5}</p><p>{m65}{q3}</p></article><div class='promo'><p>{b60}</p></div><div class='widget'>{b3}</div><footer><p>{b45}</p>{l3}</footer>",
    "<div>{l1}</div><div>{l2}</div><div>{b3}</div><div>{l4}</div><div>{m40}</div><div>{m25}</div><div>{m5}</div><div>{m60}</div><div>{l2}</div><div>{b2}</div><div>{l3}</div><div>{b4}</div>",
    "<table><tr><td>{l2}<td>{b1}<td>{l1}</table><table><tr><td>{l6}</td><td><p>{m80}<p>{m30}<p>{m6}<p>{m45}</td><td>{l3}</td></tr></table><table><tr><td>{b3}<td>{l2}<td>{b5}</table>",
    "<div>{b2}</div><ul><li>{l1}<li>{l2}<li>{l1}</ul><h1>{m5}</h1><p>{m50}</p><p>{m4}</p><p>{m70}</p><h4>{b2}</h4><ul><li>{l6}<li>{l5}</ul><div>{b6}</div><div>{l2}</div>",
    "<article><h1>{m6}</h1><p>{m30}</p><p>{m4}</p><p>{m1}</p></article>",
    "<nav>{l2}{l3}</nav><article><p>{m3}</p></article>",
    "<p>{m40}</p><p>{m3}</p><p>{m25}</p>",
    "<div>{l2}</div><div>{l1}</div><div>{m30}</div><div>{m7}</div><div>{m50}</div>",
    "<main><p>{m2}</p><p>{m5}</p><ul><li>{m3}<li>{m2}</ul></main>",
    "<div class='notice'>{b16}</div><article><p>{m1}</p></article><footer>{b6}</footer>",
)


def training_pages() -> list[str]:
    """The labelled table: each layout in a few sizes, every block marked ``main`` or ``other``."""

    def fill(scale: float):
        def text(match):
            # articles come in all lengths, what surrounds them doesn't
            kind, n = match[1], max(1, round(int(match[2]) * (scale if match[1] == "m" else min(scale, 1.7))))
            said = " ".join(["word"] * n)
            if kind == "q":
                return f" <a href='#'>{said}</a>"
            said = f"<a href='#'>{said}</a>" if kind == "l" else said
            return f"<span data-mark='{'main' if kind == 'm' else 'other'}'>{said}</span>" + "<wbr>" * (kind != "m")

        return text

    return [re.sub(r"\{(\w)(\d+)\}", fill(scale), layout) for layout in LAYOUTS for scale in (0.3, 0.6, 1.0, 1.7, 3.0, 6.0)]


@lru_cache(maxsize=1)
def trained_tree():
    rows, labels = [], []
    for page in training_pages():
        blocks = blocks_of(page)
        rows.append(features(blocks))
        labels += [b.mark == "main" for b in blocks]
    return grow_tree(np.vstack(rows), np.array(labels, float))


def main_text(html: str | None, tree) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    kept = classify(tree, features(blocks)) > 0.5
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    tree = tree or trained_tree()

    @arrow_udf("string")
    def texts(html: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py(), tree) for h in html], pa.string())

    return pages.select("page_id", "url", texts("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
