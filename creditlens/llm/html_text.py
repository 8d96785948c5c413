"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags.  Each block is described
by its own word count and link density, those of its neighbours, and those of
the run of little-linked blocks that it stands in; and by the kind of element
around it.  A decision tree (Gini, trained here on the blocks of labelled
sample pages) tells article text from the rest.

An element is marked as beside the article by its tag, its role, or by a name
that is a whole word of its class or id (``no-sidebar`` is none); the id decides
where the two disagree.  An article or main element ends any mark that its
ancestors or its own names set.
"""

from __future__ import annotations

import html as entities
import random
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.common import map_batches

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>"[^"]*"|'[^']*'|[^'">])*+)>""", re.S)
_BLOCK = frozenset("""html head body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
article section main aside nav header footer form fieldset legend blockquote pre figure figcaption hr address details
summary dialog center menu""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
_SKIPPED = frozenset("""script style noscript template svg math iframe object canvas audio video select textarea button
title option datalist""".split())
_AROUND = frozenset("nav aside footer form dialog menu fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Whole names of elements beside the article, and of those that hold it.
_ASIDE_NAMES = frozenset("""ad ads adv advert advertisement adsense banner promo promotion sponsor sponsored cookie cookies
cookie-notice cookie-banner consent gdpr notice alert warning disclaimer menu nav navbar navigation breadcrumb breadcrumbs side
sidebar rail widget footer header masthead topbar comment comments comment-list commentlist kommentare commentaires comentarios
discussion replies respond share sharing social related recommended newsletter subscribe signup popup modal overlay login search
pagination pager tags copyright legal toolbar""".split())
_MAIN_NAMES = frozenset("article article-body articlebody content main post post-body entry entry-content story body text".split())
_ATTR = re.compile(r"""(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLOSER = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _SKIPPED}

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "run_words", "run_blocks",
            "run_longest", "aside", "main", "page_header", "heading")
#: A block with a smaller share of linked characters belongs to a run.
_RUN_LINKS = 0.5


class Block:
    __slots__ = ("text", "linked", "aside", "main", "header", "heading", "label")

    def __init__(self, text, linked, aside, main, header, heading, label):
        self.text, self.linked, self.aside, self.main = text, linked, aside, main
        self.header, self.heading, self.label = header, heading, label


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; comments, scripts, styles and controls are left out."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # tag, aside, main, page header, labelled
    parts: list[str] = []
    links: list[str] = []
    in_link = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1] if stack else ("", False, False, False, False)
                out.append(Block(text, len(" ".join("".join(links).split())), top[1], top[2], top[3],
                                 any(s[0] in _HEADINGS for s in stack[-2:]), top[4]))
        parts.clear()
        links.clear()

    def words(raw: str) -> None:
        text = entities.unescape(raw)
        parts.append(text)
        if in_link:
            links.append(text)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        words(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in _BLOCK:
                flush()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            continue
        if tag in _SKIPPED:
            if not m[3].rstrip().endswith("/"):
                end = _CLOSER[tag].search(page, at)
                # an element that is never closed is skipped as a tag only, unless its content is raw text
                at = end.end() if end else len(page) if tag in ("script", "style", "textarea", "title") else at
            continue
        if tag == "a":
            in_link += 1
        elif tag == "br":
            words(" ")
        elif tag in _BLOCK:
            flush()
            in_link = 0
            if stack and stack[-1][0] in ("p", *_HEADINGS):  # these end at the next block
                stack.pop()
            if tag in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == tag:
                stack.pop()
            if tag not in _VOID:
                stack.append(_opened(tag, m[3], stack))
    flush()
    return out


def _opened(tag: str, attrs: str, stack: list) -> tuple[str, bool, bool, bool, bool]:
    _, aside, main, header, label = stack[-1] if stack else ("", False, False, False, False)
    names, role = {"class": set(), "id": set()}, ""
    if "=" in attrs:
        for key, a, b, c in _ATTR.findall(attrs):
            value = a or b or c
            if key.lower() == "role":
                role = value.lower()
            elif key.lower() == "data-main":
                label = value == "1"
            else:
                names[key.lower()].update(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split())
    if tag in ("article", "main") or role in ("main", "article"):
        return tag, False, True, header, label
    if tag not in ("html", "body"):
        by_id = names["id"] & (_ASIDE_NAMES | _MAIN_NAMES)
        words = by_id or names["class"]
        beside = bool(words & _ASIDE_NAMES)
        aside = aside or tag in _AROUND or beside or role in (
            "navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu")
        header = header or (tag == "header" and not main)
        main = main or (bool(words & _MAIN_NAMES) and not beside)
    return tag, aside, main, header, label


def _runs(found: list[Block]) -> list[tuple[float, float, float]]:
    """Words, blocks and longest block of the run around each block: neighbours
    of the same place (beside the article or not) that are hardly linked.  A
    linked block is a run of its own without words."""
    out: list[tuple[float, float, float]] = []
    at = 0
    while at < len(found):
        end = at
        plain = lambda b: b.linked / len(b.text) < _RUN_LINKS
        while end < len(found) and plain(found[end]) and found[end].aside == found[at].aside and found[end].header == found[at].header:
            end += 1
        sizes = [len(b.text.split()) for b in found[at:end]]
        out += [(float(sum(sizes)), float(len(sizes)), float(max(sizes)))] * len(sizes) if sizes else [(0.0, 0.0, 0.0)]
        at = max(end, at + 1)
    return out


def describe(found: list[Block]) -> list[tuple[float, ...]]:
    """FEATURES of each block; a missing neighbour has no words and no links."""
    own = [(len(b.text.split()), b.linked / len(b.text)) for b in found]
    edge = [(0, 0.0)]
    return [(*own[i], *b, *a, *run, float(x.aside), float(x.main), float(x.header), float(x.heading))
            for i, (x, b, a, run) in enumerate(zip(found, edge + own[:-1], own[1:] + edge, _runs(found)))]


_SENTENCE = "The river rose over night and the lower road was closed until the water fell again"
#: Sample pages; ``data-main`` marks what is article text (1) and what is not (0).
SAMPLES = (
    f"""<body data-main=0><nav><ul><li><a>Home</a><li><a>World news</a><li><a>Sport</a></ul></nav>
    <div class=ad>Buy two lamps and get one for free today</div><article data-main=1><h1>Flood closes road</h1>
    <p>{_SENTENCE}.<p>Short line.<p>{_SENTENCE}, <a>officials</a> said.<p>{_SENTENCE}. {_SENTENCE}.<p>So it was.</article>
    <footer>Copyright by the paper, all rights reserved in every country of the world</footer>""",
    f"""<body data-main=0><header><h1>The Daily Paper</h1><p>News from the valley since the year of the great flood</p></header>
    <main data-main=1><h2>Road closed</h2><p>{_SENTENCE}.</p><ul><li>One lane</li><li>Two bridges over the river</li></ul>
    <blockquote>{_SENTENCE}</blockquote></main><aside><h3>Most read</h3><p>{_SENTENCE}</p><a>More of this</a></aside>
    <section class=comments data-main=0><h3>Comments</h3><p>{_SENTENCE}! I saw it too.</p><p>Great article</p></section>""",
    f"""<body data-main=0><div id=menu><a>Start</a> <a>Shop</a> <a>Contact</a></div>
    <div id=content data-main=1><h1>Water falls</h1><p>{_SENTENCE}. {_SENTENCE}.</p><p>Not all agreed.</p>
    <div class=related data-main=0><a>Read also: bridges of the valley</a></div><p>{_SENTENCE}.</p>
    <form data-main=0><p>Send us your mail address and we will write to you each week about the valley</p></form></div>
    <div class=cookie-notice>We use cookies to make this site work better for all of our readers every day</div>""",
    f"""<body data-main=0><div><a>Home</a> | <a>About</a> | <a>Archive</a></div><div><p data-main=1>{_SENTENCE}. {_SENTENCE}.
    {_SENTENCE}.</p><p data-main=1>{_SENTENCE}. {_SENTENCE}.</p><p data-main=1>{_SENTENCE}.</p></div>
    <div><a>Next page</a></div><div>Contact us</div>""",
    f"""<body data-main=0><div><a>One</a></div><div><a>Two</a></div><div><a>Three things to know</a></div>
    <table><tr data-main=1><td>{_SENTENCE}. {_SENTENCE}.</td></tr><tr data-main=1><td>{_SENTENCE}. {_SENTENCE}. {_SENTENCE}</td></tr>
    </table><div>All rights reserved</div><div><a>Terms</a> and <a>privacy</a></div>""",
    f"""<body data-main=0><article data-main=1><header><h1>Bridge opens</h1><p>By our writer in the valley</p></header>
    <p>Yes.</p><p>{_SENTENCE}.</p><p>No.</p><div class=share data-main=0><a>Share</a> <a>Mail</a></div>
    <aside data-main=0>{_SENTENCE}.</aside><p>{_SENTENCE}.</p><div class=advert data-main=0><p>{_SENTENCE}, buy now.</p></div>
    <p>It ended.</p><ol><li>First</li><li>Second step of the work</li></ol></article><div class=sidebar><p>{_SENTENCE}.</p></div>""",
    f"""<body data-main=0><div class=alert>Site will be down on Monday for repairs, please come back later on</div><main data-main=1><p>A.</p>
    <p>{_SENTENCE}. See <a>the map</a>.</p><p><a>{_SENTENCE}</a></p><h2>After</h2><p>{_SENTENCE}.</p></main>
    <div id=comments><div><p>{_SENTENCE}.</p></div><div><p>I agree</p></div></div><footer><ul><li><a>Imprint</a></ul></footer>""",
    f"""<body data-main=0><div id=main><ul data-main=0><li><a>Home</a><li><a>World</a><li><a>Sport and games</a></ul>
    <h1 data-main=1>Water falls</h1><p data-main=1>{_SENTENCE}.</p><p data-main=1>All was well.</p><p data-main=1>{_SENTENCE}.</p>
    <ul data-main=0><li><a>Older story</a><li><a>Newer story of the day</a><li><a>All stories</a></ul></div>""",
    f"""<body data-main=0><div><a>{_SENTENCE}</a></div><div><a>{_SENTENCE}</a> <a>{_SENTENCE}</a></div>
    <div data-main=1>{_SENTENCE}. {_SENTENCE}.</div><div data-main=1>{_SENTENCE}, <a>they</a> said.</div>
    <div><a>{_SENTENCE}</a> - <a>Older</a></div><div><a>{_SENTENCE}</a></div>""",
)


def _said(n: int) -> str:
    words = _SENTENCE.split()
    return " ".join(words[i % len(words)] for i in range(n))


def sample_pages() -> list[str]:
    """SAMPLES and, for every way to wrap an article, pages whose paragraphs
    and surroundings run through many lengths.  Unwrapped articles are told by
    counts and links alone: a run of paragraphs, short ones among them, with
    short or linked blocks around."""
    out = list(SAMPLES)
    wraps = ("article", "main", "div class=content", "div id=post-body", "section role=main", "div", "div", "div")
    asides = ("nav", "aside", "footer", "div class=ad", "div class='notice box'", "form", "div id=sidebar",
              "section class=comments", "header")
    dice = random.Random(7)
    for k in range(50 * len(wraps)):
        wrap, plain = wraps[k % len(wraps)], wraps[k % len(wraps)] == "div"
        sizes = [dice.randint(1, dice.choice((20, 60, 250))) for _ in range(dice.randint(3 if plain else 1, 8))]
        while plain and sum(sizes) < 40:  # a page without a wrapper is an article only if it says something
            sizes.append(dice.randint(1, 20))
        text = [f"<p>{_said(n)}.</p>" for n in sizes]
        links = lambda: "".join(f"<li><a>{_said(dice.randint(1, 6))}</a>" for _ in range(dice.randint(2, 6)))
        # a header inside the article is the article's own
        box = lambda kinds=asides: (
            f"<div><a>{_said(dice.randint(1, 4))}</a></div><div>{_said(dice.randint(1, 8))}</div><div><a>{_said(dice.randint(1, 4))}</a></div>" if plain else
            f"<{(tag := dice.choice(kinds))}>{dice.choice(('', f'<h3>{_said(dice.randint(1, 6))}</h3>'))}"
            + "".join(f"<p>{_said(dice.randint(1, dice.choice((12, 60))))}</p>" for _ in range(dice.randint(1, 4)))
            + f"</{tag.split()[0]}>")
        head = "" if plain or dice.random() < 0.5 else f"<h1>{_said(dice.randint(1, 14))}</h1>"
        inner = lambda: "" if plain else dice.choice(
            ("", f"<ul data-main=0>{links()}</ul>", f"<div data-main=0>{box(asides[:-1])}</div>"))
        for _ in range(2):
            text.insert(dice.randint(0, len(text)), inner())
        out.append(f"<body data-main=0><ul>{links()}</ul>{box()}<{wrap} data-main=1>{head}{''.join(text)}"
                   f"</{wrap.split()[0]}>{box()}<div><a>{_said(dice.randint(1, 5))}</a></div>{dice.choice(('', box()))}")
    return out


class Leaf:
    def __init__(self, keep: bool):
        self.keep = keep


def train(rows: list[tuple[float, ...]], labels: list[bool], depth: int = 8, leaf: int = 3):
    """A binary tree ``(feature, threshold, low, high)`` or Leaf by Gini
    impurity with at least ``leaf`` blocks on a side; among equally good splits the first feature and lowest
    threshold win."""
    yes = sum(labels)
    if not depth or yes in (0, len(labels)):
        return Leaf(2 * yes >= len(labels))
    best = None
    for f in range(len(FEATURES)):
        values = sorted(set(r[f] for r in rows))
        for cut in ((a + b) / 2 for a, b in zip(values, values[1:])):
            low = [y for r, y in zip(rows, labels) if r[f] <= cut]
            high = [y for r, y in zip(rows, labels) if r[f] > cut]
            if min(len(low), len(high)) < leaf:
                continue
            mixed = sum(sum(s) * (len(s) - sum(s)) / len(s) for s in (low, high))
            if best is None or mixed < best[0] - 1e-12:
                best = (mixed, f, cut)
    if best is None:
        return Leaf(2 * yes >= len(labels))
    _, f, cut = best
    sides = [([r for r in rows if (r[f] <= cut) == low], [y for r, y in zip(rows, labels) if (r[f] <= cut) == low])
             for low in (True, False)]
    return f, cut, train(*sides[0], depth - 1, leaf), train(*sides[1], depth - 1, leaf)


@lru_cache
def default_tree():
    rows, labels = [], []
    for page in sample_pages():
        found = blocks(page)
        rows += describe(found)
        labels += [b.label for b in found]
    return train(rows, labels)


def keeps(tree, row: tuple[float, ...]) -> bool:
    while not isinstance(tree, Leaf):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree.keep


def main_text(page: str | None) -> str:
    """Kept blocks in page order, joined by an empty line; null or empty pages give ''."""
    if not page:
        return ""
    found = blocks(page)
    tree = default_tree()
    return "\n\n".join(b.text for b, row in zip(found, describe(found)) if keeps(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per input row.  Null and empty pages
    give '', very long pages are read whole, repeated rows each get a row,
    null ids and urls stay null; other columns, whatever their names, are
    ignored.  An empty table gives an empty result."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return map_batches(rows, run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
