"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes a row of text blocks. A linear classifier over a block's surroundings (elements, class and
id words) and shape (length, share of linked text, punctuation) gives each block a cost for either label;
the costs are capacities to the two terminals. Blocks next to each other, and blocks under the same parent
element, are tied by smoothness edges. The maximum flow then finds the labelling of least total cost, so a
short line amid an article stays and a long line amid a menu goes.
"""

import html as entities
import re
from collections import deque
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements; fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "button", "option", "optgroup", "iframe"}
SIBLINGS = {"li": "li", "dt": "dd dt", "dd": "dd dt", "td": "td th", "th": "td th", "tr": "tr td th", "option": "option"}

#: Words that name a part of a page which is not its article.
OUTSIDE_ELEMENTS = frozenset("nav footer aside form menu dialog search button select".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot banner banners breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disclaimer disqus dropdown footer gdpr header masthead "
    "menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup popups "
    "promo promoted promotion recommended related replies reply respond responses share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
INSIDE_WORDS = frozenset("article content entry post story body main text".split())

# Weights of the classifier, positive for content.
INSIDE, OUTSIDE, LINKED, LONG, SENTENCE, SHORT, HEADING = 14, -40, -18, 10, 3, -1, 2
#: Words after which a block counts as fully long.
LONG_WORDS = 40
# Capacities of the smoothness edges; the last is for neighbours in different parts of the page.
NEXT, SAME_PARENT, ACROSS = 2, 3, 1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe)(?=[\s/>])[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][\w:-]*)(?P<attributes2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_SVG = re.compile(r"<(?P<end>/?)svg(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>", re.I)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|style|hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"""[.!?…][)"'»”’\]]*$""")


class Block:
    """Text between two block-level tags."""

    __slots__ = ("parts", "linked", "parent", "standing", "tag")

    def __init__(self, parent: int, standing: int, tag: str):
        self.parts, self.linked, self.parent, self.standing, self.tag = [], 0, parent, standing, tag


def standing_of(tag: str, attributes: str, outer: int, in_article: bool) -> int:
    """1 inside an article, -1 inside another part of the page, 0 undecided; inner elements overrule outer ones."""
    if tag in OUTSIDE_ELEMENTS or (tag == "header" and not in_article):
        return -1
    if tag in ("article", "main"):
        return 1 if outer >= 0 else outer
    if attributes:
        names = {}
        for name, *values in _NAMED.findall(attributes):
            names[name.lower()] = "".join(values)
        if "hidden" in names or "display:none" in names.get("style", "").replace(" ", "").lower():
            return -1
        if names.get("role", "").lower() in OUTSIDE_ROLES:
            return -1
        words = set(_WORD.findall(_CAMEL.sub(" ", f"{names.get('class', '')} {names.get('id', '')}").lower()))
        if words & OUTSIDE_WORDS and not (tag in ("body", "html") or (in_article and words & {"header"})):
            return -1
        if words & INSIDE_WORDS and outer == 0 and tag not in ("body", "html"):
            return 1
    return outer


def svg_ends(page: str) -> dict[int, int]:
    """Where svg elements end, by where their first tags do; those without an end tag are not in it."""
    opened, ends = [], {}
    for tag in _SVG.finditer(page):
        if tag["end"]:
            if opened:
                ends[opened.pop()] = tag.end()
        elif not tag[0].endswith("/>"):
            opened.append(tag.end())
    return ends


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Scripts, styles, comments, titles and drawings hold no text of it."""
    found: list[Block] = []
    # Open elements: (tag, number, standing, within an article, within a link).
    stack: list[tuple[str, int, int, bool, bool]] = [("", 0, 0, False, False)]
    current, number, at = None, 0, 0
    drawings: dict[int, int] | None = None

    def close(down_to: int) -> None:
        del stack[max(1, down_to):]

    def innermost(tags: tuple[str, ...], until: tuple[str, ...] = ()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in until:
                return 0
        return 0

    while token := _TOKEN.search(page, at):
        if token.start() > at:
            current = _text(page[at:token.start()], current, stack, found)
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "svg" and not (token["end"] or token["end2"]):
            drawings = svg_ends(page) if drawings is None else drawings
            at = drawings.get(at, at)
            continue
        if tag in BLOCKS:
            current = None
        if token["end"] or token["end2"]:
            if place := innermost((tag,)):
                close(place)
        elif tag not in VOID and not (tag == "math" and token[0].endswith("/>")):
            if tag in CLOSES_P and (place := innermost(("p",), ("td", "th", "button", "li", "div", "article", "section"))):
                close(place)
            if tag in SIBLINGS and (place := innermost(tuple(SIBLINGS[tag].split()), ("ul", "ol", "dl", "table", "select"))):
                close(place)
            _, _, outer, in_article, linked = stack[-1]
            attributes = token["attributes"] or token["attributes2"] or ""
            number += 1
            standing = standing_of(tag, attributes, outer, in_article)
            stack.append((tag, number, standing, in_article or tag in ("article", "main"), linked or tag == "a"))
    if at < len(page):
        _text(page[at:], current, stack, found)
    return found


def _text(raw: str, current: Block | None, stack: list, found: list[Block]) -> Block | None:
    text = entities.unescape(raw) if "&" in raw else raw
    if current is None:
        if text.isspace():
            return None
        # The parent is the innermost block-level element around.
        tag, number, *_ = next((x for x in reversed(stack) if x[0] in BLOCKS), stack[0])
        grand = next((x[1] for x in reversed(stack) if x[0] in BLOCKS and x[1] != number), 0)
        current = Block(grand if tag in ("p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd") else number,
                        stack[-1][2], tag)
        found.append(current)
    current.parts.append(text)
    if stack[-1][4]:
        current.linked += len(text.split())
    return current


def balance(block: Block, text: str) -> int:
    """The classifier: what labelling the block as boilerplate costs, less what labelling it content does."""
    n = max(1, len(text.split()))
    score = (INSIDE, 0, OUTSIDE)[1 - block.standing]
    score += LONG * min(n, LONG_WORDS) // LONG_WORDS + LINKED * min(block.linked, n) // n
    score += SENTENCE if _SENTENCE.search(text) else 0
    score += SHORT if n < 4 else 0
    score += HEADING if block.tag[:1] == "h" and block.tag[1:].isdigit() else 0
    return score


def minimum_cut(balances: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes lie on the content side of a minimum cut; of several cuts, the one with least content.

    A node whose own balance outweighs all its edges keeps its label in every minimum cut; its edges turn
    into balances of its neighbours. Only what this leaves undecided needs a flow.
    """
    net, around = list(balances), [{} for _ in balances]
    for (i, j), capacity in edges.items():
        around[i][j] = around[i].get(j, 0) + capacity
        around[j][i] = around[j].get(i, 0) + capacity
    label: list[bool | None] = [None] * len(net)
    queue = deque(range(len(net)))
    while queue:
        i = queue.popleft()
        if label[i] is not None or not (net[i] > (tied := sum(around[i].values())) or -net[i] >= tied):
            continue
        label[i] = net[i] > tied
        for j, capacity in around[i].items():
            del around[j][i]
            net[j] += capacity if label[i] else -capacity
            queue.append(j)
        around[i] = {}
    undecided = [i for i, x in enumerate(label) if x is None]
    if undecided:
        content = _reachable(net, around, undecided)
        for i in undecided:
            label[i] = i in content
    return [bool(x) for x in label]


def _reachable(net: list[int], around: list[dict[int, int]], nodes: list[int]) -> set[int]:
    """Maximum flow by levels (Dinic) from nodes with a surplus to nodes with a lack; then what is still reached."""
    rest = {i: dict(around[i]) for i in nodes}
    surplus = {i: max(net[i], 0) for i in nodes}
    lack = {i: max(-net[i], 0) for i in nodes}
    while True:
        level = {i: 0 for i in nodes if surplus[i]}
        queue, ends = deque(level), False
        while queue:
            i = queue.popleft()
            ends = ends or lack[i] > 0
            for j, capacity in rest[i].items():
                if capacity and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not ends:
            return set(level)
        tries = {i: iter(list(rest[i])) for i in level}
        for source in [i for i in level if surplus[i]]:
            path = [source]
            while path and surplus[source]:
                i = path[-1]
                if lack[i]:
                    pushed = min([surplus[source], lack[i], *(rest[a][b] for a, b in pairwise(path))])
                    surplus[source] -= pushed
                    lack[i] -= pushed
                    for a, b in pairwise(path):
                        rest[a][b] -= pushed
                        rest[b][a] = rest[b].get(a, 0) + pushed
                    path = [source]
                    tries[source] = iter(list(rest[source]))
                    continue
                for j in tries[i]:
                    if rest[i].get(j) and level.get(j) == level[i] + 1:
                        path.append(j)
                        break
                else:
                    path.pop()


def main_text(page: str) -> str:
    found = [(b, text) for b in blocks(page) if (text := _SPACE.sub(" ", "".join(b.parts)).strip())]
    balances = [balance(b, text) for b, text in found]
    edges: dict[tuple[int, int], int] = {}
    last_under: dict[tuple[int, int], int] = {}
    for i, (b, _) in enumerate(found):
        if i:
            edges[i - 1, i] = NEXT if found[i - 1][0].standing == b.standing else ACROSS
        if (before := last_under.get((b.parent, b.standing))) is not None:
            edges[before, i] = edges.get((before, i), 0) + SAME_PARENT
        last_under[b.parent, b.standing] = i
    kept = minimum_cut(balances, edges)
    return " ".join(text for (_, text), k in zip(found, kept) if k)


@F.arrow_udf(T.StringType())
def main_texts(html: pa.Array) -> pa.Array:
    return pa.array([main_text(page) for page in html.fill_null("").to_pylist()], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; a null or empty page, or one without content, has an empty text."""
    rows = pages.select("page_id", "url", main_texts("html").alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
