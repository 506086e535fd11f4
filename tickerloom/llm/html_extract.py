"""Main text of web pages by wrappers inferred per host as union-free regular expressions.

A page becomes a stream of tokens: tags (name and the attributes that mark a region) and
text slots. Within a page, neighbouring equal runs become one repeated group; the streams
of a host are then aligned one after another, and a mismatch becomes an optional group.
What is left is a wrapper: tags, text slots, ``( )?`` and ``( )+``, without unions.

Every item of a page's stream is aligned with an item of its host's wrapper. Texts are counted
there: what most pages share at an item is template. The body is the narrowest element of the
wrapper that holds three quarters of the varying text; a page is read by the element of its
own that aligns with it. Marks (article, main, a class word) are features: marked text weighs
more, and a page whose own article lies elsewhere is read by that. A host with one page, or a
page without the element, is left with the marks.

Folding repeats first leaves few different streams per host. They are counted before any
shuffle and merged in salted groups, so a host with a third of all pages costs a row per
task and stream; no sample is taken, every page takes part.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, clean_text, stored

TEXT = "#"
#: Partial wrappers of one host in each round of merging.
SALTS = (256, 16, 1)

# Element names of the HTML standard by what they hold.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math head title textarea select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
ASIDE_TAGS = frozenset("nav header footer aside form button menu dialog".split())
MAIN_TAGS = ("article", "main")
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
                            "header hr main nav ol p pre section table ul".split()),
             "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
             "option": frozenset(["option"])}
# Whole tokens of class, id or role that mark a part beside the article.
ASIDE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo "
                        "promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
                        "sidebar aside widget related recommended comment comments reply replies disqus "
                        "respond notice cookie cookies consent popup modal overlay alert newsletter "
                        "subscribe subscription signup login share sharing social toolbar pagination pager "
                        "form search hidden contentinfo complementary".split())
# The same for names of several words: a first word with a last one, in use for such parts.
ASIDE_FIRST = frozenset("ad ads advert banner sponsor promo nav main site page global top bottom left right primary "
                        "secondary breadcrumb sidebar widget related recommended comment comments cookie "
                        "cookies consent gdpr popup modal newsletter subscribe signup login share sharing "
                        "social pagination search skip post posts footer header".split())
ASIDE_LAST = frozenset("ad ads advert banner slot nav navbar navigation menu breadcrumb breadcrumbs footer sidebar "
                       "widget widgets notice consent popup modal overlay newsletter subscribe signup login "
                       "share sharing buttons icons links toolbar pagination pager form box comments replies "
                       "list area bar posts articles banners".split())
# Of those pairs, the ones whose words alone say nothing: "main-list", "page-area".
PLAIN_FIRST = frozenset("main site page global top bottom left right primary secondary post posts".split())
PLAIN_LAST = frozenset("slot buttons icons links box list area bar posts articles".split())
# Words that say alone, at any place of a name, that a part is not the article.
FOREIGN = re.compile(r"(?:user|reader|fb)?comments?(?:list|form|area|box|section|thread|body|wrapper)?|disqus|"
                     r"ads|adsbygoogle|adverts?|advertise?ments?|advertising|sponsors?|sponsored")
FOREIGN_FIRST = frozenset("ad related recommended sidebar".split())
FOREIGN_LAST = frozenset("container wrapper unit block frame label zone space stories news videos reading topics left "
                         "right top bottom primary secondary inner content".split())
ANY_LAST = frozenset("notice menu nav navbar sidebar breadcrumb breadcrumbs newsletter".split())
HOLDERS = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
STATE_WORDS = frozenset("has with no without open closed enabled disabled".split())
MAIN_WORDS = frozenset("article content main post story entry".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _aside(words: list[str]) -> str:
    """``!`` for a part that is never the article, ``-`` for one that may hold it after all."""
    first, last = words[0], words[-1]
    if any(FOREIGN.fullmatch(word) for word in words):
        return "!"
    if first in FOREIGN_FIRST and (len(words) == 1 or last in FOREIGN_LAST or last in ASIDE_LAST):
        return "!"
    if len(words) == 1:
        return "-" if first in ASIDE_WORDS else ""
    if first in PLAIN_FIRST and last == "header":
        return "-" if first in ("site", "page", "global", "top") else ""
    if last in ANY_LAST:
        return "-"
    named = first in ASIDE_FIRST and last in ASIDE_LAST
    return "-" if named and not (first in PLAIN_FIRST and last in PLAIN_LAST) else ""


def _mark(name: str, attributes: str) -> str:
    """``-`` for a part beside the article, ``+`` for one that may hold it, else nothing.

    ``!`` is a part that is not shown, or never the article. Headings are not marked by an id, which links to them.
    """
    names: list[list[str]] = []
    for found in _ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true":
            return "!"
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                return "!"
        elif key in ("class", "role") or key == "id" and name not in HEADINGS:
            for token in value.split():
                if words := [x for x in _SPLIT.split(_CAMEL.sub("-", token).lower()) if x]:
                    names.append(words)
    if name in ("span", "code", "i", "em"):
        names = [words for words in names if words not in (["comment"], ["comments"])]      # of a program
    marks = {_aside(words) for words in names}
    if name == "article" and any(words[0] == "comment" and len(words) < 3 for words in names):
        return "!"
    # "has-sidebar" or "comments-open" on a holder of the page tell of it, not what it is.
    if name not in HOLDERS and not any(STATE_WORDS & set(x) for x in names):
        if "!" in marks:
            return "!"
        if "-" in marks:
            return "-"
    if name in ASIDE_TAGS:
        return "-"
    main = any(MAIN_WORDS.intersection(x) and not ASIDE_WORDS.intersection(x) and not _aside(x) for x in names)
    return "+" if name in MAIN_TAGS or main else ""


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(symbol, text): ``<name``+mark, ``/name`` or ``#`` with its decoded, spaced text.

    What scripts, styles and other raw elements hold is skipped; comments and declarations are
    nothing. A tag that never closes ends with the page.
    """
    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() < at:
            continue
        if found.start() > at:
            yield TEXT, page[at:found.start()]
        at = found.end()
        if not found[2]:
            if found[0].startswith("<![CDATA["):
                yield TEXT, found[0][9:].removesuffix("]]>")
            continue
        name = found[2].lower()
        if found[1]:
            yield "/" + name, ""
        elif name in RAW:
            close = re.compile(rf"</{name}\s*>|(?=<body[\s>])" if name == "head" else rf"</{name}\s*>",
                               re.IGNORECASE).search(page, at)
            at = close.end() if close else at if name == "head" else len(page)
        else:
            yield f"<{name}{_mark(name, found[3])}", ""
    if at < len(page):
        yield TEXT, page[at:]


def spaced(text: str) -> str:
    return " ".join(html.unescape(text).split())


def leaves(page: str) -> list[tuple[str, str]]:
    """Tokens without blank slots; neighbouring slots become one."""
    out: list[tuple[str, str]] = []
    for symbol, text in tokens(page):
        if symbol == TEXT:
            if out and out[-1][0] == TEXT:
                out[-1] = (TEXT, out[-1][1] + text)
                continue
            if not text.strip() and "&" not in text:
                # Blank, but it parts the words on both sides.
                if out:
                    out.append((" ", text))
                continue
        out.append((symbol, text))
        if symbol.startswith("<br"):
            out.append((" ", " "))
    return out


Shape = tuple  # of symbols, or ("+", shape) and ("?", shape) groups


_RUNS = [re.compile(rf"(.{{{size}}})\1+", re.DOTALL) for size in range(1, 25)]
_FIRST_CODE = 0x100


def fold(items: list) -> Shape:
    """Neighbouring equal runs as one repeated group, short runs first, until nothing changes.

    A run that repeats anywhere counts as a group of one elsewhere, so a page with one
    paragraph and a page with ten have the same shape. Items become single characters, which
    leaves the search for runs to the regular-expression engine.
    """
    codes: dict = {}
    stream = "".join(codes.setdefault(item, chr(_FIRST_CODE + len(codes))) for item in items)
    known: list = list(codes)
    groups: dict[str, str] = {}

    def plain(run: str) -> tuple:
        return tuple(known[ord(ch) - _FIRST_CODE] for ch in run)

    changed = True
    while changed:
        changed = False
        for pattern in _RUNS:
            while found := pattern.search(stream):
                run, changed = found[1], True
                if len(run) == 1 and isinstance(plain(run)[0], tuple) and plain(run)[0][0] == "+":
                    group = run
                else:
                    if run not in groups:
                        groups[run] = chr(_FIRST_CODE + len(known))
                        known.append(("+", plain(run)))
                    group = groups[run]
                    stream = stream.replace(run, group)
                stream = re.sub(re.escape(group) + "{2,}", group, stream)
    return plain(stream)


def _core(item):
    """What an item repeats: itself, or the inside of a repeated group."""
    while isinstance(item, tuple) and item[0] == "+":
        inner = item[1]
        if len(inner) != 1:
            return inner
        item = inner[0]
    return item


def _flat(shape: Shape) -> list[tuple[object, bool]]:
    """Items with whether they are optional."""
    out: list[tuple[object, bool]] = []
    for item in shape:
        if isinstance(item, tuple) and item[0] == "?":
            out += [(inner, True) for inner in item[1]]
        else:
            out.append((item, False))
    return out


def _contexts(items: list, known: dict) -> list[int]:
    """The marked regions that each item stands in, as one number for equal regions."""
    stack: list[tuple[str, int]] = []
    opened: Counter = Counter()
    out = []

    def enter(item) -> None:
        if isinstance(item, tuple):
            for inner in item[1]:
                enter(inner)
        elif item[0] == "<" and item[-1] in "+-!":
            stack.append((item[1:-1], known.setdefault((stack[-1][1] if stack else 0, item), len(known) + 1)))
            opened[item[1:-1]] += 1
        elif item[0] == "/" and opened[item[1:]]:
            closed = None
            while closed != item[1:]:
                closed = stack.pop()[0]
                opened[closed] -= 1

    for item in items:
        out.append(stack[-1][1] if stack else 0)
        enter(item)
    return out


def matches(left: list, right: list) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of two lists of items.

    Items match when they repeat the same thing within the same marked regions, so a region
    that one side lacks stays in one piece, together with its slots.
    """
    keys: dict = {}
    regions: dict = {}
    one, two = (np.array([keys.setdefault((_core(item), around), len(keys))
                          for item, around in zip(side, _contexts(side, regions))], np.int64)
                for side in (left, right))
    first, ends = 0, (len(one), len(two))
    while first < min(ends) and one[first] == two[first]:
        first += 1
    last = 0
    while last < min(ends) - first and one[-1 - last] == two[-1 - last]:
        last += 1
    found = [(n, n) for n in range(first)]
    found += [(first + a, first + b) for a, b in _common(one[first:len(one) - last], two[first:len(two) - last])]
    return found + [(ends[0] - n, ends[1] - n) for n in range(last, 0, -1)]


def _common(one: np.ndarray, two: np.ndarray) -> list[tuple[int, int]]:
    if len(two) > len(one):
        return [(a, b) for b, a in _common(two, one)]
    # Row n holds the lengths for the first n items of the shorter side. Neighbouring lengths
    # differ by one at most, so a bit each is kept of every row but the last.
    row, steps = np.zeros(len(one) + 1, np.int32), []
    for item in two:
        longer = row.copy()
        longer[1:] = np.maximum(row[1:], row[:-1] + (one == item))
        row = np.maximum.accumulate(longer)
        steps.append(np.packbits(np.diff(row) > 0))
    out, at = [], len(one)
    for n in range(len(two) - 1, -1, -1):
        now = np.cumsum(np.unpackbits(steps[n], count=len(one)), dtype=np.int32)
        above = (np.cumsum(np.unpackbits(steps[n - 1], count=len(one)), dtype=np.int32) if n
                 else np.zeros(len(one), np.int32))
        if not at or now[at - 1] == above[at - 1]:
            continue                    # the item is not needed for the longest
        at = int(np.searchsorted(now[:at], now[at - 1])) + 1
        out.append((at - 1, n))
        at -= 1
    return out[::-1]


def align(wrapper: Shape, page: Shape) -> Shape:
    """A wrapper for both: what both have stays, what one lacks becomes optional.

    Two items match when they are equal or repeat the same thing; then the repeated form stays.
    """
    if wrapper == page:
        return wrapper
    left, right = _flat(wrapper), _flat(page)
    out: list[tuple[object, bool]] = []
    a = c = 0
    for b, d in [*matches([x for x, _ in left], [y for y, _ in right]), (len(left), len(right))]:
        out += [(item, True) for item, _ in left[a:b] + right[c:d]]
        if b < len(left):
            (x, p), (y, q) = left[b], right[d]
            out.append((x if isinstance(x, tuple) else y, p or q))
        a, c = b + 1, d + 1
    return tuple(("?", (item,)) if optional else item for item, optional in out)


def write_shape(shape: Shape) -> str:
    return " ".join(f"( {write_shape(x[1])} ){x[0]}" if isinstance(x, tuple) else x for x in shape)


def read_shape(text: str) -> Shape:
    stack: list[list] = [[]]
    for part in text.split():
        if part == "(":
            stack.append([])
        elif part[0] == ")":
            inner = tuple(stack.pop())
            stack[-1].append((part[1], inner))
        else:
            stack[-1].append(part)
    return tuple(stack[0])


def expression(shape: Shape) -> str:
    """The wrapper as a Python regular expression over `` symbol`` strings."""
    return "".join(f"(?:{expression(x[1])}){x[0]}" if isinstance(x, tuple) else " " + re.escape(x)
                   for x in shape)


#: Elements beside the article by their name. A form may also be around a whole page.
SIDE_TAGS = ASIDE_TAGS - {"form"}
PAGE_PARTS = frozenset(("nav", "footer", *MAIN_TAGS))


def slots(symbols: list[str]) -> list[tuple[int, bool, int, int]]:
    """(token, inside a part beside the article, rank of the region, block) of every slot.

    Ranks: 3 in an article, 2 in main, 1 in a part with a class word, else 0. Marked elements
    form a tree that is walked a fixed number of times, so work is linear in the page.
    """
    parents: list[int] = []
    names: list[str] = []
    marks: list[str] = []
    # (name, marked element that it is or stands in, where its nearest block element is)
    stack: list[tuple[str, int, int]] = []
    opened: Counter = Counter()
    placed, block = [], 0

    def close(to: int) -> None:
        while len(stack) > to:
            opened[stack.pop()[0]] -= 1

    for n, symbol in enumerate(symbols):
        if symbol[0] == "<":
            mark = symbol[-1] if symbol[-1] in "+-!" else ""
            name = symbol[1:].removesuffix(mark) if mark else symbol[1:]
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                close(len(stack) - 1)
            if name not in INLINE:
                # A block also ends a paragraph whose inline tags were left open.
                at = stack[-1][2] if stack else -1
                if at >= 0 and name in CLOSED_BY.get(stack[at][0], ()):
                    close(at)
                block += 1
            if name not in VOID:
                inside = stack[-1][1] if stack else -1
                if mark or name in MAIN_TAGS:
                    parents.append(inside)
                    names.append(name)
                    marks.append(mark)
                    inside = len(names) - 1
                own = len(stack) if name not in INLINE else stack[-1][2] if stack else -1
                stack.append((name, inside, own))
                opened[name] += 1
        elif symbol[0] == "/":
            name = symbol[1:]
            if opened[name]:
                closed = None
                while closed != name:
                    closed = stack.pop()[0]
                    opened[closed] -= 1
            if name not in INLINE:
                block += 1
        else:
            # Only what can decide is kept of the tags around a slot.
            placed.append((n, stack[-1][1] if stack else -1, block))
    ranks = []
    for parent, name, mark in zip(parents, names, marks):
        own = 3 if name == "article" else 2 if name == "main" else int(mark == "+")
        ranks.append(max(own, ranks[parent] if parent >= 0 else 0))
    held = [0] * len(names)
    for n, region, _ in placed:
        if region >= 0 and symbols[n] == TEXT:
            held[region] += 1
    bare = sum(region < 0 for n, region, _ in placed if symbols[n] == TEXT)
    beside = _beside(parents, names, marks, ranks, held, bare)
    return [(n, region >= 0 and beside[region], ranks[region] if region >= 0 else 0, block)
            for n, region, block in placed]


def _above(parents: list[int], own: list[bool]) -> list[bool]:
    """For every element whether it or one around it is meant; parents come first."""
    out: list[bool] = []
    for parent, mine in zip(parents, own):
        out.append(mine or parent >= 0 and out[parent])
    return out


def _below(parents: list[int], own: list[int]) -> list[int]:
    """For every element the sum over it and all inside it."""
    out = list(own)
    for n in range(len(out) - 1, -1, -1):
        if parents[n] >= 0:
            out[parents[n]] += out[n]
    return out


def _beside(parents: list[int], names: list[str], marks: list[str], ranks: list[int], held: list[int],
            bare: int) -> list[bool]:
    """Which marked elements are beside the article.

    ``-`` does not hold for a header inside the article, nor for a form around the parts of a
    page. On a page whose article or main elements all stand in parts marked so, class words
    around them mean something else; where nothing else would be left, neither the marks around
    them hold nor, without such elements, those around all the text. ``!`` always holds.
    """
    count = range(len(names))
    hidden = _above(parents, [mark == "!" for mark in marks])
    in_main = _above(parents, [name in MAIN_TAGS for name in names])
    parts = _below(parents, [name in PAGE_PARTS for name in names])
    void = {n for n in count if names[n] == "form" and parts[n]}

    def around(void: set[int]) -> list[bool]:
        return _above(parents, [marks[n] == "!" or marks[n] == "-" and n not in void and not (
            names[n] == "header" and parents[n] >= 0 and in_main[parents[n]]) for n in count])

    out = around(void)
    if any(held[n] and not out[n] and ranks[n] >= 2 for n in count):
        return out
    whole = _below(parents, held)
    kept = bare or any(held[n] and not out[n] for n in count)
    side = _above(parents, [marks[n] == "-" and names[n] in SIDE_TAGS for n in count])
    mains = [n for n in count if names[n] in MAIN_TAGS and whole[n] and not hidden[n]]
    if mains:
        free = [n for n in mains if not side[n]]
        chosen = free or ([] if kept else mains)
        picked = set(chosen)
        holds = _below(parents, [int(n in picked) for n in count])
        return around(void | {n for n in count if marks[n] == "-" and holds[n]})
    if not kept:
        loose = [0 if hidden[n] or side[n] else held[n] for n in count]
        total, inside = sum(loose), _below(parents, loose)
        return around(void | {n for n in count if total and marks[n] == "-" and inside[n] == total
                              and names[n] not in SIDE_TAGS})
    return out


def spans(shape: Shape, symbols: list[str], groups: bool = False) -> list[int] | None:
    """Which item of its folded shape every symbol is, -1 inside repeated groups unless ``groups``."""

    def end_of(item, at: int) -> int:
        if not isinstance(item, tuple):
            return at + 1 if at < len(symbols) and symbols[at] == item else -1
        end = -1
        while True:
            now = at
            for inner in item[1]:
                if (now := end_of(inner, now)) < 0:
                    return end
            at = end = now

    out: list[int] = []
    for number, item in enumerate(shape):
        end = end_of(item, len(out))
        if end < 0:
            return None
        out += [-1 if isinstance(item, tuple) and not groups else number] * (end - len(out))
    return out if len(out) == len(symbols) else None


def places(wrapper: Shape, shape: Shape) -> list[int]:
    """The wrapper's item of every item of a folded stream, -1 where there is none."""
    out = [-1] * len(shape)
    for a, b in matches([item for item, _ in _flat(wrapper)], list(shape)):
        out[b] = a
    return out


#: The body holds so much of the varying text, weighted by the region that it stands in.
SHARE = 0.75
WEIGHTS = (1, 2, 4, 4)
PARAGRAPHS = HEADINGS | frozenset("p li dt dd pre blockquote".split())


def elements(items: list) -> list[tuple[int, int, int, str]]:
    """(open, end, number of the element around, name) of the elements outside repeated groups."""
    out: list[list] = []
    stack: list[int] = []
    opened: Counter = Counter()

    def close(at: int) -> str:
        name = out[stack.pop()][3]
        opened[name] -= 1
        out[number][1] = at
        return name

    for at, item in enumerate(items):
        if isinstance(item, tuple):
            continue
        if item[0] == "<":
            name = item[1:].rstrip("+-!") if item[-1] in "+-!" else item[1:]
            while stack and name in CLOSED_BY.get(out[stack[-1]][3], ()):
                number = stack[-1]
                close(at)
            if name not in VOID:
                out.append([at, len(items), stack[-1] if stack else -1, name])
                stack.append(len(out) - 1)
                opened[name] += 1
        elif item[0] == "/" and opened[item[1:]]:
            closed = None
            while closed != item[1:]:
                number = stack[-1]
                closed = close(at + 1)
    return [tuple(x) for x in out]


def body(items: list, weights: dict[int, int]) -> list[int]:
    """Where the body of a wrapper opens, -1 for all of it, then its headings outside; none
    without any varying text.

    The narrowest element that holds ``SHARE`` of the weight, not narrower than an article.
    """
    sums = np.concatenate([[0], np.cumsum([max(0, weights.get(n, 0)) for n in range(len(items))])])
    total = sums[-1]
    if not total:
        return []
    found = elements(items)
    first, last, around, best = -1, len(items), -1, ""
    for at, end, parent, name in found:
        if (name not in INLINE and name not in PARAGRAPHS and first < at < last
                and sums[end] - sums[at] >= SHARE * total):
            first, last, around, best = at, end, parent, name
            if name in MAIN_TAGS:
                break
    if first < 0 or best in MAIN_TAGS:
        return [first]
    return [first, *(at for at, end, parent, name in found if at < first and sums[end] > sums[at]
                     and (name == "h1" or name in HEADINGS and parent == around))]


def inside(shape: Shape, at: list[int], opens: list[int]) -> list[int] | None:
    """A stream's items in the elements that align with those of the wrapper; None without
    the body."""
    if not opens:
        return None
    if opens[0] < 0:
        return list(range(len(shape)))
    wanted = set(opens)
    own = [(open_, end) for open_, end, _, _ in elements(list(shape)) if at[open_] in wanted]
    if all(at[open_] != opens[0] for open_, _ in own):
        return None
    return sorted({n for open_, end in own for n in range(open_, end)})


class Page:
    """A page's leaves and its slots by region."""

    def __init__(self, page: str):
        self.leaves = leaves(page)
        self.placed = [x for x in slots([symbol for symbol, _ in self.leaves]) if not x[1]]

    def texts(self) -> list[tuple[int, int, int, str]]:
        """(leaf, rank, block, text); what is blank between two slots is at the end of the one
        and the start of the other."""
        out: list[tuple[int, int, int, str]] = []
        gap = -1
        for n, _, rank, block in self.placed:
            if self.leaves[n][0] == TEXT:
                out.append((n, rank, block, " " * (gap == block) + self.leaves[n][1]))
                gap = -1
            else:
                gap = block
                if out and out[-1][2] == block:
                    out[-1] = (*out[-1][:3], out[-1][3] + " ")
        return out


def joined(found: list[tuple[int, str]]) -> str:
    """Texts with their blocks: blocks in order, white space inside them single."""
    blocks: list[str] = []
    last = None
    for block, text in found:
        if block != last:
            blocks.append("")
            last = block
        blocks[-1] += text
    return " ".join(text for block in blocks if (text := spaced(block)))


def main_text(page: str, region: int = 3) -> str:
    """The text of one page by its marks alone: its narrowest region, at most ``region``."""
    found = Page(page).texts()
    wanted = min(region, max((rank for _, rank, _, _ in found), default=0))
    return joined([(block, text) for _, rank, block, text in found if rank >= wanted])


def digest(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def host_of(url: str | None) -> str:
    found = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


_INTS = pa.list_(pa.int32())
_SEEN = pa.list_(pa.struct([("item", pa.int32()), ("digest", pa.int64()), ("weight", pa.int64())]))
_PARSED = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("stream", pa.int64()),
    ("salt", pa.int32()), ("shape", pa.string()), ("content", pa.int64()), ("items", _INTS), ("blocks", _INTS),
    ("ranks", _INTS), ("texts", pa.list_(pa.string())), ("seen", _SEEN)])
_PARSED_COLUMNS = (
    "page_id long, url string, host string, stream long, salt int, shape string, content long, items array<int>, "
    "blocks array<int>, ranks array<int>, texts array<string>, seen array<struct<item:int,digest:long,weight:long>>")


def _parsed(page_id: int | None, url: str | None, page: str) -> tuple:
    read = Page(page)
    kept = [n for n, (symbol, _) in enumerate(read.leaves) if symbol != " "]
    symbols = [read.leaves[n][0] for n in kept]
    shape = fold(symbols)
    item = dict(zip(kept, spans(shape, symbols, groups=True) or ()))
    found = read.texts()
    seen: dict[tuple[int, int | None], int] = {}
    for n, rank, _, text in found:
        if (at := item.get(n, -1)) >= 0:
            plain = spaced(text)
            for key in ((at, None), (at, digest(plain))):
                seen[key] = seen.get(key, 0) + len(plain) * WEIGHTS[rank]
    written = write_shape(shape)
    stream = digest(written)
    return (page_id, url, host_of(url), stream, stream % SALTS[0], written,
            digest("\0".join(text for _, _, _, text in found)), [item.get(n, -1) for n, *_ in found],
            [block for _, _, block, _ in found], [rank for _, rank, _, _ in found],
            [text for *_, text in found], [(*key, weight) for key, weight in seen.items()])


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Every page parsed once: its folded stream, and its slots that are not beside the article
    with item, block, rank and text; ``seen`` has each item with its texts' digests."""

    def parse(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches((_parsed(*(x.as_py() for x in row)) for batch in stream for row in zip(*batch.columns)),
                           _PARSED, 128)

    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), clean_text("html"))
            .mapInArrow(parse, _PARSED_COLUMNS))


def page_shapes(parsed: DataFrame) -> DataFrame:
    """(host, salt, stream, shape, pages): each host's different token streams after folding."""
    return parsed.groupBy("host", "salt", "stream", "shape").agg(F.count(F.lit(1)).alias("pages"))


_WRAPPERS = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("shape", pa.string()), ("pages", pa.int64())])


def _merge(shapes: DataFrame) -> DataFrame:
    """One wrapper per host and salt, folding sorted streams one after another into the wrapper."""

    def merge(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            current, wrapper, count = None, (), 0
            for batch in stream:
                for host, salt, shape, pages in zip(*batch.columns):
                    key, shape = (host.as_py(), salt.as_py()), read_shape(shape.as_py())
                    if key != current:
                        if current is not None:
                            yield *current, write_shape(wrapper), count
                        current, wrapper, count = key, shape, 0
                    else:
                        wrapper = fold(list(align(wrapper, shape)))
                    count += pages.as_py()
            if current is not None:
                yield *current, write_shape(wrapper), count

        yield from batches(rows(), _WRAPPERS)

    return (shapes.repartition("host", "salt").sortWithinPartitions("host", "salt", "shape")
            .select("host", "salt", "shape", "pages")
            .mapInArrow(merge, "host string, salt int, shape string, pages long"))


def _joined(shapes: DataFrame) -> DataFrame:
    for salts in SALTS:
        shapes = _merge(shapes.withColumn("salt", F.pmod("salt", F.lit(salts))))
    return shapes.select("host", F.col("shape").alias("wrapper"), "pages")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, pages): the expression of every host; a URL without one has host ''."""
    return _joined(page_shapes(parsed_pages(pages)))


#: A text is its item's template if it stands there on so many pages, and on most of them.
TEMPLATE_PAGES = 3
#: Streams with more than this part of all pages are joined in as many parts.
PARTS = 1024
_PLACES = pa.schema([("host", pa.string()), ("stream", pa.int64()), ("pages", pa.int64()),
                     ("shape", pa.string()), ("at", _INTS)])
_BODIES = pa.schema([("of", pa.string()), ("opens", _INTS)])
_CHOSEN = pa.schema([("host", pa.string()), ("stream", pa.int64()), ("pages", pa.int64()), ("inside", _INTS),
                     ("templates", pa.list_(pa.struct([("item", pa.int32()), ("digest", pa.int64())])))])


def _aligned(shapes: DataFrame, known: DataFrame) -> DataFrame:
    """(host, stream, pages, shape, at): every stream aligned once with its host's wrapper."""

    def align_all(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(
            ((host.as_py(), number.as_py(), pages.as_py(), shape.as_py(),
              places(read_shape(wrapper.as_py()), read_shape(shape.as_py())))
             for batch in stream for host, number, pages, shape, wrapper in zip(*batch.columns)), _PLACES, 256)

    return (shapes.select("host", "stream", "pages", "shape").join(known.select("host", "wrapper"), "host")
            .select("host", "stream", "pages", "shape", "wrapper")
            .mapInArrow(align_all, "host string, stream long, pages long, shape string, at array<int>"))


def by_stream(rows: DataFrame, streams: DataFrame, total: int) -> DataFrame:
    """Rows of pages with what is known of their stream. A stream with more than 1/1024 of all
    pages is repeated as often as it has that many, and its rows choose one by a hash."""
    step = max(1, total // PARTS)
    parts = F.greatest(F.lit(1), F.expr(f"cast((pages + {step - 1}) div {step} as int)"))
    # Streams of more than ``step`` pages are fewer than 2 * PARTS.
    hot = streams.filter(F.col("pages") > step).select("host", "stream", parts.alias("_parts"))
    dealt = rows.join(F.broadcast(hot), ["host", "stream"], "left").withColumn(
        "_part", F.pmod(F.xxhash64("content", *(["page_id"] if "page_id" in rows.columns else [])),
                        F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    repeated = streams.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("pages")
    return dealt.join(repeated, ["host", "stream", "_part"], "left").drop("_part")


def _bodies(known: DataFrame, weights: DataFrame) -> DataFrame:
    """(of, opens): the body of every host with two different pages or more."""

    def choose(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(
            ((host.as_py(), body([item for item, _ in _flat(read_shape(wrapper.as_py()))],
                                 {x["slot"]: x["weight"] for x in own.as_py()}))
             for batch in stream for host, wrapper, own in zip(*batch.columns)), _BODIES, 256)

    # One row an item of the wrapper.
    own = weights.groupBy(F.col("host").alias("_host")).agg(
        F.collect_list(F.struct("slot", "weight")).alias("own"))
    return (known.join(own, known["host"] == own["_host"]).select("host", "wrapper", "own")
            .mapInArrow(choose, "of string, opens array<int>"))


def chosen_items(parsed: DataFrame, shapes: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """(host, stream, pages, inside, templates): the items of every stream that are its body, and
    the texts at its items that are template. Copies of a page count as one page."""
    aligned = stored(_aligned(shapes, known), "page-places")
    copies = parsed.groupBy("host", "stream", "content").agg(F.first("seen").alias("seen"))
    different = copies.groupBy("host").agg(F.count(F.lit(1)).alias("_pages")).filter("_pages > 1")
    found = (by_stream(copies, aligned.select("host", "stream", "pages", "at"), total)
             .select("host", "at", F.explode("seen").alias("seen"))
             .select("host", F.col("at")[F.col("seen.item")].alias("slot"), "seen.digest", "seen.weight")
             .filter("slot >= 0").groupBy("host", "slot", "digest")
             .agg(F.count(F.lit(1)).alias("pages"), F.sum("weight").alias("weight")))
    found = stored(found.join(different.select("host"), "host", "left_semi"), "page-texts")
    all_ = found.filter("digest IS NULL").select(
        "host", "slot", F.col("pages").alias("all"), F.col("weight").alias("whole"))
    templates = (found.filter(F.col("digest").isNotNull() & (F.col("pages") >= TEMPLATE_PAGES))
                 .join(all_, ["host", "slot"]).filter("2 * pages > all")
                 .select("host", "slot", "digest", "weight"))
    constant = templates.groupBy("host", "slot").agg(F.sum("weight").alias("constant"))
    weights = all_.join(constant, ["host", "slot"], "left").select(
        "host", "slot", (F.col("whole") - F.coalesce("constant", F.lit(0))).alias("weight"))
    listed = templates.groupBy(F.col("host").alias("in")).agg(F.collect_list(F.struct("slot", "digest")).alias("known"))
    bodies = _bodies(known, weights)

    def choose(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for host, number, pages, shape, at, opens, own in zip(*batch.columns):
                    at = at.as_py()
                    item = {slot: n for n, slot in enumerate(at) if slot >= 0}
                    yield (host.as_py(), number.as_py(), pages.as_py(),
                           inside(read_shape(shape.as_py()), at, opens.as_py() or []),
                           [(item[x["slot"]], x["digest"]) for x in own.as_py() or () if x["slot"] in item])

        yield from batches(rows(), _CHOSEN, 256)

    return (aligned.join(bodies, aligned["host"] == bodies["of"], "left")
            .join(listed, aligned["host"] == listed["in"], "left")
            .select("host", "stream", "pages", "shape", "at", "opens", "known")
            .mapInArrow(choose, "host string, stream long, pages long, inside array<int>, "
                                "templates array<struct<item:int,digest:long>>"))


def article(found: list[tuple[int, int, int, str]], inside: list[int] | None,
            templates: set[tuple[int, int]]) -> str:
    """The text of a page from its (item, rank, block, text).

    The body's slots are read, of these the narrowest region. A page without text there, or
    with an article or main element elsewhere only, is read by its marks. Template is left out
    of parts that no article or main element marks, unless it is most of the text.
    """
    narrowest = max((rank for _, rank, _, _ in found), default=0)
    own = set(inside) if inside is not None else ()
    chosen = [x for x in found if x[0] in own]
    wanted = max((rank for _, rank, _, _ in chosen), default=-1)
    if wanted < 0 or wanted < narrowest and narrowest >= 2:
        chosen, wanted = found, narrowest
    chosen = [x for x in chosen if x[1] >= wanted]
    if wanted < 2 and templates:
        constant = [(x[0], digest(spaced(x[3]))) in templates for x in chosen]
        size = [len(x[3].strip()) for x in chosen]
        if 2 * sum(n for n, same in zip(size, constant) if same) <= sum(size):
            chosen = [x for x, same in zip(chosen, constant) if not same]
    return joined([(block, text) for _, _, block, text in chosen])


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the article of every page.

    A NULL or empty page has an empty text; pages without host share a wrapper; repeated rows
    are read one by one; other columns are dropped. Pages are parsed once.
    """
    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for row in zip(*batch.columns):
                    page_id, url, items, ranks, blocks, texts, inside_, own = (x.as_py() for x in row)
                    yield page_id, url, article(list(zip(items, ranks, blocks, texts)), inside_,
                                                {(x["item"], x["digest"]) for x in own or ()})

        yield from batches(rows(), _TEXTS, 256)

    parsed = stored(parsed_pages(pages), "page-slots")
    shapes = stored(page_shapes(parsed), "page-shapes")
    known = stored(_joined(shapes), "host-wrappers")
    total = shapes.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    chosen = stored(chosen_items(parsed, shapes, known, total), "page-items")
    rows = parsed.select("page_id", "url", "host", "stream", "content", "items", "ranks", "blocks", "texts")
    return (by_stream(rows, chosen, total)
            .select("page_id", "url", "items", "ranks", "blocks", "texts", "inside", "templates")
            .mapInArrow(read, "page_id long, url string, text string"))
