"""Wrappers of web pages: union-free regular expressions over block structure, and their alignment.

A page becomes a tree of block elements whose leaves are text slots; inline markup dissolves into the
text. Neighbours of one label, and neighbouring runs of up to four labels that repeat, fold into one
repeated item. Two wrappers are aligned item by item: what both have merges, what one lacks becomes
optional, and a slot whose text differs becomes a free text slot. Aligning all pages of a host, in any
number of steps, gives the host's wrapper.

A wrapper node is a list ``[label, repeated, optional, pages, text, items]``; ``text`` is a hash while
all pages agree on it, otherwise None, and ``pages`` are up to ``SUPPORT`` digests of the distinct pages
that do. Pages of equal text beside what ``is_aside`` drops are one page. A page node is ``[label, instances]``, an instance being a list
of page nodes, or a string for the label ``#``.
"""

from __future__ import annotations

import functools
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import xxhash

TEXT = "#"
MAX_PERIOD = 4
SUPPORT = 3
# Elements below this depth dissolve into the one at it: their blocks and asides count, their nesting does not.
MAX_DEPTH = 48
# Item lists are compared pair by pair while that takes no more steps than this, else by next places.
COMPARED = 1_000_000
# A tag, comment or text at once where quotes hold no angle brackets; all else starts with a bare ``<``.
TOKEN = re.compile(
    r"<(/?)([a-z][a-z0-9:-]*+)([^<>\"']*+(?:\"[^\"<>]*+\"[^<>\"']*+|'[^'<>]*+'[^<>\"']*+)*+)>|<!--|[^<]++|<",
    re.IGNORECASE,
)
NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*+)", re.IGNORECASE)
STOP = re.compile("[>\"']")
RAW = {t: re.compile(rf"</{t}\s*+>", re.IGNORECASE) for t in "script style noscript template svg iframe object textarea select".split()}
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+")
# Elements that make blocks, those that end an open paragraph or sibling, and those without content.
BLOCKS = set(
    "html head title body div p article section main nav header footer aside ul ol li table thead tbody tfoot tr td th "
    "h1 h2 h3 h4 h5 h6 form fieldset blockquote pre figure figcaption dl dt dd address details summary dialog menu hr button label".split()
)
VOID = {"hr"}
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "body": {"head", "title"},
}
# Elements, and words in class or role, that mark what is not the main text.
ASIDE_TAGS = set("head title nav header footer aside form fieldset button label dialog menu".split())
ADVERT_WORDS = set("ad ads advert advertisement adverts sponsor sponsored promo".split())
ASIDE_WORDS = ADVERT_WORDS | set(
    "banner nav navbar navigation menu sidebar footer header cookie "
    "cookies consent notice notices alert popup modal newsletter subscribe signup comment comments reply replies disqus share "
    "sharing social related breadcrumb breadcrumbs pagination complementary contentinfo search login".split()
)
MAIN_TAGS = ("article", "main")
NEVER_ASIDE = {"html", "body", *MAIN_TAGS}  # their classes speak of the page or of parts of it
MAIN_WORDS = set("article content post entry main story".split())
# Elements that hold other blocks and no text of their own; a part of a class word or an id marks only these.
CONTAINERS = set("html body div section article main ul ol dl table thead tbody tfoot tr td figure details blockquote".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HIDDEN = "hidden"


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'").lower())
    return found


def _label(tag: str, attributes: str) -> str:
    """The element with its class and role words, without such as hold digits, which name single pages.

    An id names one element and counts only where it is an aside word by itself, on a container.
    """
    if not attributes or attributes.isspace():
        return tag
    given = _attributes(attributes)
    words = {w for w in f"{given.get('class', '')} {given.get('role', '')}".split() if re.fullmatch("[a-z_-]+", w)}
    if given.get("id") in ASIDE_WORDS and tag in CONTAINERS:
        words.add(given["id"])
    if HIDDEN in given or re.search(r"display\s*:\s*none", given.get("style", "")):
        words.add(HIDDEN)
    return ".".join([tag, *sorted(words)])


def tokens_of(source: str) -> Iterator[tuple[str, str, str] | str]:
    """Tags as (``/`` or empty, name, attributes), and pieces of text, in time linear in the page.

    A quote that never closes ends with its tag at the next ``>``; so does a tag that never ends
    outside of quotes. Comments, declarations and raw elements are left out.
    """
    at, n = 0, len(source)
    last_end, last = source.rfind(">"), {q: source.rfind(q) for q in "\"'"}
    dead: set[int] = set()  # quotes from which, outside of quotes, no tag end follows

    def end_of(start: int) -> int:
        seen, j = [], start
        while (stop := STOP.search(source, j)) and stop.start() not in dead:
            k = stop.start()
            if source[k] == ">":
                return k
            if k >= last[source[k]]:
                break
            seen.append(k)
            j = source.index(source[k], k + 1) + 1
        dead.update(seen)
        return source.find(">", start)

    while at < n:
        match = TOKEN.match(source, at)
        piece, tag = match.group(0), match.group(2)
        if tag is None and piece != "<":
            if piece == "<!--":
                end = source.find("-->", at + 4)
                at = n if end < 0 else end + 3
            else:
                yield piece
                at = match.end()
            continue
        if tag is None:
            name = NAME.match(source, at) if at < last_end else None
            if name:
                end = end_of(name.end())
                token = name.group(1), name.group(2).lower(), source[name.end() : end]
                at = end + 1
            else:
                declared = at < last_end and source[at + 1] in "!?/"
                if not declared:
                    yield piece
                at = source.find(">", at) + 1 if declared else at + 1
                continue
        else:
            token, at = (match.group(1), tag.lower(), match.group(3)), match.end()
        if not token[0] and token[1] in RAW:
            if not token[2].endswith("/") or token[1] in ("script", "style", "textarea"):
                closed = RAW[token[1]].search(source, at)
                at = closed.end() if closed else n
            continue
        if token[1] not in RAW:
            yield token


def parse(source: str) -> list:
    """The page as one page node, unfolded: every child list holds nodes in order."""
    root: list = ["", []]
    # per open element: its tag, the node its blocks go to, and whether its text is left out
    stack: list[tuple[str, list, bool]] = [("", root, False)]
    opened: Counter[str] = Counter()
    texts: list[str] = []
    advert: tuple[str, int] | None = None  # an inline element whose text is left out, and the depth it stands at
    nested = 0

    def flush() -> None:
        if texts:
            joined = " ".join(html.unescape("".join(texts)).split())
            if joined and not stack[-1][2]:
                stack[-1][1][1].append([TEXT, joined])
            texts.clear()

    def close() -> None:
        nonlocal advert
        opened[stack.pop()[0]] -= 1
        if advert and len(stack) < advert[1]:
            advert = None

    for token in tokens_of(source):
        if isinstance(token, str):
            if not advert:
                texts.append(token)
            continue
        end, tag, attributes = token
        if tag not in BLOCKS:
            if advert and tag == advert[0]:
                nested += -1 if end else not attributes.endswith("/")
                if not nested:
                    advert = None
            elif not advert and not end and attributes and not attributes.endswith("/"):
                words = set(_label(tag, attributes).split(".")[1:])
                if words & ADVERT_WORDS or HIDDEN in words:
                    advert, nested = (tag, len(stack)), 1
            if tag == "br":
                texts.append(" ")
            continue
        flush()
        if end:
            if opened[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in ENDS.get(tag, ())):
            close()
        label = _label(tag, attributes)
        silent = stack[-1][2]
        if len(stack) > MAX_DEPTH:
            node, silent = stack[-1][1], silent or is_aside(label)
        else:
            node = [label, []]
            stack[-1][1][1].append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append((tag, node, silent))
            opened[tag] += 1
    flush()
    return root


def fold(nodes: list) -> list:
    """Child nodes as items ``[label, instances]``; repeats of up to ``MAX_PERIOD`` labels become one item."""
    items: list = []
    for label, content in nodes:
        instance = content if label == TEXT else fold(content)
        if items and items[-1][0] == label and label != TEXT:
            items[-1][1].append(instance)
        else:
            items.append([label, [instance]])
    for period in range(2, MAX_PERIOD + 1):
        folded: list = []
        at = 0
        while at < len(items):
            labels = [i[0] for i in items[at : at + period]]
            times = 1
            while len(labels) == period and [i[0] for i in items[at + times * period : at + (times + 1) * period]] == labels:
                times += 1
            if times > 1:
                folded.append(["(" + " ".join(labels) + ")", [items[at + k * period : at + (k + 1) * period] for k in range(times)]])
                at += times * period
            else:
                folded.append(items[at])
                at += 1
        items = folded
    return items


def page_digest(items: list) -> int:
    return xxhash.xxh64_intdigest("\n".join(extract(items, [], None))) >> 16


def wrapper_of(items: list, page: int | None = None) -> list:
    """The wrapper of one page's items, or of a part of the page with the digest ``page``."""
    page = page_digest(items) if page is None else page
    result = []
    for label, instances in items:
        if label == TEXT:
            result.append([label, 0, 0, [page], xxhash.xxh64_intdigest(instances[0]), []])
            continue
        body = wrapper_of(instances[0], page)
        for other in instances[1:]:
            body = align(body, wrapper_of(other, page))
        result.append([label, int(len(instances) > 1), 0, [], None, body])
    return result


def matched(left: list, right: list) -> Iterator[tuple[int | None, int | None]]:
    """Pairs of places of equal labels in order; None on the side that lacks the item."""
    a, b = [x[0] for x in left], [x[0] for x in right]
    if a == b:
        yield from ((k, k) for k in range(len(a)))
        return
    if len(a) * len(b) > COMPARED:
        yield from _next_places(a, b)
        return
    for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal":
            yield from zip(range(i, j), range(k, m), strict=True)
        else:
            yield from ((x, None) for x in range(i, j))
            yield from ((None, y) for y in range(k, m))


def _next_places(a: list, b: list) -> Iterator[tuple[int | None, int | None]]:
    """As ``matched``, each item of ``b`` with the next equal one of ``a`` that is near enough to skip to."""
    places: dict[str, list[int]] = {}
    for i, label in enumerate(a):
        places.setdefault(label, []).append(i)
    i = 0
    for j, label in enumerate(b):
        known = places.get(label, [])
        k = bisect_left(known, i)
        if k < len(known) and known[k] - i <= 1 + len(b) - j:
            yield from ((x, None) for x in range(i, known[k]))
            yield known[k], j
            i = known[k] + 1
        else:
            yield None, j
    yield from ((x, None) for x in range(i, len(a)))


def align(left: list, right: list) -> list:
    """The least wrapper that both item lists fit."""
    result = []
    for i, j in matched(left, right):
        if i is None or j is None:
            only = left[i] if j is None else right[j]
            result.append([only[0], only[1], 1, *only[3:]])
            continue
        a, b = left[i], right[j]
        text = a[4] if a[4] == b[4] else None
        pages = a[3] if text is None or a[3] == b[3] else sorted({*a[3], *b[3]})[:SUPPORT]
        result.append([a[0], a[1] | b[1], a[2] | b[2], pages if text is not None else [], text, align(a[5], b[5])])
    return result


def _words(label: str) -> tuple[str, set[str]]:
    """Tag and words of an element; the label of a folded group stands for no element and has none.

    A container also has the parts of its words, as in ``site-footer``; on a heading or paragraph a word
    counts as a whole.
    """
    if label.startswith("("):
        return label, set()
    tag, *words = label.split(".")
    parts = {p for w in words for p in re.split("[-_]", w)} if tag in CONTAINERS else set()
    return tag, {*words, *parts}


@functools.lru_cache(1 << 16)
def is_aside(label: str) -> bool:
    tag, words = _words(label)
    return HIDDEN in words or tag in ASIDE_TAGS or (tag not in NEVER_ASIDE and bool(words & ASIDE_WORDS))


def _has(items: list, wanted) -> bool:
    return any(not is_aside(x[0]) and (wanted(x[0]) or _has(x[5], wanted)) for x in items)


MAIN_TESTS = [
    *(lambda label, t=t: label.split(".")[0] == t for t in MAIN_TAGS),
    lambda label: bool(_words(label)[1] & MAIN_WORDS) and _words(label)[0] not in ("html", "body"),
]


@functools.lru_cache(1 << 16)
def is_marked(label: str) -> bool:
    """Whether an element calls itself main."""
    return any(wanted(label) for wanted in MAIN_TESTS)


def choose(wrapper: list) -> int | None:
    """Which of ``MAIN_TESTS`` marks the main part of a wrapper; None when nothing does."""
    return next((k for k, wanted in enumerate(MAIN_TESTS) if _has(wrapper, wanted)), None)


@dataclass
class Element:
    """An element of a page, or a text of it (``label`` ``#``), beside its place in the wrapper.

    ``fixed`` texts are the same on all pages of the host; ``mass`` is the length of the others below.
    """

    label: str
    text: str = ""
    fixed: bool = False
    mass: int = 0
    children: list[Element] = field(default_factory=list)

    @property
    def tag(self) -> str:
        return self.label.split(".")[0]


def elements(items: list, wrapper: list, support: int = SUPPORT) -> list[Element]:
    """What of a page no aside holds, in page order; folded groups are taken apart.

    A text is fixed if ``support`` distinct pages (at most ``SUPPORT``) of the host have it and none another.
    """
    made: list[Element] = []
    places = {j: i for i, j in matched(wrapper, items) if i is not None and j is not None}
    for j, (label, instances) in enumerate(items):
        node = wrapper[places[j]] if j in places else [label, 0, 1, [], None, []]
        if label == TEXT:
            fixed = len(node[3]) >= support and node[4] is not None
            made.append(Element(label, instances[0], fixed, 0 if fixed else len(instances[0])))
        elif label.startswith("("):
            for instance in instances:
                made += elements(instance, node[5], support)
        elif not is_aside(label):
            for instance in instances:
                below = elements(instance, node[5], support)
                made.append(Element(label, mass=sum(e.mass for e in below), children=below))
    return made


def regions(page: list[Element]) -> list[Element]:
    """The elements that are the main part of a page: where its text differs from the host's other pages.

    From the outermost element down, as long as one element holds that text: half of it if the element
    calls itself main, else four fifths, with no headings or paragraphs beside it. Of several main
    elements side by side, such as teasers beside an article, those count that hold half as much as the
    largest. Where no element holds it, the main elements below do if a quarter of it is theirs.
    """
    here = Element("", mass=sum(e.mass for e in page), children=page)
    while here.mass:
        own = [e for e in here.children if e.label != TEXT and e.mass]
        best = max(own, key=lambda e: (e.mass, is_marked(e.label)), default=None)
        if best is None or 2 * best.mass < here.mass:
            break
        if is_marked(best.label):
            return [e for e in own if is_marked(e.label) and 2 * e.mass >= best.mass]
        loose = any(e.mass and (e.label == TEXT or e.tag not in CONTAINERS) for e in here.children)
        if best.tag not in CONTAINERS or loose or 5 * best.mass < 4 * here.mass:
            break
        here = best
    outermost: list[Element] = []
    rest = list(reversed(here.children))
    while rest:
        e = rest.pop()
        if is_marked(e.label):
            outermost.append(e)
        else:
            rest += reversed(e.children)
    largest = max((e.mass for e in outermost), default=0)
    chosen = [e for e in outermost if e.mass and 2 * e.mass >= largest]
    return chosen if chosen and 4 * sum(e.mass for e in chosen) >= here.mass else [here]


def _texts(element: Element, fixed: bool) -> Iterator[str]:
    rest = [element]
    while rest:
        e = rest.pop()
        if e.label == TEXT and (fixed or not e.fixed):
            yield e.text
        rest += reversed(e.children)


def main_texts(items: list, wrapper: list, support: int = SUPPORT) -> list[str]:
    """The blocks of a page's main part, in page order: all of an element that calls itself main, else
    those that are not the same all over the host."""
    page = elements(items, wrapper, support)
    return [t for e in regions(page) for t in _texts(e, is_marked(e.label))]


def extract(items: list, wrapper: list, test: int | None, support: int = SUPPORT) -> list[str]:
    """The texts of a page on slots of its wrapper that no aside holds: below elements that ``MAIN_TESTS``
    number ``test`` marks, or without one, those that are not fixed."""

    def walk(own: list[Element], inside: bool) -> Iterator[str]:
        for e in own:
            if e.label == TEXT and inside and not (test is None and e.fixed):
                yield e.text
            yield from walk(e.children, inside or (test is not None and e.label != TEXT and MAIN_TESTS[test](e.label)))

    return list(walk(elements(items, wrapper, support), test is None))
