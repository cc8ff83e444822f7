"""A tolerant reader of HTML pages: text blocks with the path of elements that hold them."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from typing import NamedTuple

# Element kinds (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noembed xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("option tbody td tfoot th thead tr".split())
# An opening tag ends an open element of these kinds, up to the element that holds them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# What does not belong to an article: elements, roles, and words of class and id names.
ASIDE_TAGS = frozenset(
    "nav footer aside form button select datalist dialog template svg math object audio video canvas map".split()
) | RAW
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead ad ads advert adverts advertisement sponsor "
    "sponsored promo banner notice notices cookie cookies consent gdpr comment comments reply replies respond disqus share "
    "sharing social related recommended newsletter subscribe signup login popup modal overlay pagination pager toolbar".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true)""", re.I)


# Elements that divide a page. Of equal siblings the k-th is "name:k" in a place, so that it is an element of its own.
CONTAINERS = frozenset("div section article main aside nav form header footer center fieldset details dialog figure hgroup".split())
DEEPEST = 64  # steps of a path; elements further in count as part of the element there, and their text belongs to it


class Block(NamedTuple):
    """A run of text: its element path, whether an aside holds it, the text with references decoded, and its place.

    The place is the path with containers numbered among equal siblings.
    """

    path: tuple[str, ...]
    asides: tuple[bool, ...]
    text: str
    place: tuple[str, ...]


def page_blocks(source: str) -> tuple[list[Block], dict[tuple[str, ...], int]]:
    """Text blocks in page order, and how often each place has an element."""
    blocks: list[Block] = []
    seen: dict[tuple[str, ...], int] = {}
    names: list[str] = []  # open elements
    opened: dict[str, int] = defaultdict(int)  # how many of a name are open
    # per open element, and outside all: path, place, asides, steps up to the innermost block element, article around it
    states: list[tuple[tuple[str, ...], tuple[str, ...], tuple[bool, ...], int, bool]] = [((), (), (), 0, False)]
    siblings: list[dict[str, int]] = [{}]  # containers inside the open element so far, by step
    held: list[str] = []
    at, end = 0, len(source)

    def flush() -> None:
        nonlocal held
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                # inline elements do not make slots: the block belongs to the innermost block element
                path, place, asides, depth, _ = states[-1]
                blocks.append(Block(path[:depth], asides[:depth] + (any(asides[depth:]),), text, place[:depth]))
            held = []

    def last(name: str) -> int:
        """Place of the innermost open element of a name that is open."""
        place = len(names) - 1
        while names[place] != name:
            place -= 1
        return place

    def pop_to(size: int) -> None:
        for name in names[size:]:
            opened[name] -= 1
        del names[size:], states[size + 1 :], siblings[size + 1 :]

    while at < end:
        match = _TOKEN.match(source, at)
        at = match.end()
        name = match[2] or match[5]
        if name is None:
            piece = match[0]
            if piece[0] != "<" or piece == "<":
                held.append(piece)
            continue
        name = name.lower()
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if name == "br":
            held.append(" ")
        elif closing:
            if opened[name]:
                if name in BLOCK:
                    flush()
                pop_to(last(name))
            elif name == "p":
                flush()
        elif name in RAW:
            # nothing inside is markup; without an end the rest of the page belongs to it
            shut = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            at = shut.end() if shut else end
            held.append(" " if name not in ("script", "style") else "")
        else:
            if name in BLOCK:
                flush()
            if name in CLOSES_P and opened["p"]:
                size = last("p")
                if not any(x in ("td", "th", "button", "object") for x in names[size:]):
                    pop_to(size)
            if name in SIBLINGS:
                ended, holders = SIBLINGS[name]
                for i in range(len(names) - 1, -1, -1):
                    if names[i] in holders:
                        break
                    if names[i] in ended:
                        pop_to(i)
            if name in VOID:
                continue
            step, aside = _element(name, attributes)
            path, place, asides, depth, in_article = states[-1]
            if name == "header":  # a page's header, not that of an article
                aside = aside or not in_article
            if len(path) < DEEPEST:
                number = 1
                if name in CONTAINERS:
                    number = siblings[-1][step] = siblings[-1].get(step, 0) + 1
                path, place, asides = (*path, step), (*place, step if number == 1 else f"{step}:{number}"), (*asides, aside)
                if name in BLOCK:
                    depth = len(path)
                    seen[place] = seen.get(place, 0) + 1
            elif aside:
                asides = (*asides[:-1], True)
            names.append(name)
            opened[name] += 1
            states.append((path, place, asides, depth, in_article or name in ("article", "main")))
            siblings.append({})
            if attributes.endswith("/") and name not in BLOCK:
                pop_to(len(names) - 1)
    flush()
    return blocks, seen


_elements: dict[tuple[str, str], tuple[str, bool]] = {}


def _element(name: str, attributes: str) -> tuple[str, bool]:
    """A step of a path (name with class and id, digits as "0"), and whether the element is an aside."""
    key = (name, attributes)
    found = _elements.get(key)
    if found is None:
        step, aside = name, name in ASIDE_TAGS
        if attributes.strip():
            for kind, *values in _NAMES.findall(attributes):
                value = "".join(values).lower()
                words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()))
                if kind.lower() == "role":
                    aside = aside or bool(words & ASIDE_ROLES)
                else:
                    step += f"{'.' if kind.lower() == 'class' else '#'}{re.sub(r'[0-9]+', '0', value)}"
                    aside = aside or (name not in ("html", "body") and bool(words & ASIDE_WORDS))
            aside = aside or bool(_HIDDEN.search(attributes))
        found = step, aside
        if len(_elements) > 50_000:
            _elements.clear()
        _elements[key] = found
    return found
