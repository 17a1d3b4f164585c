"""Main text of pages by wrappers: union-free regular expressions inferred from pages of one host.

A host's wrapper begins as the token stream of one of its pages, kept as a tree: tags nest, and the tokens between a tag
and its end are a sequence of labels (tag and first class or id). Each further page is aligned with it, level by level.
Where they mismatch, the wrapper is made more general, and never by a choice between two expressions:

* texts that differ become a text slot;
* labels that stand once on one side and several times on the other become a repeated group (groups of up to PERIOD
  labels that follow each other are folded first);
* labels that only one side has become optional;
* labels between the common beginning and end of sequences of more than LONG items become one repeated group of optional
  labels, in which classes are no longer told apart beyond LABELS different ones;
* elements at the level that brings a wrapper above NODES parts become slots of any content, save those around an
  `article` or `main`, as do elements below DEPTH others. So neither a page with very many mixed children nor a host with
  very many templates makes alignment quadratic or lets a wrapper grow without end.

What slots and groups in any order no longer tell apart is settled exactly by a table of places, for the hosts that have
them: an element's place is its item in the wrapper, or below slots and such groups its label in its parent's place. Over
all different pages, Spark counts for every place the pages that have it, how often a page has it, and the varying text.
The main part and the template's texts are then found in that table by the rules below, without bounds on labels,
elements or depth.

Every different page of a host takes part. A page's own wrapper, with texts as digests, is made where the page is read;
wrappers are joined along the binary tree of the pages' hashes: shares of large hosts first, then what the shares gave. So
the order of joining depends on the pages alone, not on copies, partitions or the size of a share, and no task gets a
large host as a whole.

The wrapper then knows which parts vary and which belong to the template. The main part is the element whose slots hold
the articles: an `article` or `main` element where there is one, else the deepest element with most of the varying text;
where pages have it at different places, all of them. A page is read by walking it along its host's wrapper to the main
part. There, everything is kept but elements known by tag or name as menus, adverts, notices, forms, comments and the
like, and texts that the template repeats word for word on all pages that have their element, at least CONSTANT
different ones. A page that the wrapper does not fit is judged by its own elements in the same way.

Text is cut into blocks at block elements; a line break is white space. Null and empty pages have an empty text. Pages
without a host are one host. Pages may repeat; equal pages count once in the inference. All pages are read whole.
"""

from __future__ import annotations

import json
from base64 import b85encode
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .markup import INLINE, RAW, Element, decoded, parse
from .shared import store
from .urlrules import host_of

SHARE_PAGES = 128  # a host with more rows is joined in shares of about so many
STEP = 6  # so many halvings of a host per level of joining
SEEN = 200_000  # a task remembers so many pages, to leave out their copies before the shuffle; the rest go after it
PERIOD = 3
LONG = 64
LABELS = 100
NODES = 10_000
CONSTANT = 4
DEPTH = 60
SHARE = 0.6
#: Elements that never hold main text, by tag and by words of class, id or role.
OUT_TAGS = {"nav", "footer", "aside", "form", "button", "input", "head", "dialog", "menu", "object", "embed", "audio", "video", "canvas", *RAW}
OUT_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "contentinfo", "cookie",
    "cookies", "consent", "copyright", "disqus", "footer", "form", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "pagination", "popup", "promo", "promotion", "related", "respond", "search", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary", "alert", "replies",
}
MAIN_TAGS, MAIN_NAMES = {"article", "main"}, {"article", "main", "content", "post", "entry", "story"}


def is_out(element: Element, in_main: bool) -> bool:
    if element.tag in OUT_TAGS or element.tag == "header" and not in_main:
        return True
    if element.tag in MAIN_TAGS or element.tag in ("html", "body", "h1"):
        return False
    return not OUT_NAMES.isdisjoint(element.names) or not in_main and "header" in element.names


# ---- inference ----------------------------------------------------------------------------------
# A wrapper is a dict: l label, q one of 1 ? + *, and either k (its items) or, for a text, t (its digest, null for a slot).
# n counts the pages that had it, c the characters of its texts; g marks a group of labels, which has the label * if its
# labels come in any order; s marks an element that is a slot, with c; i is the place of an item.
ANY = "*"


def _flat(element: Element) -> list[tuple[str, object]]:
    """Labelled children; neighbouring texts are one, blank ones none, inline markup is text."""
    out: list = []
    text: list[str] = []

    def close():
        joined = decoded("".join(text))
        text.clear()
        if joined:
            out.append(("#text", joined))

    for child in element.children:
        if isinstance(child, str):
            text.append(child)
        elif child.tag in INLINE and child.tag != "a":
            text.append(" " if child.tag == "br" else _inner(child))
        else:
            close()
            out.append((child.label, child))
    close()
    return out


def _inner(element: Element) -> str:
    parts, todo = [], [element]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            parts.append(at)
        elif at.tag == "br":
            parts.append(" ")
        elif at.tag not in RAW:
            todo.extend(reversed(at.children))
    return "".join(parts)


def _folded(children: list[tuple[str, object]]) -> list[tuple[str, list[list]]]:
    """Runs of equal neighbouring groups as (labels, [group, ..]); groups are the shortest that repeat."""
    labels, out, i = [c[0] for c in children], [], 0
    while i < len(children):
        period, times = 1, 1
        for size in range(1, PERIOD + 1):
            n = 1
            while labels[i + n * size:i + (n + 1) * size] == labels[i:i + size] and i + (n + 1) * size <= len(labels):
                n += 1
            if n > 1:
                period, times = size, n
                break
        out.append((" ".join(labels[i:i + period]), [[c[1] for c in children[i + k * period:i + (k + 1) * period]] for k in range(times)]))
        i += period * times
    return out


def _digest(text: str) -> str:
    return b85encode(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()).decode()


def _new(label: str, group: list, depth: int) -> dict:
    """The wrapper of one group: an item per label, in a sequence if there are several."""
    parts = []
    for name, child in zip(label.split(" "), group):
        if isinstance(child, str):
            parts.append({"l": "#text", "q": "1", "t": _digest(child), "n": 1, "c": len(child)})
        else:
            node = {"l": name, "q": "1", "k": [], "n": 1, "o": int(is_out(child, True)), "a": int(child.tag == "a")}
            if depth < DEPTH and child.tag not in RAW:
                for key, groups in _folded(_flat(child)):
                    node["k"].append(_item(key, groups, depth + 1))
            elif child.tag not in RAW and child.children:
                node |= {"s": 1, "c": len(decoded(_inner(child)))}
            parts.append(node)
    return parts[0] if len(parts) == 1 else {"l": label, "q": "1", "k": parts, "n": 1, "g": 1}


def _item(label: str, groups: list[list], depth: int) -> dict:
    item = _new(label, groups[0], depth)
    for group in groups[1:]:
        item = _join(item, _new(label, group, depth), True)
    if len(groups) > 1:
        item["q"] = "+"
    return item


def _quantifier(a: str, b: str) -> str:
    several, optional = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return ("*" if optional else "+") if several else ("?" if optional else "1")


def _join(a: dict, b: dict, same: bool = False) -> dict:
    """The most special wrapper that fits what `a` and `b` fit; their labels are equal. `same`: they have the same pages."""
    out = {"l": a["l"], "q": _quantifier(a["q"], b["q"]), "n": max(a["n"], b["n"]) if same else a["n"] + b["n"]}
    if "k" not in a:
        return out | {"t": a["t"] if a["t"] == b["t"] else None, "c": a["c"] + b["c"]}
    for flag in "oag":
        if flag in a:
            out[flag] = min(a[flag], b[flag])
    if "s" in a or "s" in b:
        return out | {"k": [], "s": 1, "c": _chars(a) + _chars(b)}
    if a["l"] == ANY:
        return out | {"k": _any_order(a["k"] + b["k"], same)}
    if "g" in a:  # groups have the same labels throughout
        return out | {"k": [_join(x, y, same) for x, y in zip(a["k"], b["k"])]}
    return out | {"k": _aligned(a["k"], b["k"], same)}


def _aligned(a: list[dict], b: list[dict], same: bool) -> list[dict]:
    """Two sequences of items by a longest common subsequence of labels; items of one side only become optional."""
    if max(len(a), len(b)) > LONG or any(k["l"] == ANY for k in a + b):
        return _generalized(a, b, same)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["l"] == b[j]["l"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i]["l"] == b[j]["l"]:
            out.append(_join(a[i], b[j], same))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(a[i] | {"q": _quantifier(a[i]["q"], "?")})
            i += 1
        else:
            out.append(b[j] | {"q": _quantifier(b[j]["q"], "?")})
            j += 1
    return out if len(out) <= LONG else _generalized(a, b, same)


def _generalized(a: list[dict], b: list[dict], same: bool) -> list[dict]:
    """Two long sequences: the common beginning and end item by item, all between as a group in any order."""
    least, head, tail = min(len(a), len(b)), 0, 0
    while head < least and a[head]["l"] == b[head]["l"] != ANY:
        head += 1
    while tail < least - head and a[-1 - tail]["l"] == b[-1 - tail]["l"] != ANY:
        tail += 1
    out = [_join(x, y, same) for x, y in zip(a[:head], b)]
    between = [_any_order(side[head:len(side) - tail], True) for side in (a, b)]
    if any(between):
        items = _any_order(between[0] + between[1], same)
        out.append({"l": ANY, "q": "*", "n": max(k["n"] for k in items), "g": 1, "k": items})
    return out + [_join(x, y, same) for x, y in zip(a[len(a) - tail:], b[len(b) - tail:])]


def _any_order(items: list[dict], same: bool) -> list[dict]:
    """One item per label, any number of times, groups taken apart; beyond LABELS of them, one per tag with a class."""
    todo = [x for k in items for x in (k["k"] if "g" in k else (k,))]
    wide = any(k["l"].endswith(".*") for k in todo)
    while True:
        found: dict[str, dict] = {}
        for k in todo:
            label = k["l"].partition(".")[0] + ".*" if wide and "." in k["l"] else k["l"]
            k = k | {"l": label, "q": "*"}
            found[label] = _join(found[label], k, same) if label in found else k
        if wide or len(found) <= LABELS:
            return list(found.values())
        wide = True


def _chars(node: dict) -> int:
    return sum(map(_chars, node["k"])) if "k" in node and "s" not in node else node["c"]


def _holds_main(node: dict) -> bool:
    return any(k["l"].partition(".")[0] in MAIN_TAGS or "k" in k and _holds_main(k) for k in node["k"])


def _bounded(wrapper: dict) -> int:
    """Makes elements of a wrapper slots where it has more than NODES parts; the number of its parts."""
    def below(level):
        return [x for node in level if "k" in node and "g" not in node for k in node["k"] for x in (k, *(k["k"] if "g" in k else ()))]

    level, size = [wrapper], 0
    while level:
        size += len(level)
        if size + len(below(level)) > NODES:
            for node in level:
                if node.get("k") and "g" not in node and node is not wrapper and not _holds_main(node):
                    node.update(c=_chars(node), k=[], s=1)
        level = below(level)
    return size


def of_page(page: str) -> dict:
    """The wrapper of one page: its own tree."""
    return {"l": "", "q": "1", "n": 1, "k": [_item(key, groups, 0) for key, groups in _folded(_flat(parse(page)))]}


def infer(pages: list[str]) -> dict:
    """The wrapper of some pages, joined in their order, with its main part marked (m)."""
    wrapper = reduce(_join, map(of_page, pages))
    _bounded(wrapper)
    _mark(wrapper)
    return wrapper


def _joined(keyed: Iterable[tuple[int, str]]) -> tuple[int, dict]:
    """Wrappers (JSON) in order of their keys, joined along the binary tree of the keys' bits, with the first key. Equal
    keys are the same page."""
    stack: list[tuple[int, dict, int]] = []  # the last: no fewer than its parts

    def close():
        (first, a, m), (_, b, n) = stack[-2:]
        wrapper, size = _join(a, b), m + n
        stack[-2:] = [(first, wrapper, size if size <= NODES else _bounded(wrapper))]

    for key, text in keyed:
        if stack and stack[-1][0] == key:
            continue
        while len(stack) > 1 and stack[-2][0] ^ stack[-1][0] < stack[-1][0] ^ key:
            close()
        stack.append((key, json.loads(text), text.count('"l": ')))
    while len(stack) > 1:
        close()
    return stack[0][:2]


def _mark(wrapper: dict) -> bool:
    """Marks the main part, and the same place where other pages have it in another order. Is the wrapper without slots
    and groups in any order, where the main part may be?"""
    main, order = _main_part(wrapper)
    main["m"] = 1
    paths: dict[int, tuple] = {}
    for node, parent in order:
        paths[id(node)] = paths.get(id(parent), ()) + (() if "g" in node else (node["l"],))
    same = [n for n, _ in order if "k" in n and "g" not in n and paths[id(n)] == paths[id(main)]]
    if sum(n["n"] for n in same) <= wrapper["n"]:  # no page has two of them
        for n in same:
            n["m"] = 1
    return not any(n["l"] == ANY or "s" in n and not n.get("o") for n, _ in order)


def _main_part(wrapper: dict) -> tuple[dict, list[tuple[dict, dict | None]]]:
    order, todo = [], [(wrapper, None)]
    while todo:
        node, parent = todo.pop()
        order.append((node, parent))
        if "k" in node and not node.get("o"):
            todo.extend((k, node) for k in node["k"])
    chars: dict[int, int] = {}
    for node, parent in reversed(order):
        own = chars.get(id(node), 0)
        if "k" not in node:
            own = 0 if node["t"] is not None and node["n"] >= 2 else node["c"]
        elif node.get("a"):
            own = 0
        elif "s" in node:
            own = node["c"]
        chars[id(node)] = own
        if parent is not None:
            chars[id(parent)] = chars.get(id(parent), 0) + own
    named = [(n, p) for n, p in order if "k" in n and "g" not in n and n["l"].partition(".")[0] in MAIN_TAGS]
    if not named:
        named = [(n, p) for n, p in order if "k" in n and "g" not in n and n["l"].partition(".")[2] in MAIN_NAMES]
    if named:
        most = max(chars[id(n)] for n, _ in named)
        # of nested candidates with nearly as much, the innermost
        chosen = [n for n, _ in named if chars[id(n)] >= max(1, SHARE * most)] or [named[0][0]]
        return chosen[-1], order
    at = wrapper
    while True:
        places: dict[object, list[dict]] = {}
        for k in at["k"]:
            if "k" in k and not k.get("o") and k["q"] in "1?":
                places.setdefault(k["l"], []).append(k)
        for label, several in list(places.items()):
            if sum(k["n"] for k in several) > at["n"]:  # a page has two of them, so they are not one part at different places
                places |= {label: several[:1]} | {id(k): [k] for k in several[1:]}
        inner = [p for p in places.values() if sum(chars[id(k)] for k in p) >= max(1, SHARE * chars[id(at)])]
        if not inner or inner[0][0]["l"] == "a":
            break
        at = max(inner[0], key=lambda k: chars[id(k)])
    return at, order


# ---- reading ------------------------------------------------------------------------------------

def _main(tree: Element, wrapper: dict) -> list[tuple[Element, dict | None]]:
    """The main parts of a page, outermost, in page order, each with its wrapper."""
    out, todo = [], [(tree, wrapper)]
    while todo:
        element, known = todo.pop()
        if known.get("m"):
            out.append((element, known))
            continue
        todo.extend(reversed([(c, k) for c, k in _matched(element, known) if k is not None and isinstance(c, Element)]))
    return out


def _matched(element: Element, known: dict | None) -> list[tuple[object, dict | None]]:
    """Every child with the item of the wrapper that it fits."""
    return list(zip(element.children, _fitted(["#text" if isinstance(c, str) else c.label for c in element.children], known)))


def _fitted(labels: list[str], known: dict | None) -> list[dict | None]:
    """The item of the wrapper that each label fits, taken in order; repeated groups may be entered again."""
    items = [x for k in (known["k"] if known else ()) for x in (k["k"] if "g" in k else (k,))]
    groups = [g for g, k in enumerate(known["k"] if known else ()) for _ in (k["k"] if "g" in k else (k,))]
    places: dict[str, list[int]] = {}
    for i, item in enumerate(items):
        places.setdefault(item["l"], []).append(i)
    out, at = [], 0
    for label in labels:
        own = places.get(label) or places.get(label.partition(".")[0] + ".*") or ()
        next_ = bisect_left(own, at)
        if next_ < len(own):
            place = own[next_]
        else:  # back to the beginning of the group, or by one
            place = next((i for i in own if groups[i] == groups[at]), own[-1] if own and own[-1] == at - 1 else None)
        out.append(None if place is None else items[place])
        if place is not None:
            at = place
    return out


def _own_main(tree: Element) -> list[Element]:
    """The main parts of a page that no wrapper fits: its outermost articles, else its mains, else all of it."""
    for tag in ("article", "main"):
        found, todo = [], [tree]
        while todo:
            element = todo.pop()
            if element.tag == tag:
                found.append(element)
            elif not is_out(element, True):
                todo.extend(reversed([c for c in element.children if isinstance(c, Element)]))
        if found:
            return found
    return [tree]


def _blocks(element: Element, known: dict | None, in_main: bool, constant: frozenset[int] = frozenset()) -> list[str]:
    """`constant`: the template's elements by id, where `known` does not tell."""
    out, text = [], []

    def close():
        if text:
            joined = decoded("".join(text))
            text.clear()
            if joined:
                out.append(joined)

    todo: list = [(element, known)]
    while todo:
        at, own = todo.pop()
        if at is None:
            close()
        elif isinstance(at, str):
            text.append(at)
        elif at.tag in ("br", "wbr"):
            text.append(" " if at.tag == "br" else "")
        elif at is not element and is_out(at, in_main):
            if at.tag not in INLINE and at.tag not in RAW:
                close()
        elif at is not element and (id(at) in constant or _constant(at, own)):
            close()
        else:
            if at.tag not in INLINE:
                close()
                todo.append((None, None))
            todo.extend(reversed(_matched(at, own) if own is not None else [(c, None) for c in at.children]))
    close()
    return out


def _constant(element: Element, own: dict | None) -> bool:
    """Is this element's whole text the template's, word for word?"""
    if own is None or own["q"] not in "1?" or own["n"] < CONSTANT or element.tag in INLINE or element.tag == "h1":
        return False
    items = own["k"]
    return len(items) == 1 and "k" not in items[0] and items[0]["n"] >= CONSTANT and items[0]["t"] is not None \
        and items[0]["t"] == _digest(decoded(_inner(element)))


def main_text(page: str | None, wrapper: dict | None) -> str:
    if not page:
        return ""
    tree = parse(page)
    parts = _main(tree, wrapper) if wrapper else []
    return _text(tree, [b for element, known in parts for b in _blocks(element, known, True)])


def _text(tree: Element, blocks: list[str]) -> str:
    if not blocks:
        own = _own_main(tree)
        blocks = [b for element in own for b in _blocks(element, None, element is not tree)]
    return "\n\n".join(blocks)


# ---- places -------------------------------------------------------------------------------------
ROOT = b""


@dataclass
class Spot:
    """An element of a page: its place, its parent's number on the page, the labels from the root on (hashed), its depth,
    the places and texts directly in it, whether it has no more than one text, and whether it or one around it is out."""
    element: Element
    place: bytes
    parent: int
    path: bytes
    depth: int
    texts: list[tuple[bytes, str]]
    plain: bool
    out: bool


def _under(place: bytes, label: str) -> bytes:
    return blake2b(label.encode("utf-8", "surrogatepass"), key=place, digest_size=16).digest()


def _with_places(wrapper: dict) -> dict:
    """Gives every item its place, save those in slots and in groups in any order."""
    todo, n = [wrapper], 0
    while todo:
        node = todo.pop()
        if node["l"] != ANY:
            node["i"] = b"%d" % n
            n += 1
            todo.extend(node.get("k", ()))
    return wrapper


def _spots(tree: Element, wrapper: dict) -> list[Spot]:
    """All elements of a page, in page order."""
    out: list[Spot] = []
    todo: list[tuple] = [(tree, wrapper, ROOT, -1, ROOT, 0, False)]
    while todo:
        element, known, place, parent, path, depth, is_outside = todo.pop()
        children = _flat(element) if element.tag not in RAW else []
        spot = Spot(element, place, parent, path, depth, [], True, is_outside)
        below = []
        for (label, child), own in zip(children, _fitted([c[0] for c in children], known) if known else [None] * len(children)):
            if own and "i" not in own:
                own = None
            where = own["i"] if own else _under(place, label)
            if isinstance(child, str):
                spot.texts.append((where, child))
            else:
                below.append((child, own, where, len(out), _under(path, child.label), depth + 1, is_outside or is_out(child, True)))
        spot.plain = not below and len(spot.texts) <= 1
        out.append(spot)
        todo.extend(reversed(below))
    return out


def _texts_by_place(spots: list[Spot]) -> Iterator[tuple[bytes, bool, int, bytes | None]]:
    """place, is it an element, how often the page has it, digest of its text: null without text, empty where there is more
    than one text."""
    found: dict[tuple[bytes, bool], list] = {}

    def add(place, is_element, digest):
        known = found.setdefault((place, is_element), [0, digest])
        known[0] += 1
        if digest is not None and known[1] != digest:
            known[1] = digest if known[1] is None else b""

    for spot in spots:
        if not spot.out:
            digests = [blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest() for _, text in spot.texts]
            add(spot.place, True, (digests[0] if digests else None) if spot.plain else b"")
            for (place, _), digest in zip(spot.texts, digests):
                add(place, False, digest)
    return ((place, is_element, times, digest) for (place, is_element), (times, digest) in found.items())


def _chars_by_place(spots: list[Spot], same: set[bytes]) -> Iterator[tuple[bytes, bytes | None, bytes, str, int, int, int]]:
    """place, its parent, path, label, depth, how often the page has it, characters that are not the template's."""
    chars = [sum(len(text) for place, text in spot.texts if place not in same) for spot in spots]
    found: dict[bytes, list] = {}
    for at in range(len(spots) - 1, -1, -1):
        spot = spots[at]
        if spot.out or spot.element.tag == "a":
            chars[at] = 0
        if spot.parent >= 0:
            chars[spot.parent] += chars[at]
        if not spot.out:
            known = found.setdefault(spot.place, [spots[spot.parent].place if spot.parent >= 0 else None, spot.path, spot.element.label, spot.depth, 0, 0])
            known[-2] += 1
            known[-1] += chars[at]
    return ((place, *known) for place, known in found.items())


def _text_by_places(page: str, wrapper: dict, main: set[bytes], same: set[bytes]) -> str:
    tree = parse(page)
    spots = _spots(tree, wrapper)
    constant = frozenset(id(s.element) for s in spots if s.place in same and s.element.tag not in INLINE and s.element.tag != "h1")
    blocks, inside = [], [False] * len(spots)
    for at, spot in enumerate(spots):
        inside[at] = spot.parent >= 0 and inside[spot.parent]
        if not inside[at] and spot.place in main:
            inside[at] = True
            blocks += _blocks(spot.element, None, True, constant)
    return _text(tree, blocks)


# ---- jobs ---------------------------------------------------------------------------------------

_PARTIAL = "host STRING, share BIGINT, key STRING, wrapper STRING"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of _PARTIAL, about 4 MB of wrappers at a time."""
    types = {"host": pa.string(), "share": pa.int64(), "key": pa.string(), "wrapper": pa.string()}
    out, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.values())], names=list(types))

    for row in rows:
        out.append(row)
        size += len(row[3])
        if size > 4_000_000 or len(out) == 10_000:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _page_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, bits, html -> the wrapper of every page, its key, and the share of its host: the first bits of the key."""
    def rows():
        seen: set[bytes] = set()
        for batch in batches:
            for host, bits, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                hashed = blake2b(f"{len(host)} {host}".encode(), digest_size=16)
                hashed.update(page.as_buffer())
                key = hashed.digest()
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                yield host, int.from_bytes(key) >> 128 - bits, key.hex(), json.dumps(of_page(page.as_py()))

    return _batches(rows())


def _join_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host and share, of rows in order of host, share and key."""
    def rows():
        for (host, share), group in groupby(_rows(batches), key=lambda r: r[:2]):
            key, wrapper = _joined((int(key, 16), own) for _, _, key, own in group)
            yield host, share, f"{key:032x}", json.dumps(wrapper)

    return _batches(rows())


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for host, share, key, text in _rows(batches):
            wrapper = json.loads(text)
            whole = _mark(wrapper)
            yield host, share, key if whole else None, json.dumps(wrapper)  # no key: not whole

    return _batches(rows())


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, wrapper (JSON), whole (false: it has slots or groups in any order, see `by_places`): one row per host, of all
    its different pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    large = rows.groupBy("host").count().where(F.col("count") > SHARE_PAGES)
    large = store(large.select("host", F.ceil(F.log2(F.col("count") / SHARE_PAGES)).cast("int").alias("bits")), "hosts")
    bits = large.agg(F.max("bits")).first()[0] or 0
    rows = rows.where(F.length("html") > 0).join(large, "host", "left").select("host", F.coalesce("bits", F.lit(0)).alias("bits"), "html")
    found = rows.mapInArrow(_page_wrappers, _PARTIAL)
    while True:
        found = found.repartition("host", "share").sortWithinPartitions("host", "share", "key").mapInArrow(_join_shares, _PARTIAL)
        if not bits:
            return found.mapInArrow(_marked, _PARTIAL).select("host", "wrapper", F.col("key").isNotNull().alias("whole"))
        bits = max(bits - STEP, 0)
        found = found.withColumn("share", F.shiftright("share", STEP))


def _wrappers() -> Callable[[str, pa.Scalar], dict | None]:
    """The wrapper of a host from its JSON, kept for the next pages."""
    known: OrderedDict = OrderedDict()

    def of(host, wrapper):
        if host not in known:
            text = wrapper.as_py()
            known[host] = _with_places(json.loads(text)) if text else None
            if len(known) > 1000:
                known.popitem(last=False)
        return known[host]

    return of


_OUT = "page_id BIGINT, url STRING, text STRING, n_chars BIGINT"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, html, host, wrapper and, for wrappers with places, their main places and the page's places of template
    texts."""
    wrapper_of = _wrappers()
    for batch in batches:
        out = []
        lists = [c.to_pylist() for c in batch.columns[5:]]
        for at, (page, host, text) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4))):
            wrapper, page = wrapper_of(host, text), page.as_py()
            if lists and page:
                out.append(_text_by_places(page, wrapper, *(set(c[at] or ()) for c in lists)))
            else:
                out.append(main_text(page, wrapper))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def _each_page(schema: pa.Schema, rows_of: Callable[..., Iterator[tuple]]):
    """host, key, html, wrapper[, same] -> host, key and the rows of every page, by its elements."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper_of = _wrappers()

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        out = []
        for b in batches:
            lists = [c.to_pylist() for c in b.columns[4:]]
            for at, (host, key, page, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3))):
                spots = _spots(parse(page.as_py()), wrapper_of(host, text))
                for row in rows_of(spots, *(set(c[at] or ()) for c in lists)):
                    out.append((host, key, *row))
                    if len(out) == 20_000:
                        yield batch(out)
                        out = []
        if out:
            yield batch(out)

    return run


_TEXTS = pa.schema([("host", pa.string()), ("key", pa.binary()), ("place", pa.binary()), ("is_element", pa.bool_()), ("times", pa.int64()),
                    ("digest", pa.binary())])
_CHARS = pa.schema([("host", pa.string()), ("key", pa.binary()), ("place", pa.binary()), ("parent", pa.binary()), ("path", pa.binary()),
                    ("label", pa.string()), ("depth", pa.int64()), ("times", pa.int64()), ("chars", pa.int64())])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, depth, place, parent in order of host and depth -> the place where the way down from the root ends."""
    hosts, tips = [], []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(tips, pa.binary())], names=["host", "place"])

    for host, group in groupby(_rows(batches), key=lambda r: r[0]):
        tip = ROOT
        for _, _, place, parent in group:
            if parent == tip:
                tip = place
        hosts.append(host)
        tips.append(tip)
        if len(hosts) == 10_000:
            yield batch()
            hosts, tips = [], []
    if hosts:
        yield batch()


def _main_places(places: DataFrame) -> DataFrame:
    """host, main: the places of the main part, found as in `_main_part` and `_mark`. places: one row per host and place."""
    name = F.split("label", r"\.")
    rank = F.when(name[0].isin(*MAIN_TAGS), 2).when(F.get(name, F.lit(1)).isin(*MAIN_NAMES), 1).otherwise(0)
    named = places.withColumn("rank", rank).where("rank > 0")
    most = named.groupBy("host").agg(F.max(F.struct("rank", "chars")).alias("most"))
    named = named.join(most, "host").where(
        (F.col("rank") == F.col("most.rank")) & (F.col("chars") >= F.least("most.chars", F.greatest(F.lit(1), SHARE * F.col("most.chars")))))
    named = named.groupBy("host").agg(F.max(F.struct("depth", "chars", "place"))["place"].alias("place"))
    # Without such a name: down from the root, as long as one part has most of the varying text. Parts of one label that no
    # page has twice are one part at different places.
    around = places.select("host", F.col("place").alias("parent"), F.col("n").alias("pages"), F.col("chars").alias("all_chars"))
    steps = (places.where("parent IS NOT NULL").groupBy("host", "parent", "label", "depth")
             .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.max(F.struct("chars", "place", "times")).alias("top"))
             .join(around, ["host", "parent"])
             .where((F.col("top.times") == 1) & (F.when(F.col("n") <= F.col("pages"), F.col("chars")).otherwise(F.col("top.chars"))
                                                 >= F.greatest(F.lit(1), SHARE * F.col("all_chars")))))
    steps = steps.select("host", "depth", F.col("top.place").alias("place"), "parent").unionByName(
        places.where("parent IS NULL").select("host", "depth", "place", "parent"))
    walked = steps.repartition("host").sortWithinPartitions("host", "depth").mapInArrow(_walked, "host STRING, place BINARY")
    chosen = store(named.unionByName(walked.join(named, "host", "left_anti")), "chosen")
    paths = places.join(chosen, ["host", "place"]).select("host", "path", F.col("place").alias("chosen"))
    pages = places.where("parent IS NULL").select("host", F.col("n").alias("pages"))
    return (places.join(paths, ["host", "path"]).groupBy("host", "chosen").agg(F.sum("n").alias("n"), F.collect_set("place").alias("same"))
            .join(pages, "host").select("host", F.when(F.col("n") <= F.col("pages"), F.col("same")).otherwise(F.array("chosen")).alias("main")))


def by_places(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of pages (page_id, url, html, host) by the places of their elements.

    wrappers: host, wrapper; pages of other hosts are left out. Pages are aligned with the wrapper as far as it goes, and
    judged by counts over all different pages of the host.
    """
    key = F.substring(F.unhex(F.sha2("html", 256)), 1, 16)
    rows = pages.join(wrappers.select("host", "wrapper"), "host").withColumn("key", key)
    # Not stored: that would be a copy of the input beside its shuffle.
    different = rows.where(F.length("html") > 0).groupBy("host", "key").agg(F.first("html").alias("html"))
    different = different.join(wrappers.select("host", "wrapper"), "host").select("host", "key", "html", "wrapper")
    texts = store(different.mapInArrow(_each_page(_TEXTS, _texts_by_place), "host STRING, key BINARY, place BINARY, is_element BOOLEAN, times BIGINT, digest BINARY"),
                  "place-texts")
    same = (texts.groupBy("host", "place", "is_element")
            .agg(F.count("digest").alias("n"), F.max("times").alias("times"), F.min("digest").alias("least"), F.max("digest").alias("most"))
            .where("least = most AND length(least) > 0").where(f"n >= IF(is_element, {CONSTANT}, 2) AND (times = 1 OR NOT is_element)")
            .select("host", "place", "is_element"))
    same = store(texts.join(same, ["host", "place", "is_element"]).groupBy("host", "key").agg(F.collect_list("place").alias("same")), "template-texts")
    chars = different.join(same, ["host", "key"], "left").select("host", "key", "html", "wrapper", "same").mapInArrow(
        _each_page(_CHARS, _chars_by_place),
        "host STRING, key BINARY, place BINARY, parent BINARY, path BINARY, label STRING, depth BIGINT, times BIGINT, chars BIGINT")
    places = store(chars.groupBy("host", "place").agg(*(F.max(c).alias(c) for c in ("parent", "path", "label", "depth", "times")),
                                                      F.count("*").alias("n"), F.sum("chars").alias("chars")), "places")
    main = store(_main_places(places), "main-places")
    rows = rows.join(main, "host", "left").join(same, ["host", "key"], "left")
    return rows.select("page_id", "url", "html", "host", "wrapper", "main", "same").mapInArrow(_reader, _OUT)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    wrappers = store(infer_wrappers(pages), "wrappers")  # as a table: the join can then split a hot host or broadcast what is small
    pages = pages.withColumn("host", host_of(F.col("url")))
    general = wrappers.where("NOT whole")
    if general.isEmpty():
        return pages.join(wrappers, "host", "left").select("page_id", "url", "html", "host", "wrapper").mapInArrow(_reader, _OUT)
    rows = pages.join(wrappers, "host", "left").where("coalesce(whole, true)").select("page_id", "url", "html", "host", "wrapper")
    return rows.mapInArrow(_reader, _OUT).unionByName(by_places(pages, general))
