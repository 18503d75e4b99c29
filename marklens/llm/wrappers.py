"""Main text of web pages by wrappers: union-free expressions inferred per host.

A wrapper is a nested expression of elements. Two pages (or two wrappers) of a
host are aligned element by element. Equal neighbours become one repeated group;
an element that only one side has becomes optional; text that differs becomes a
slot, text that is the same stays a constant. No other alternatives exist, so a
wrapper stays as small as the host's layout. Aligning is the same work for pages
and wrappers: each task aligns its pages of a host, then the few results are
aligned, in two steps so that no group grows with the host.

Each page is matched against its host's wrapper. The main text lies in the main and
article elements and in the h1 beside them; without such elements, in the deepest
element that holds all text which varies and isn't in links. What an element says on
all pages that have it is a constant, and left out if ``MANY`` different pages do,
unless less than a third of the page would remain (pages that are copies of each
other). Lists of names, roles and class words tell menus, forms and the like on hosts
with few pages; a class word doesn't remove an element with half of the page's text,
if it isn't one for reader comments.

Edge cases: a null page or one without text gives an empty text; pages without a
host form a group; broken markup is read as far as it goes; equal pages of a host
give equal texts; a page without the host's places is looked at alone; elements more
than ``LEVELS`` deep are aligned as part of the one around them, their text stays.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marklens.llm.markup import Element, Page, read
from marklens.llm.storage import keep

#: Wrappers a task holds before it passes them on.
HELD = 5_000
#: First-step groups of a host.
SALTS = 64
#: Different pages on which a constant stands that is no part of the main text.
MANY = 8
#: Depth down to which elements are aligned one by one.
LEVELS = 80

_OUT_NAMES = frozenset("nav header footer aside form menu dialog head".split())
_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert form menu menubar".split()
)
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disclaimer disqus footer form gdpr header "
    "masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination paywall popup promo promoted promotion recommended related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget "
    "widgets login reactions feedback".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Class words of articles that only announce another one.
_TEASERS = frozenset("card cards teaser teasers related promo promoted sponsored ad ads".split())
_WORDS = re.compile(r"[a-z]+")
#: Elements that are text rather than a place for it.
_TEXTUAL = frozenset("p li ul ol dl table pre blockquote h1 h2 h3 h4 h5 h6".split())

# A node is [sign, optional, repeated, constant text or None, characters outside links,
# nodes, hashes of texts that all its pages have there, whether other texts occur, the
# least hashes of its pages, MANY at most].
_SIGN, _OPTIONAL, _REPEATED, _TEXT, _SIZE, _NODES, _COMMON, _VARIES, _PAGES = range(9)


def left_out(element: Element) -> bool:
    """Whether an element's name, role or attributes say that it holds something else
    than the main text."""
    marks = element.attributes
    if element.name in _OUT_NAMES or marks.get("role") in _OUT_ROLES:
        return True
    if "hidden" in marks or marks.get("aria-hidden") == "true":
        return True
    return "display:none" in marks.get("style", "").replace(" ", "")


def _named_out(element: Element) -> tuple[bool, bool]:
    """Whether class or id say so, and whether they say that it is for comments."""
    if element.name in ("body", "html", "main") or len(element.attributes) == 0:
        return False, False
    marks = element.attributes
    named = _WORDS.findall(f"{marks.get('class', '')} {marks.get('id', '')}")
    comments = not _COMMENTS.isdisjoint(named)
    out = _TEASERS | _COMMENTS if element.name == "article" else _OUT_WORDS | _TEASERS
    return not out.isdisjoint(named), comments


def _visible(page: Page) -> list[bool]:
    """Per element, whether neither it nor one around it is left out. The head of an
    article belongs to it."""
    shown, inside, named = [True], [False], [False]
    for element in page.elements[1:]:
        above = element.parent
        out = left_out(element) and not (element.name == "header" and inside[above])
        by_name, comments = _named_out(element)
        shown.append(shown[above] and not out and not comments)
        named.append(by_name and not comments)
        inside.append(inside[above] or element.name in ("article", "main"))
    if any(named):
        sizes = [0] * len(shown)
        for element, _, _, text in page.pieces:
            if shown[element]:
                sizes[element] += len(text.strip())
        for number in range(len(sizes) - 1, 0, -1):
            sizes[page.elements[number].parent] += sizes[number]
        for number, element in enumerate(page.elements[1:], 1):
            small = 2 * sizes[number] < sizes[0]
            shown[number] = shown[number] and shown[element.parent] and not (named[number] and small)
    return shown


def _hash(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _owners(page: Page) -> list[int]:
    """Per element the one that it is aligned as: itself, or one at the last level."""
    owners, levels = [0], [0]
    for number, element in enumerate(page.elements[1:], 1):
        deep = levels[element.parent] >= LEVELS
        owners.append(owners[element.parent] if deep else number)
        levels.append(levels[element.parent] + (not deep))
    return owners


def _own_texts(page: Page, shown: list[bool], owners: list[int]) -> dict[int, str]:
    """The shown text of each element without that of the elements in it."""
    parts: dict[int, list[str]] = {}
    for element, _, _, text in page.pieces:
        if shown[element]:
            parts.setdefault(owners[element], []).append(text)
    joined = ((number, " ".join("".join(x).split())) for number, x in parts.items())
    return {number: text for number, text in joined if text}


def page_wrapper(page: Page) -> list:
    """The wrapper of one page: its elements, repeated neighbours folded."""
    shown, owners = _visible(page), _owners(page)
    texts = _own_texts(page, shown, owners)
    pages = [_hash("\n".join(texts.values()))]
    nodes = [[e.sign, False, False, "", 0, [], [], False, pages] for e in page.elements]
    for number, text in texts.items():
        nodes[number][_TEXT], nodes[number][_COMMON] = text, [_hash(text)]
    for element, _, link, text in page.pieces:
        if shown[element] and not link:
            nodes[owners[element]][_SIZE] += len(text.strip())
    for number in range(len(nodes) - 1, 0, -1):
        if shown[number] and owners[number] == number:
            nodes[page.elements[number].parent][_NODES].append(nodes[number])
    for number in range(len(nodes) - 1, -1, -1):
        nodes[number][_NODES] = _folded(nodes[number][_NODES][::-1])
    return nodes[0]


def _folded(nodes: list) -> list:
    """Runs of equal signs as one repeated group."""
    out: list = []
    for node in nodes:
        if out and out[-1][_SIGN] == node[_SIGN]:
            optional = out[-1][_OPTIONAL] and node[_OPTIONAL]
            out[-1] = align(out[-1], node, one_page=True)
            out[-1][_OPTIONAL], out[-1][_REPEATED] = optional, True
        else:
            out.append(node)
    return out


def align(a: list, b: list, one_page: bool = False) -> list:
    """The least wrapper that covers two of the same sign. Neighbours on one page add
    up their texts; of two pages those remain constants that both have."""
    first, second = a[_NODES], b[_NODES]
    if [n[_SIGN] for n in first] == [n[_SIGN] for n in second]:
        nodes = [align(x, y, one_page) for x, y in zip(first, second, strict=True)]
    else:
        nodes = _folded(_merged(first, second, one_page))
    common, varies, pages = a[_COMMON], a[_VARIES] or b[_VARIES], a[_PAGES]
    if common != b[_COMMON]:
        if one_page:
            common = sorted({*common, *b[_COMMON]})
        else:
            common, varies = sorted({*common} & {*b[_COMMON]}), True
    if pages != b[_PAGES]:
        if one_page:
            pages = min(pages, b[_PAGES], key=len)
        else:
            pages = sorted({*pages, *b[_PAGES]})[:MANY]
    return [
        a[_SIGN],
        a[_OPTIONAL] or b[_OPTIONAL],
        a[_REPEATED] or b[_REPEATED],
        a[_TEXT] if a[_TEXT] == b[_TEXT] else None,
        a[_SIZE] + b[_SIZE],
        nodes,
        common,
        varies,
        pages,
    ]


def _lengths(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of first with each start of second."""
    row = np.zeros(len(second) + 1, np.int32)
    for sign in first:
        met = np.maximum(row[1:], row[:-1] + (second == sign))
        np.maximum.accumulate(met, out=row[1:])
    return row


def common_places(first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in memory that grows with n + m: the
    first sequence is halved where both halves together match most."""
    found: list[tuple[int, int]] = []
    spans = [(0, len(first), 0, len(second))]
    while spans:
        low, high, left, right = spans.pop()
        while low < high and left < right and first[low] == second[left]:
            found.append((low, left))
            low, left = low + 1, left + 1
        if low == high or left == right:
            continue
        if high - low == 1:
            at = np.flatnonzero(second[left:right] == first[low])
            if len(at):
                found.append((low, left + int(at[0])))
            continue
        half, part = (low + high) // 2, second[left:right]
        before = _lengths(first[low:half], part)
        after = _lengths(first[half:high][::-1], part[::-1])[::-1]
        cut = left + int(np.argmax(before + after))
        spans += [(half, high, cut, right), (low, half, left, cut)]
    return sorted(found)


def _merged(first: list, second: list, one_page: bool) -> list:
    """Two sequences along their longest common subsequence; the rest is optional."""
    numbers: dict[str, int] = {}
    a, b = (
        np.array([numbers.setdefault(x[_SIGN], len(numbers)) for x in side], np.int32)
        for side in (first, second)
    )
    met = [(-1, -1), *common_places(a, b), (len(first), len(second))]
    out = []
    for (i, j), (to_i, to_j) in pairwise(met):
        for node in [*first[i + 1 : to_i], *second[j + 1 : to_j]]:
            out.append([*node[:_OPTIONAL], True, *node[_REPEATED:]])
        if to_i < len(first):
            out.append(align(first[to_i], second[to_j], one_page))
    return out


def expression(node: list) -> str:
    """The wrapper as a regular expression over elements, # being a text slot."""
    inner = "".join(expression(x) for x in node[_NODES])
    text = "#" if node[_TEXT] is None else node[_TEXT]
    whole = f"<{node[_SIGN]}>{text}{inner}</>"
    mark = {(True, True): "*", (True, False): "?", (False, True): "+"}
    suffix = mark.get((node[_OPTIONAL], node[_REPEATED]))
    return f"({whole}){suffix}" if suffix else whole


class Matcher:
    """A wrapper to match pages with: per place (the signs from the root to it) the
    places in it, the constants to drop, and whether it is part of the main text."""

    def __init__(self, wrapper: list) -> None:
        self.inner: list[dict[str, int]] = [{}]
        self.drop: list[set[str]] = [set()]
        above, names, own, repeated = [-1], [""], [[0, False]], [False]
        waiting = [(wrapper, 0)]
        while waiting:
            node, place = waiting.pop()
            constant = len(node[_PAGES]) >= MANY
            if constant:
                self.drop[place].update(node[_COMMON])
            own[place][0] += node[_SIZE]
            own[place][1] |= node[_SIZE] > 0 and (node[_VARIES] or not constant)
            for x in node[_NODES]:
                if x[_SIGN] not in self.inner[place]:
                    self.inner[place][x[_SIGN]] = len(self.inner)
                    self.inner.append({})
                    self.drop.append(set())
                    above.append(place)
                    names.append(x[_SIGN].split(".")[0])
                    own.append([0, False])
                    repeated.append(False)
                at = self.inner[place][x[_SIGN]]
                repeated[at] |= x[_REPEATED]
                waiting.append((x, at))
        sizes = [x[0] for x in own]
        varies = [x[1] for x in own]
        for place in range(len(own) - 1, 0, -1):
            sizes[above[place]] += sizes[place]
            varies[above[place]] |= varies[place]
        self.inside = self._main(above, names, sizes)
        if not any(self.inside):
            self.inside[self._deepest(names, [x[1] for x in own], varies, repeated)] = True
        for place in range(1, len(own)):
            self.inside[place] |= self.inside[above[place]]

    def _main(self, above: list[int], names: list[str], sizes: list[int]) -> list[bool]:
        """The main and article elements, and each h1 beside one or beside what is around it."""
        inside = [name in ("article", "main") and size > 0 for name, size in zip(names, sizes, strict=True)]
        around = set()
        for place in [x for x, found in enumerate(inside) if found]:
            while place > 0 and above[place] not in around:
                place = above[place]
                around.add(place)
        for place, name in enumerate(names):
            if name == "h1" and above[place] in around:
                inside[place] = True
        return inside

    def _deepest(
        self, names: list[str], own: list[bool], varies: list[bool], repeated: list[bool]
    ) -> int:
        place = 0
        while not own[place]:
            inner = [x for x in self.inner[place].values() if varies[x]]
            if len(inner) != 1 or repeated[inner[0]] or names[inner[0]] in _TEXTUAL:
                break
            place = inner[0]
        return place

    def text(self, page: Page) -> str:
        """The page's text in the places of the main text, without constants."""
        shown, owners = _visible(page), _owners(page)
        places = [0] + [-1] * (len(page.elements) - 1)
        for number, element in enumerate(page.elements[1:], 1):
            if owners[number] != number:
                places[number] = places[owners[number]]
            elif places[element.parent] >= 0:
                places[number] = self.inner[places[element.parent]].get(element.sign, -1)
        within = [self.inside[0]] + [False] * (len(places) - 1)
        for number, element in enumerate(page.elements[1:], 1):
            # An element that the wrapper lacks belongs to the one around it.
            place = places[number]
            within[number] = self.inside[place] if place >= 0 else within[element.parent]
        kept = [x and y for x, y in zip(within, shown, strict=True)]
        whole = _blocks(page, kept)
        varying = list(kept)
        for number, text in _own_texts(page, kept, owners).items():
            place = places[number]
            if place >= 0 and self.drop[place] and _hash(text) in self.drop[place]:
                varying[number] = False
        if varying == kept:
            return whole
        for number, owner in enumerate(owners):
            varying[number] &= varying[owner] or not kept[owner]
        rest = _blocks(page, varying)
        return rest if 3 * len(rest) >= len(whole) else whole


def _blocks(page: Page, kept: list[bool]) -> str:
    """The text of the elements kept, block by block."""
    blocks: list[str] = []
    last, parts = None, []
    for element, block, _, text in [*page.pieces, (0, -1, False, "")]:
        if block != last:
            if joined := " ".join("".join(parts).split()):
                blocks.append(joined)
            last, parts = block, []
        if kept[element]:
            parts.append(text)
    return "\n\n".join(blocks)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of a task's pages by host."""
    held: dict[str | None, list] = {}

    def out() -> pa.RecordBatch:
        rows = [json.dumps(x) for x in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(held, pa.string()), pa.array(rows, pa.string())], names=["host", "wrapper"]
        )

    for batch in batches:
        for host, html in zip(batch.column("host"), batch.column("html"), strict=True):
            host, found = host.as_py(), page_wrapper(read(html.as_py() or ""))
            held[host] = align(held[host], found) if host in held else found
        if len(held) >= HELD:
            yield out()
            held = {}
    if held:
        yield out()


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of one group aligned; one is held at a time."""
    whole, first = None, None
    for batch in batches:
        for row in batch.column("wrapper"):
            found = json.loads(row.as_py())
            whole = found if whole is None else align(whole, found)
        first = batch.column("host").slice(0, 1) if first is None else first
    yield pa.RecordBatch.from_arrays(
        [first, pa.array([json.dumps(whole)], pa.string())], names=["host", "wrapper"]
    )


def wrappers(pages: DataFrame) -> DataFrame:
    """The wrapper of every host, from (host, html)."""
    schema = "host string, wrapper string"
    found = pages.select("host", "html").mapInArrow(_partial, schema)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInArrow(_aligned_group, schema)
    return some.groupBy("host").applyInArrow(_aligned_group, schema)


def _aligned_group(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(_aligned(iter(table.to_batches())))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Matcher] = {}
    for batch in batches:
        texts = []
        for html, wrapper in zip(batch.column("html"), batch.column("wrapper"), strict=True):
            page, wrapper = read(html.as_py() or ""), wrapper.as_py()
            if wrapper not in known:
                if len(known) >= HELD:
                    known.clear()
                known[wrapper] = Matcher(json.loads(wrapper))
            texts.append(known[wrapper].text(page) or Matcher(page_wrapper(page)).text(page))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def host_of(url: Column) -> Column:
    """Host name in lower case; null where the address has none."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.nullif(found, F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page, as (page_id, url, text).

    The wrappers are stored, one row per host. Spark broadcasts them if they are
    small; else both sides are shuffled and a hot host is split.
    """
    rows = pages.select("page_id", "url", "html", host_of(pages["url"]).alias("host"))
    known = keep(wrappers(rows), "wrappers").withColumnRenamed("host", "wrapper_host")
    same = F.col("host").eqNullSafe(F.col("wrapper_host"))
    joined = rows.join(known, same, "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(_extracted, "page_id long, url string, text string")
