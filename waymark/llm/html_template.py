"""Main text of pages by deducing each host's template from token equivalence classes."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.storage import materialize

#: Fixed values of HTML: elements without content, with raw text, and that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "title tr ul".split()
)
#: A start tag of the key closes an open element of the values.
CLOSES = {
    **{t: frozenset({"p"}) for t in BLOCKS - {"br", "button", "option", "html", "head", "body", "title"}},
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}
#: Elements that stop the search for one to close.
FENCES = frozenset("table ul ol dl div article section main aside nav form body html select td th".split())
#: Elements that never hold main text.
ASIDE = frozenset(
    "head nav header footer aside form script style noscript template iframe menu button select "
    "textarea dialog svg canvas object".split()
)
#: Classes, ids and roles that mark what is around the main text - adverts, menus, footers,
#: sidebars, comments, notices, forms - alone or joined to one another (cookie-notice) or to
#: ``site`` (site-nav); a name with any other part is no mark.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation navigationlinks menu menubar breadcrumb breadcrumbs pagination pager "
    "toolbar skip footer contentinfo copyright sidebar rail complementary comment comments "
    "commentlist respond reply replies disqus cookie cookies consent gdpr notice notices alert "
    "popup modal disclaimer newsletter subscribe subscription signup login search".split()
)
#: The same for what may belong to an article, and is a mark outside of one only.
OUTER_MARKS = frozenset(
    "header masthead widget related recommended recommendations share sharing social tags".split()
)
MAIN = ("article", "main")
#: Elements that can be the region of the main text.
REGIONS = frozenset("html body main article section div center form table tbody tr td".split())
#: A valid class has so many tokens at least, and stands on one of so many pages of its host.
CLASS_TOKENS = 3
CLASS_PAGES = 10
#: A text of a valid class is template, and taken out, if it is on so many pages at least and
#: on more than half of the host's.
TEXT_PAGES = 5
#: Hosts whose templates are broadcast: a host, a path and the texts of its template, which are
#: two for each text of a page at most.
MAX_HOSTS = 50_000
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none")
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[-_]+")
#: Numbers in class names are alike, so that generated names do not make new roles.
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """A page's elements, each after its parent (0 is the page itself), and its text blocks.

    An element's key is a hash of its place: its parent's key, its role - name and class
    names - and its number among the children of that role.
    """

    names: list[str]
    roles: list[str]
    parents: list[int]
    keys: list[int]
    aside: list[bool]
    blocks: list[tuple[int, str]]

    def inside(self, wanted: set[int]) -> list[bool]:
        """Whether each element is, or is in, one of the wanted elements."""
        out = [0 in wanted]
        for k in range(1, len(self.names)):
            out.append(k in wanted or out[self.parents[k]])
        return out

    def regions(self) -> list[list[int]]:
        """Keys of the regions around each element, itself included, outermost first."""
        out: list[list[int]] = [[]]
        for k in range(1, len(self.names)):
            around = out[self.parents[k]]
            out.append([*around, self.keys[k]] if self.names[k] in REGIONS else around)
        return out


def marked_name(name: str, in_article: bool = False) -> bool:
    """Whether one whole class, id or role marks what is around the main text."""
    marks = MARKS if in_article else MARKS | OUTER_MARKS
    if name in marks:
        return True
    parts = {p for p in _PARTS.split(name) if p}
    return not parts.isdisjoint(marks) and parts <= marks | {"site"}


def element(name: str, attributes: str, in_article: bool = False) -> tuple[str, int]:
    """The element's role on a path (name and class names) and whether it is off the main
    text: 0 not, 1 by a mark or as a form, 2 by its name or hidden.  An article's own header
    is part of it."""
    mark = hidden = False
    classes = ""
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id", "role"):
            mark = mark or any(marked_name(v, in_article) for v in value.split())
            if key == "class":
                classes = ".".join(sorted(_DIGITS.sub("#", value).split()))
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            hidden = True
        elif key == "style" and _NO_DISPLAY.search(value):
            hidden = True
    if name in ("html", "body", *MAIN):
        off = 0
    elif hidden or name in ASIDE and name != "form" and not (in_article and name == "header"):
        off = 2
    else:
        off = int(mark or name == "form")
    return (f"{name}.{classes}" if classes else name), off


def _asides(names: list[str], parents: list[int], offs: list[int], chars: list[int]) -> list[bool]:
    """Whether each element, given after its parent, is off the main text, itself or by an
    element around it.

    What holds the largest article or main element never turns it off, and a mark or form
    does not if more than half of the text outside hidden and other off elements is in it.
    """
    inside = chars.copy()
    for k in range(len(names) - 1, 0, -1):
        inside[parents[k]] += inside[k]
    holds: set[int] = set()
    mains = [k for k, name in enumerate(names) if name in MAIN]
    at = max(mains, key=inside.__getitem__) if mains else 0
    while at:
        at = parents[at]
        holds.add(at)
    hard, seen, total = [False], chars.copy(), chars[0]
    for k in range(1, len(names)):
        hard.append(hard[parents[k]] or offs[k] == 2 and k not in holds)
        seen[k] = 0 if hard[k] else chars[k]
        total += seen[k]
    for k in range(len(names) - 1, 0, -1):
        seen[parents[k]] += seen[k]
    out = [False]
    for k in range(1, len(names)):
        marked = offs[k] == 1 and k not in holds and 2 * seen[k] <= total
        out.append(hard[k] or marked or out[parents[k]])
    return out


def parse(page: str | None) -> Page:
    """The page's elements and its text blocks in order.

    Unclosed elements are closed as HTML says for paragraphs, items and cells; an end tag
    without a start is ignored, and the end of a block element closes what is open inside.
    A block's text is one block with the inline elements in it, but for those that are off the
    main text (a hidden span, a drawing): theirs is a block of their own, booked on them.
    """
    out = Page([""], [""], [0], [0], [False], [])
    if not page:
        return out
    stack: list[int] = [0]
    offs, chars = [0], [0]
    children: list[Counter] = [Counter()]
    within = [False]  # whether an element is, or is in, an article or main element
    owner = [0]  # the inline element off the main text that an element is in, inside its block
    parts: list[tuple[int, str]] = []

    def flush() -> None:
        own: dict[int, list[str]] = {0: []}
        for k, part in parts:
            own.setdefault(k, []).append(part)
        parts.clear()
        block = next(k for k in reversed(stack) if k == 0 or out.names[k] in BLOCKS) if len(own) > 1 else stack[-1]
        for k, texts in own.items():
            text = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
            if text:
                chars[k or block] += len(text)
                out.blocks.append((k or block, text))

    at, end = 0, len(page)
    while at < end:
        tag = page.find("<", at)
        match = _TOKEN.match(page, tag) if tag >= 0 else None
        if tag < 0:
            parts.append((owner[stack[-1]], page[at:]))
            break
        if not match:
            parts.append((owner[stack[-1]], page[at : tag + 1]))
            at = tag + 1
            continue
        parts.append((owner[stack[-1]], page[at:tag]))
        at = match.end()
        closing, name, attributes = match.group(1), match.group(2), match.group(3)
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if out.names[stack[k]] == name:
                    del stack[k:]
                    break
                if name not in BLOCKS and out.names[stack[k]] in BLOCKS:
                    break  # an inline element does not end the block it is in
            continue
        for k in range(len(stack) - 1, 0, -1):
            if out.names[stack[k]] in CLOSES.get(name, ()):
                flush()
                del stack[k:]
                break
            if out.names[stack[k]] in FENCES:
                break
        parent = stack[-1]
        role, off = element(name, attributes or "", within[parent])
        children[parent][role] += 1
        place = f"{out.keys[parent]}/{role}#{children[parent][role]}"
        out.names.append(name)
        out.roles.append(role)
        out.parents.append(parent)
        out.keys.append(xxhash.xxh3_64_intdigest(place.encode("utf-8", "surrogatepass")) - (1 << 63))
        offs.append(off)
        within.append(within[parent] or name in MAIN)
        owner.append(0 if name in BLOCKS else len(out.names) - 1 if off else owner[parent])
        chars.append(0)
        children.append(Counter())
        if name in VOID or (attributes or "").endswith("/") and name not in BLOCKS:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        stack.append(len(out.names) - 1)
    flush()
    out.aside = _asides(out.names, out.parents, offs, chars)
    return out


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.when(host != "", host)


def page_mark(page: int) -> tuple[int, int]:
    """Two numbers whose sums over pages stand for a set of pages."""
    page = xxhash.xxh3_64_intdigest(page.to_bytes(8, "little", signed=True))
    return page & 0xFFFFFFFF, page >> 32


def text_code(text: str) -> int:
    """A text's number as a token, never 0."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 | 1


_TOKENS = (
    "host string, key long, text long, on long, v1 long, v2 long, chars long, heads long, "
    "region boolean, around array<long>"
)


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens of the pages of each host, with what they add to the occurrence vector.

    A token is an element in its place (``text`` 0), or a text in its place.  A text in what
    is plainly not main text is no token; ``heads`` is 1 for a text in an ``h1``.
    """
    for batch in batches:
        found: dict[tuple[str, int, int], list] = {}
        for host, mark, source in zip(batch["host"], batch["page"], batch["html"]):
            page = parse(source)
            around, (v1, v2) = page.regions(), page_mark(mark)
            here = {(page.keys[k], 0): (0, 0, k) for k in range(1, len(page.names))}
            for k, text in page.blocks:
                if not page.aside[k]:
                    here[page.keys[k], text_code(text)] = (len(text), int(page.names[k] == "h1"), k)
            for (key, code), (chars, heads, k) in here.items():
                row = found.get((host, key, code))
                if row:
                    row[0] += 1
                    row[1] += v1
                    row[2] += v2
                else:
                    region = not code and page.names[k] in REGIONS
                    found[host, key, code] = [1, v1, v2, chars, heads, region, around[k]]
        yield pd.DataFrame(
            [(*k, *v) for k, v in found.items()],
            columns=["host", "key", "text", "on", "v1", "v2", "chars", "heads", "region", "around"],
        )


def scan_tokens(pages: DataFrame) -> DataFrame:
    """The tokens of pages (host, page, html), summed by batch."""
    return pages.select("host", "page", "html").mapInPandas(_tokens, _TOKENS)


def choose_region(rows: list[tuple[int, list[int], int, int, int]]) -> list[int]:
    """The template's regions around the main text, outermost first; [] if there are none.

    A row is a region of the template: key, keys around it and its own, characters of
    different texts in it, different ``h1`` texts in it, pages it is on.  From the page down,
    the region is taken that has more than half of the texts of the one around it, unless
    that leaves behind a heading of its own on half the pages.  A text that comes back page
    after page counts once, so what repeats weighs little.
    """
    known = {r[0]: r for r in rows}
    below: dict[int, list] = {}
    for r in rows:
        outer = next((k for k in reversed(r[1][:-1]) if k in known), 0)
        below.setdefault(outer, []).append(r)
    path, here = [], 0
    chars, heads = sum(r[2] for r in below.get(0, ())), sum(r[3] for r in below.get(0, ()))
    while below.get(here):
        best = max(below[here], key=lambda r: (r[2], -r[0]))
        if 2 * best[2] <= chars or heads > best[3] and 2 * (heads - best[3]) >= best[4]:
            break
        here, chars, heads = best[0], best[2], best[3]
        path.append(here)
    return path


def same_pages(counts: tuple[str, str]) -> Column:
    """Tokens of one vector are on equally many pages, or the sums of hashes agree by chance."""
    return F.col(counts[0]) == F.col(counts[1])


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, regions, fixed): the regions of each host's template around its main text, and
    the template's texts as (place, text) numbers.

    Tokens of a host that stand on the same pages - with the same occurrence vector - are an
    equivalence class.  A class is valid if it has ``CLASS_TOKENS`` tokens and stands on two
    pages, and on one of ``CLASS_PAGES``, at least.
    The elements of valid classes are the template; they nest by their places, and what
    stands between them are its slots, weighed by their texts.  ``choose_region`` goes down
    from region to region.  Texts of valid classes are template too if they are on more than
    half of the host's pages, and ``TEXT_PAGES`` at least: a text that only some copies of an
    article share is none.

    Vectors are compared by sums of page hashes, so a host of any size is summed by partial
    aggregation; only regions of valid classes, few however many pages a host has, meet in
    one group.
    """
    tokens = materialize(
        scan_tokens(pages.where("host is not null"))
        .groupBy("host", "key", "text").agg(
            *[F.sum(c).alias(c) for c in ("on", "v1", "v2")],
            *[F.first(c).alias(c) for c in ("chars", "heads", "region", "around")],
        ),
        "page-tokens",
    )
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    standing = (
        tokens.join(sizes, "host")
        .where(f"on >= 2 and {CLASS_PAGES} * on >= pages")
        .select("host", "key", "text", "on", "v1", "v2", "region", "around", "pages")
    )
    classes = (
        standing.groupBy("host", "v1", "v2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("on").alias("low"), F.max("on").alias("high"))
        .where(F.col("n") >= CLASS_TOKENS)
        .where(same_pages(("low", "high")))
        .select("host", "v1", "v2")
    )
    fixed = standing.where("region").join(classes, ["host", "v1", "v2"])
    texts = tokens.where("text <> 0").groupBy("host", "key").agg(
        F.sum("chars").alias("chars"), F.sum("heads").alias("heads"), F.first("around").alias("around")
    )
    held = (
        texts.select("host", "chars", "heads", F.explode("around").alias("key"))
        .groupBy("host", "key")
        .agg(F.sum("chars").alias("chars"), F.sum("heads").alias("heads"))
    )

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        around = [list(map(int, a)) for a in rows["around"]]
        path = choose_region(list(zip(rows["key"], around, rows["chars"], rows["heads"], rows["on"])))
        return pd.DataFrame({"host": [key[0]], "regions": [path]})

    texts_of = (
        standing.where(f"text <> 0 and on >= {TEXT_PAGES} and 2 * on > pages")
        .join(classes, ["host", "v1", "v2"])
        .groupBy("host")
        .agg(F.collect_list(F.array("key", "text")).alias("fixed"))
    )
    regions = (
        fixed.join(held, ["host", "key"])
        .select("host", "key", "around", "chars", "heads", "on")
        .groupBy("host")
        .applyInPandas(choose, "host string, regions array<long>")
    )
    return regions.join(texts_of, "host", "left")


def main_region(page: Page, regions: list[int]) -> set[int]:
    """The elements that hold the page's main text: the innermost of the template's regions
    that has text, or the whole page.

    Where that is inside an article or main element, or around one, that element is taken,
    with those beside it of the same role; the largest, if there are several.
    """
    chars = [0] * len(page.names)
    for k, text in page.blocks:
        chars[k] += 0 if page.aside[k] else len(text)
    for k in range(len(page.names) - 1, 0, -1):
        chars[page.parents[k]] += chars[k]
    place = {key: k for k, key in enumerate(page.keys)}
    found = next((place[key] for key in reversed(regions) if key in place and chars[place[key]]), 0)
    mains = [[k for k in range(len(page.names)) if page.names[k] == name and chars[k]] for name in MAIN]
    mains = next((m for m in mains if m), [])
    if not mains:
        return {found}
    here, outer, k = page.inside({found}), {0}, found
    while k:
        outer.add(k)
        k = page.parents[k]
    best = max(mains, key=lambda k: (k in outer, here[k], chars[k], -k))
    if best not in outer and not here[best]:
        return {found}
    return {k for k in mains if page.parents[k] == page.parents[best] and page.roles[k] == page.roles[best]}


def main_text(source: str | None, regions: list[int] | None, fixed: set[tuple[int, int]] | None = None) -> str:
    """Main text of one page, given the regions that its host's template has around it and
    the template's own texts.

    Inside the region, what is marked as something else - menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, comments - is left out by element or by whole class,
    id or role, but never what holds the largest article or, by a mark, most of the text.
    What the slots hold remains: texts of the template go, unless nothing else is there.
    """
    page = parse(source)
    if not page.blocks:
        return ""
    inside = page.inside(main_region(page, regions or []))
    texts = [(k, text) for k, text in page.blocks if inside[k] and not page.aside[k]]
    if fixed:
        own = [(k, text) for k, text in texts if (page.keys[k], text_code(text)) not in fixed]
        texts = own or texts
    return " ".join(text for _, text in texts)


def slot_texts(source: str | None, regions: list[int] | None) -> dict[str, str]:
    """All slots of one page: place of the element (names and numbers) to the text directly
    in it; those of the main text are marked by a leading ``*``."""
    page = parse(source)
    inside = page.inside(main_region(page, regions or [])) if page.blocks else []
    out: dict[str, str] = {}
    for k, text in page.blocks:
        names, at = [], k
        while at:
            twins = [j for j in range(1, at + 1) if page.parents[j] == page.parents[at] and page.roles[j] == page.roles[at]]
            names.append(f"{page.roles[at]}#{len(twins)}")
            at = page.parents[at]
        place = "*" * (inside[k] and not page.aside[k]) + "/".join(reversed(names))
        out[place] = f"{out[place]} {text}" if place in out else text
    return out


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null and empty pages have the text ''.  A page that no template fits - it has no host,
    or is the only one there - is read whole but for what is marked.
    Repeated rows each have a result.  An empty table gives an empty result.  A page of any
    length is read whole, in one pass over its tags.
    The templates are one row a host: counted first, they are broadcast up to ``MAX_HOSTS``,
    so that pages do not move; beyond that both sides shuffle and AQE splits a host that
    holds many pages.
    """
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    scanned = keyed.select("host", F.xxhash64("page_id", "url").alias("page"), "html")
    templates = materialize(host_templates(scanned), "templates")
    if templates.limit(MAX_HOSTS + 1).count() <= MAX_HOSTS:
        templates = F.broadcast(templates)

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, regions, fixed in batches:
            found = [
                main_text(
                    h,
                    None if r is None else list(map(int, r)),
                    None if f is None else {(int(key), int(code)) for key, code in f},
                )
                for h, r, f in zip(sources, regions, fixed)
            ]
            yield pd.Series(found, dtype=object)

    text = keyed.join(templates, "host", "left").withColumn("text", read("html", "regions", "fixed"))
    return text.select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
