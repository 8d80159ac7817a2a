"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and texts, nested as the tags say. The wrapper of a
host is an expression over such streams with fixed tags, fixed texts, text
slots, repeated groups and optional groups, and no unions. It starts as the
first page and is aligned with one page after the other: equal tags match and
their contents are aligned in turn; what matches nothing becomes optional;
neighbouring equal groups become one repeated group; unequal texts become a
slot. Two wrappers are aligned in the same way, so tasks fold the pages they
read, and their wrappers are folded per host in two steps, the first of which
spreads a host with very many pages. A wrapper's size follows the variety of a
host's templates, not its number of pages, and no page leaves its task for it.

Each text position of the wrapper is then main text or not: not main are menus,
headers, footers, sidebars, notices, adverts, forms, comments and their like,
by element and by class, id or role; texts outside any article that are the
same on all pages; and, where a host marks its articles, all that is outside
them. Without such marks the container with the most varying text is the main
one. Every page is read by the decisions of its host's wrapper; a page in which
they find nothing, though it has other text, is read by a wrapper of its own.

Cases: NULL html and html without main text give the empty text. Unclosed,
misnested and cut-off markup is read as far as it goes. A URL without a host,
or a NULL one, belongs to the host "". Repeated rows and ids are read one by
one. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymart.llm.common import pieces
from quaymart.session import stage

SPREAD = 32              # parts into which the first fold spreads a host
FEW = 3                  # different pages it takes to call a text fixed
MAX_PERIOD = 4           # longest repeated group, in neighbouring elements
MAX_DEPTH = 60           # deeper elements count as part of the one at this depth
WINDOW = 1 << 12         # longer tags are read from quote to quote

# Elements of HTML by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead title tr ul""".split())
CLOSES = {  # an element of the key's kind ends open ones of these kinds
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
SCOPES = frozenset("ul ol dl table td th article section main body div".split())
NOT_MAIN = frozenset("""head nav header footer aside form script style noscript template select button textarea iframe svg
    object canvas audio video menu dialog input label""".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
NOT_MAIN_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav
    navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside side rail notice notices alert cookie cookies
    consent gdpr popup modal overlay newsletter subscribe subscription signup login register share sharing social related
    recommended recommendations trending comment comments reply replies disqus respond discussion search widget toolbar pagination pager
    skip hidden form""".split())
# Layout elements, and those of the words above that a layout around the main text may carry, too.
WRAPPERS = frozenset("div section td table tbody tr center".split())
SIDE_WORDS = frozenset("sidebar aside side rail search widget share form discussion".split())
MOSTLY = 4               # a layout element is opened by its text alone if it has so many times the text kept without it
MAIN_WORDS = frozenset("article articlebody post entry story maincontent main content".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.IGNORECASE)
_WORDS = re.compile(r"[a-zA-Z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_OPENS = re.compile(r"<(/?)[a-zA-Z]")
_NAME_END = re.compile(r"[\s/>]")
_MARK = re.compile(r"""[>"']""")


class _Tags:
    """The tags of a page, of any length.

    A long tag is followed from quote to quote. Quotes from which no tag ends
    are remembered and the first search of each kind is kept until it is
    passed, so reading a page takes time in proportion to it.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.endless: set[int] = set()
        self.found: dict[re.Pattern, tuple[int, int]] = {}

    def _next(self, pattern: re.Pattern, at: int) -> int:
        low, high = self.found.get(pattern, (0, -1))
        if not low <= at <= high:
            m = pattern.search(self.page, at)
            high = m.start() if m else len(self.page)
            self.found[pattern] = at, high
        return high

    def at(self, lt: int) -> tuple[bool, str, str, int] | None:
        """Whether it is an end tag, name, rest, and end of the tag that begins at ``lt``."""
        m = _TAG.match(self.page, lt, lt + WINDOW)
        if m:
            return bool(m[1]), m[2].lower(), m[3], m.end()
        m = _OPENS.match(self.page, lt)
        if m is None or self.last < lt:
            return None
        page, name_end = self.page, self._next(_NAME_END, m.end())
        mark, passed = self._next(_MARK, name_end), []
        while mark < len(page) and page[mark] != ">":
            close = -1 if mark in self.endless else page.find(page[mark], mark + 1)
            passed.append(mark)
            after = _MARK.search(page, close + 1) if close >= 0 else None
            mark = after.start() if after else len(page)
        if mark == len(page):
            self.endless.update(passed)
            return None
        return bool(m[1]), page[m.end() - 1:name_end].lower(), page[name_end:mark], mark + 1


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is "start", "end" or "text"; comments, scripts and styles are left out."""
    at, n, text_from = 0, len(page), 0
    tags = _Tags(page)
    while True:
        lt = page.find("<", at)
        if lt < 0:
            break
        follows = page[lt + 1:lt + 2]
        if follows in ("!", "?"):
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                end = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                end = n if end < 0 else end + 1
            if lt > text_from:
                yield "text", "", page[text_from:lt]
            at = text_from = end
            continue
        tag = tags.at(lt) if follows == "/" or follows.isalpha() else None
        if tag is None:
            if (follows == "/" or follows.isalpha()) and tags.last < lt:
                # A tag that never ends: the page was cut off here.
                if lt > text_from:
                    yield "text", "", page[text_from:lt]
                return
            at = lt + 1
            continue
        if lt > text_from:
            yield "text", "", page[text_from:lt]
        ends, name, rest, at = tag
        yield ("end" if ends else "start"), name, rest
        text_from = at
        if not ends and name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, at)
            end = close.start() if close else n
            if name not in ("script", "style") and end > at:
                yield "text", "", page[at:end]
            at = text_from = end
    if n > text_from:
        yield "text", "", page[text_from:]


def label(name: str, rest: str) -> str:
    """Element name with its class, id and role words."""
    found = []
    if rest and ("=" in rest or "hidden" in rest.lower()):
        for m in _ATTR.finditer(rest):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                found.append("hidden")
            elif key == "role":
                found.append("role-" + value.strip().lower())
            elif key != "aria-hidden":
                # Digits tell items of one kind apart, not kinds.
                found += [w.lower() for part in value.split() for w in _WORDS.findall(_CAMEL.sub(" ", part))]
    return name + "".join("." + w for w in dict.fromkeys(found))


class Leaf:
    """A text: the path of labels above it, whether it starts a new block, the raw text."""

    __slots__ = ("path", "fresh", "text")

    def __init__(self, path: tuple[str, ...], fresh: bool, text: str):
        self.path, self.fresh, self.text = path, fresh, text


def parse(page: str) -> tuple[dict, list[Leaf]]:
    """The page as a tree of nodes for the wrapper, and its texts in order."""
    root = {"k": "", "c": []}
    stack = [(root, "", "")]
    path: tuple[str, ...] = ()
    leaves: list[Leaf] = []
    fresh = True

    def pop_to(depth: int) -> None:
        nonlocal path, fresh
        while len(stack) > depth:
            _, name, _ = stack.pop()
            fresh = fresh or name in BLOCK
        path = path[: min(len(path), max(len(stack) - 1, 0))]

    for kind, name, rest in tokens(page):
        if kind == "text":
            if rest.strip():
                leaves.append(Leaf(path, fresh, rest))
                fresh = False
                stack[-1][0]["c"].append({"k": "#", "t": " ".join(entities.unescape(rest).split()), "c": []})
            elif leaves and not fresh:
                leaves.append(Leaf(path, False, " "))
            continue
        if kind == "end":
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] == name:
                    pop_to(depth)
                    break
                if name not in BLOCK and stack[depth][1] in BLOCK:
                    break       # an inline end tag ends nothing beyond its block
            fresh = fresh or name in BLOCK
            continue
        if name in VOID:
            if name == "br" and leaves and not fresh:
                leaves.append(Leaf(path, False, " "))
            fresh = fresh or name in BLOCK
            continue
        ends = CLOSES.get(name) or ({"p"} if name in BLOCK else ())
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] in ends:
                    pop_to(depth)
                elif stack[depth][1] in SCOPES:
                    break
        fresh = fresh or name in BLOCK
        key = label(name, rest)
        if len(stack) <= MAX_DEPTH:
            node = {"k": key, "c": []}
            stack[-1][0]["c"].append(node)
            path = path + (key,)
            stack.append((node, name, key))
        else:
            stack.append((stack[-1][0], name, key))
    return root, leaves


# A wrapper node: k label ("#": text), c contents, o optional, r repeated, n pages, and for texts
# t the fixed text (None: a slot) and m characters over all pages.


def _seed(node: dict) -> dict:
    out = {"k": node["k"], "c": _folded([_seed(c) for c in node["c"]]), "o": False, "r": False, "n": 1}
    if node["k"] == "#":
        out |= {"t": node["t"], "m": len(node["t"])}
    return out


def _merge(a: dict, b: dict, same_page: bool) -> dict:
    """One node for two that match; in one page they are rounds of a repeated group."""
    out = {"k": a["k"], "c": _align(a["c"], b["c"], same_page), "o": a["o"] or b["o"], "r": a["r"] or b["r"] or same_page,
           "n": max(a["n"], b["n"]) if same_page else a["n"] + b["n"]}
    if a["k"] == "#":
        out |= {"t": a["t"] if a["t"] == b["t"] else None, "m": a["m"] + b["m"]}
    return out


def _folded(nodes: list[dict]) -> list[dict]:
    """Neighbouring equal groups of up to MAX_PERIOD elements become one repeated group."""
    out: list[dict] = []
    for node in nodes:
        out.append(node)
        for period in range(1, MAX_PERIOD + 1):
            if len(out) >= 2 * period and all(x["k"] == y["k"] for x, y in zip(out[-2 * period:-period], out[-period:])):
                group = [_merge(x, y, True) for x, y in zip(out[-2 * period:-period], out[-period:])]
                out[-2 * period:] = group
                break
    return out


def _align(a: list[dict], b: list[dict], same_page: bool) -> list[dict]:
    """Match as many nodes as possible in order; the others become optional."""
    if [x["k"] for x in a] == [y["k"] for y in b]:
        return [_merge(x, y, same_page) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["k"] == b[j]["k"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i]["k"] == b[j]["k"]:
            out.append(_merge(a[i], b[j], same_page))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(a[i] | {"o": True})
            i += 1
        else:
            out.append(b[j] | {"o": True})
            j += 1
    return _folded(out)


def align(a: dict | None, b: dict) -> dict:
    """The wrapper for all that either of two wrappers matches."""
    return b if a is None else _merge(a, b, False)


def seed(root: dict) -> dict:
    return _seed(root)


def expression(node: dict) -> str:
    """The wrapper as a regular expression, for people."""
    if node["k"] == "#":
        body = "#text" if node["t"] is None else repr(node["t"])
    else:
        inner = " ".join(expression(c) for c in node["c"])
        body = f"<{node['k']}> {inner} </>".replace("  ", " ") if node["k"] else inner
    body = f"({body})" if (node["r"] or node["o"]) else body
    return body + ("+" if node["r"] else "") + ("?" if node["o"] else "")


def _parts(key: str) -> list[str]:
    return key.split(".")


def not_main(key: str) -> bool:
    name, *words = _parts(key)
    if name in NOT_MAIN:
        return True
    if name in ("html", "body", "article", "main"):
        return "comment" in words or "hidden" in words
    return any(w in NOT_MAIN_WORDS or (w.startswith("role-") and w[5:] in NOT_MAIN_ROLES) for w in words)


def marks_article(key: str) -> int:
    """How clearly an element marks the article: 3 by element, 2 by role or property, 1 by class."""
    name, *words = _parts(key)
    if name in ("article", "main"):
        return 3 if name == "article" else 2
    if "role-main" in words or "articlebody" in words or ("article" in words and "body" in words):
        return 2
    return int(name in ("div", "section", "td") and any(w in MAIN_WORDS for w in words))


def only_by_words(key: str) -> bool:
    """Whether a layout element is not main by a word of its class or id alone."""
    name, *words = _parts(key)
    return name in WRAPPERS and "hidden" not in words and not any(w.startswith("role-") and w[5:] in NOT_MAIN_ROLES for w in words)


def _opened(texts: list[tuple[tuple[str, ...], dict, tuple]], pages: int) -> set[int]:
    """The element whose word is not heeded, since it is the layout around the main text, and those between.

    It holds an article (or the like) clearer than any outside such elements, of
    more text than is kept without it; or, if no article is left, by far most of
    the text, and its words are those of a layout with a side column.
    """
    level = max((marks_article(k) for path, _, barred in texts if not barred for k in path), default=0)
    kept = sum(t["m"] for path, t, barred in texts if not barred and (not level or any(marks_article(k) == level for k in path)) and _varies(path, t, pages))
    marked: dict[int, int] = {}
    filled: dict[int, int] = {}
    between: dict[int, set[int]] = {}
    for path, text, barred in texts:
        if not barred:
            continue
        outer = barred[0][1]
        top = max(marks_article(k) for k in path)
        if top >= 2 and top > level:
            first = next(i for i, k in enumerate(path) if marks_article(k) == top)
            if all(i <= first for i, _ in barred):
                marked[outer] = marked.get(outer, 0) + text["m"]
                between.setdefault(outer, set()).update(i for _, i in barred)
        words = set(_parts(path[barred[0][0]])[1:]) & NOT_MAIN_WORDS
        if len(barred) == 1 and words <= SIDE_WORDS and _varies(path, text, pages):
            filled[outer] = filled.get(outer, 0) + text["m"]
    best = max(marked, key=marked.__getitem__, default=None)
    if best is not None and marked[best] > kept:
        return between[best]
    best = max(filled, key=filled.__getitem__, default=None)
    return {best} if level < 3 and best is not None and filled[best] > MOSTLY * kept else set()


def _varies(path: tuple[str, ...], text: dict, pages: int) -> bool:
    """No link, and not the same on all pages."""
    return not (text["t"] is not None and text["n"] >= FEW and text["n"] == pages) and "a" not in [_parts(k)[0] for k in path]


def main_paths(wrapper: dict) -> list[list[str]]:
    """The paths of labels under which texts are main."""
    # With each text, the depths and ids of elements above it that are not main by their words alone.
    found: list[tuple[tuple[str, ...], dict, tuple]] = []

    def walk(node: dict, path: tuple[str, ...], barred: tuple) -> None:
        for child in node["c"]:
            if child["k"] == "#":
                found.append((path, child, barred))
            # The header of an article holds its title; any other header is the page's.
            elif not not_main(child["k"]) or (child["k"] == "header" and any(_parts(k)[0] == "article" for k in path)):
                walk(child, path + (child["k"],), barred)
            elif only_by_words(child["k"]):
                walk(child, path + (child["k"],), (*barred, (len(path), id(child))))

    walk(wrapper, (), ())
    while opened := _opened(found, wrapper["n"]):
        found = [(p, t, tuple(x for x in barred if x[1] not in opened)) for p, t, barred in found]
    texts = [(p, t) for p, t, barred in found if not barred]
    pages = wrapper["n"]
    best = max((marks_article(k) for path, _ in texts for k in path), default=0)
    if best:
        inside = [(p, t) for p, t in texts if any(marks_article(k) == best for k in p)]
        return sorted({p for p, _ in inside})
    varying = [(p, t) for p, t in texts if not (t["t"] is not None and t["n"] >= FEW and t["n"] == pages)]
    weight: dict[tuple[str, ...], int] = {}
    for path, text in varying:
        if "a" in [_parts(k)[0] for k in path]:
            continue
        holder = path
        while holder and _parts(holder[-1])[0] in ("p", "b", "i", "em", "strong", "span", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "blockquote", "pre", "u", "code", "small", "sup", "sub", "font"):
            holder = holder[:-1]
        weight[holder] = weight.get(holder, 0) + text["m"]
    if not weight:
        return []
    top = max(weight, key=lambda p: (weight[p], p))
    return sorted({p for p, _ in varying if p[: len(top)] == top})


def main_text(leaves: list[Leaf], paths: set[tuple[str, ...]]) -> str:
    """The blocks of main text of a page, one a line."""
    blocks: list[list[str]] = []
    for leaf in leaves:
        # A text that is not main still ends the block, if one begins with it.
        if leaf.fresh or not blocks:
            blocks.append([])
        if leaf.path in paths:
            blocks[-1].append(leaf.text)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
    return "\n".join(x for x in lines if x)


def own_paths(page_tree: dict) -> set[tuple[str, ...]]:
    return {tuple(p) for p in main_paths(seed(page_tree))}


def extract(page: str, paths: set[tuple[str, ...]]) -> str:
    """Main text of one page by its host's decisions, or by its own where those find nothing."""
    root, leaves = parse(page)
    # Paths that the host's wrapper has seen decide; a page below MAX_DEPTH of them has none left out.
    return main_text(leaves, paths) or (main_text(leaves, own_paths(root)) if leaves else "")


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, dict] = {}
    for batch in batches:
        for part in pieces(batch, "html"):
            for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                if page:
                    wrappers[host] = align(wrappers.get(host), seed(parse(page)[0]))
        if len(wrappers) > 1000:
            yield _rows(wrappers)
            wrappers = {}
    if wrappers:
        yield _rows(wrappers)


def _rows(wrappers: dict[str, dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(wrappers)), pa.array([json.dumps(w) for w in wrappers.values()])], ["host", "wrapper"])


def _fold(table: pa.Table) -> pa.Table:
    wrapper = None
    for text in sorted(table.column("wrapper").to_pylist()):
        wrapper = align(wrapper, json.loads(text))
    return pa.table({"host": table.column("host")[:1], "wrapper": pa.array([json.dumps(wrapper)])})


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON): one wrapper per host of ``pages`` (url, html)."""
    rows = pages.select(host_of().alias("host"), "html").mapInArrow(_infer, "host string, wrapper string")
    some = rows.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(SPREAD))).groupBy("host", "part").applyInArrow(_fold, "host string, wrapper string")
    return some.groupBy("host").applyInArrow(_fold, "host string, wrapper string")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rules = [json.dumps(main_paths(json.loads(w))) for w in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(rules, pa.string())], ["of", "rules"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[tuple[str, ...]]] = {}
    for batch in batches:
        for part in pieces(batch, "html"):
            texts = []
            for page, rules in zip(part.column("html").to_pylist(), part.column("rules").to_pylist()):
                rules = rules or "[]"
                if rules not in known:
                    if len(known) > 5000:
                        known.clear()
                    known[rules] = {tuple(p) for p in json.loads(rules)}
                texts.append(extract(page, known[rules]) if page else "")
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages`` (page_id, url, html)."""
    rules = stage(wrappers(pages).mapInArrow(_decide, "of string, rules string"))
    known = pages.select("page_id", "url", "html", host_of().alias("host"))
    # The side of one row per host may be broadcast if the planner finds it small; else a hot host's pages are split.
    return known.join(rules, F.col("host") == F.col("of"), "left").select("page_id", "url", "html", "rules").mapInArrow(
        _extract, "page_id bigint, url string, text string")
