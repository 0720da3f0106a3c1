"""Main text of web pages by deducing the template of each host.

Tokens of a page are its tags, told apart by their path of element names,
classes and ids, and its text runs.  A token's occurrence vector counts it on
every page of its host; tokens with equal vectors form an equivalence class.  A
class is part of the template if it has several tokens and occurs on at least
half of the host's pages.  Paths nest the classes into each other.  The slot
that holds the article is the innermost once-a-page element of the template with
at least half of the host's text.  Text runs below the slot that belong to its
own class or to any class nested in it are template too, on the pages that hold
them and however often they stand there; the rest of the slot is the result.
Pages that are copies of each other share their articles as well, so a class on
k pages counts only if all text shared by so many pages is at most 1 - 1 / (k - 1)
of the slot's.

Vectors are compared by sums of hashes of (page, count), so a class costs two
numbers however many pages a host has, and everything is aggregated before it
is shuffled; only the few template rows of each host meet its pages again.
Pages without a usable host template fall back to their own article or main
element, then to the body.

Menus, headers, footers, sidebars, notices, adverts, forms and comments are
also known by element names and by class, id and role, as a hint: a whole class
name or a compound of known words counts ("share-bar", not "has-sidebar"), and
an element that holds the slot, the page's largest article or main element or,
without one, most of the page's text stays.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raremine.llm.store import if_small, written

#: Part of a host's pages on which a template class occurs.
MIN_SHARE = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul xmp".split())
#: Elements whose content is no text of the page; VERBATIM content is text as it stands.
RAW = frozenset("script style noscript template iframe svg textarea noembed noframes annotation annotation-xml".split())
VERBATIM = frozenset({"xmp"})
BOILER_TAGS = RAW | frozenset("head nav footer aside form button select dialog menu datalist canvas audio video".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices popup modal overlay comment comments disqus reply replies respond sidebar sidebars "
    "menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended newsletter "
    "subscribe subscription signup login search pagination pager skip widget widgets navigation contentinfo complementary".split())
#: Words that make no other thing of a name of BOILER_WORDS.
PART_WORDS = frozenset(
    "area bar block body box btn button buttons bottom center column container count desktop field footer form group header holder icon "
    "icons inner input item items left link links list main mobile outer page panel post posts primary right row secondary section site "
    "slot small space text thread title toggle top unit wrap wrapper x zone".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Hints: by name, a section by its id alone, by element, and never text.
BY_NAME, SECTION_ID, BY_TAG, NEVER = 1, 2, 3, 4
CLOSED_BY_SIBLING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "tbody", "thead"},
    "thead": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "option": {"select", "datalist"}, "optgroup": {"select"}}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']*(?:\"[^\"]*\"|'[^']*'))*[^>\"']*>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def host_of(url: str | None) -> str | None:
    m = _HOST.match(url or "")
    return m[1].lower() if m else None


def _is_boiler(name: str) -> bool:
    """Whether a class name or id is a word for boilerplate or a compound of
    such words and parts of pages."""
    words = {w.lower() for w in _WORD.findall(name)}
    return bool(words & BOILER_WORDS) and words <= BOILER_WORDS | PART_WORDS


class Page:
    """Elements and text blocks of a page, outside boilerplate by name;
    ``slot`` is the token of the element that holds the article, if known.

    ``elements``: (token, parent, name, depth); ``blocks``: (text, element);
    ``closing``: tokens of explicit end tags.  Unclosed and stray tags are
    tolerated, the rest of a cut-off page counts as it stands.
    """

    def __init__(self, html: str, cache: dict, slot: int | None = None):
        self.elements, self.blocks, self.closing = [], [], []
        self._cache, self._stack, self._hints = cache, [], []
        self._places: dict[str, list[int]] = {}          # places of the open elements of each name in the stack
        self._parts, self._raw = [], []
        self._parse(html)
        self._assemble(slot)

    def _token(self, parent: int, name: str, attributes: str) -> tuple[int, bool, bool]:
        """Token of an element; whether class or role, and whether the id, name
        boilerplate."""
        key = (parent, name, attributes)
        if key not in self._cache:
            named = sorted((m[1].lower(), m[2].strip("\"' ")) for m in _NAMED.finditer(attributes))
            shape = re.sub(r"[0-9]+", "0", "".join(f"[{a}={v}]" for a, v in named))
            if len(self._cache) > 50_000:
                self._cache.clear()
            self._cache[key] = (xxhash.xxh64_intdigest(f"{parent}/{name}{shape}") >> 1,
                                any(_is_boiler(w) for a, v in named if a != "id" for w in v.split()),
                                any(_is_boiler(v) for a, v in named if a == "id"))
        return self._cache[key]

    def _flush(self) -> None:
        if self._parts:
            self._raw.append(self._parts)
            self._parts = []

    def _open(self, name: str, attributes: str) -> None:
        if name in CLOSED_BY_SIBLING:
            self._close_sibling(name)
        elif name in BLOCK and self._stack and self.elements[self._stack[-1]][2] == "p":
            self._pop_to(len(self._stack) - 1)
        parent = self._stack[-1] if self._stack else -1
        token, by_class, by_id = self._token(self.elements[parent][0] if parent >= 0 else 0, name, attributes)
        hint = 0
        if name in RAW or name == "head":
            hint = NEVER
        elif name == "header" and not (self._places.get("article") or self._places.get("main")):
            hint = BY_TAG
        elif name in BOILER_TAGS:
            hint = BY_NAME if name == "form" else BY_TAG
        elif name not in ("html", "body", "article", "main"):
            if by_class or (by_id and name not in HEADINGS and name != "section"):
                hint = BY_NAME
            elif by_id and name == "section":
                hint = SECTION_ID
        self._places.setdefault(name, []).append(len(self._stack))
        self._stack.append(len(self.elements))
        self._hints.append(hint)
        self.elements.append((token, parent, name, len(self._stack)))

    def _assemble(self, slot: int | None) -> None:
        """Blocks of the text outside elements that hints mark for good."""
        n = len(self.elements)
        parents, names = [e[1] for e in self.elements], [e[2] for e in self.elements]
        size, plain = [0] * n, [0] * n
        for parts in self._raw:
            for text, e in parts:
                if e >= 0:
                    size[e] += len(text.strip())
        # text outside menus, footers and the like, of which an element may hold the most
        out = [False] * n
        for i in range(n):
            out[i] = self._hints[i] >= BY_TAG or (parents[i] >= 0 and out[parents[i]])
            plain[i] = 0 if out[i] else size[i]
        total = sum(plain) + sum(len(text.strip()) for parts in self._raw for text, e in parts if e < 0)
        for i in range(n - 1, -1, -1):
            if parents[i] >= 0:
                size[parents[i]] += size[i]
                plain[parents[i]] += plain[i]
        named = [i for i in range(n) if names[i] in ("article", "main") and size[i]]
        largest = sorted(named, key=lambda i: (-size[i], i))[:1]
        held = set()
        for i in largest + [i for i in range(n) if self.elements[i][0] == slot]:
            while i >= 0 and i not in held:
                held.add(i)
                i = parents[i]
        dropped, inside = [False] * n, [False] * n
        for i in range(n):
            hint, up = self._hints[i], parents[i]
            inside[i] = (up >= 0 and inside[up]) or names[i] in ("article", "main") or self.elements[i][0] == slot
            most = hint in (BY_NAME, SECTION_ID) and not named and 2 * plain[i] > total
            mine = hint and (hint == NEVER or not (i in held or most or (hint == SECTION_ID and inside[i])))
            dropped[i] = bool(mine) or (up >= 0 and dropped[up])
        for parts in self._raw:
            kept = [(text, e) for text, e in parts if e < 0 or not dropped[e]]
            text = " ".join("".join(text for text, _ in kept).split())
            if text:
                self.blocks.append((text, next(e for text, e in kept if text.strip())))

    def _pop_to(self, size: int) -> None:
        for i in self._stack[size:]:
            self._places[self.elements[i][2]].pop()
        del self._stack[size:]

    def _innermost(self, names) -> int:
        return max((self._places[x][-1] for x in names if self._places.get(x)), default=-1)

    def _close_sibling(self, name: str) -> None:
        k = self._innermost(CLOSED_BY_SIBLING[name])
        if k > self._innermost(LIMITS.get(name, ())):
            self._pop_to(k)

    def _close(self, name: str) -> None:
        if self._places.get(name):
            k = self._places[name][-1]
            self.closing.append(self.elements[self._stack[k]][0] ^ 1 << 62)
            self._pop_to(k)

    def _text(self, piece: str) -> None:
        at = self._stack[-1] if self._stack else -1
        self._parts.append((unescape(piece) if "&" in piece else piece, at))

    def _parse(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _MARKUP.search(html, at)
            if not m:
                self._text(html[at:])
                break
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if name in BLOCK:
                self._flush()
            elif name == "br":
                self._text(" ")
            if m[1]:
                self._close(name)
                continue
            if name in VOID:
                continue
            self._open(name, m[3] if "=" in m[3] else "")
            if name in RAW or name in VERBATIM:
                end = re.compile(rf"</{re.escape(name)}(?![\w-])", re.I).search(html, at)
                if name in VERBATIM:
                    self._parts.append((html[at:end.start() if end else size], self._stack[-1]))
                at = end.start() if end else size
            elif m[3].endswith("/>") and name not in BLOCK:
                self._pop_to(len(self._stack) - 1)
        self._flush()

    def inside(self, roots: set[int], fixed: set[int] = frozenset()) -> list[str]:
        """Blocks below any of the given elements, without template text."""
        within: list[bool] = []
        for i, (_, parent, _, _) in enumerate(self.elements):
            within.append(i in roots or (parent >= 0 and within[parent]))
        return [text for text, e in self.blocks
                if e >= 0 and within[e] and not (fixed and _run_token(self.elements[e][0], text) in fixed)]

    def own_slot(self) -> set[int]:
        """The page's article or main element with the most text (none: the
        whole page)."""
        size = [0] * len(self.elements)
        for text, e in self.blocks:
            if e >= 0:
                size[e] += len(text)
        for i in range(len(size) - 1, -1, -1):
            if self.elements[i][1] >= 0:
                size[self.elements[i][1]] += size[i]
        named = [i for i, x in enumerate(self.elements) if x[2] in ("article", "main") and size[i]]
        if not named:
            return set()
        best = max(named, key=lambda i: (size[i], -i))
        return {best}


def _run_token(token: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{token}:{text}") >> 1


def _page_tokens(page: Page):
    """token -> [count, kind, depth, named, parent, characters] of one page;
    token 0 stands for the page."""
    found: dict[int, list] = {0: [1, "page", 0, False, 0, sum(len(t) for t, _ in page.blocks)]}
    size = [0] * len(page.elements)
    for text, e in page.blocks:
        at = page.elements[e][0] if e >= 0 else 0
        run = found.setdefault(_run_token(at, text), [0, "text", 0, False, at, 0])
        run[0] += 1
        run[5] += len(text)
        while e >= 0:
            size[e] += len(text)
            e = page.elements[e][1]
    for i, (token, up, name, depth) in enumerate(page.elements):
        tag = found.setdefault(token, [0, "tag", depth, name in ("article", "main"), page.elements[up][0] if up >= 0 else 0, 0])
        tag[0] += 1
        tag[5] += size[i]
    for token in page.closing:
        found.setdefault(token, [0, "end", 0, False, 0, 0])[0] += 1
    return found


_TOKENS = ("host string, token long, kind string, depth int, named boolean, parent long, s1 long, s2 long, pages long, total long, chars long")


def _host_tokens(pages: DataFrame) -> DataFrame:
    """Occurrence vectors (as hash sums) of every token of every host."""
    def run(batches):
        cache: dict = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sums: dict = {}
                for url, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    host = host_of(url)
                    if host is None:
                        continue
                    name = xxhash.xxh64_intdigest((url or "") + "\0" + html)
                    for token, (count, kind, depth, named, parent, chars) in _page_tokens(Page(html, cache)).items():
                        h = xxhash.xxh64_intdigest(f"{name}:{count}")
                        row = sums.setdefault((host, token), [kind, depth, named, parent, 0, 0, 0, 0, 0])
                        for k, v in enumerate((h & 0x7FFFFFFF, h >> 33, 1, count, chars), 4):
                            row[k] += v
                rows = [(host, token, *row) for (host, token), row in sums.items()]
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), *[pa.int64()] * 6)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in _TOKENS.split(", ")])

    rows = pages.mapInArrow(run, _TOKENS)
    return rows.groupBy("host", "token", "kind").agg(
        F.max("depth").alias("depth"), F.max("named").alias("named"), F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in ("s1", "s2", "pages", "total", "chars")])


def host_template(tokens: list[dict]) -> tuple[int, list[int]] | None:
    """(slot, template text below it) of a host from its tokens on enough of its
    pages, or None without a slot."""
    size = Counter((t["s1"], t["s2"], t["pages"]) for t in tokens)
    valid = {t["token"] for t in tokens if size[t["s1"], t["s2"], t["pages"]] > 1}
    slots = [t for t in tokens if t["kind"] == "tag" and t["token"] in valid and t["total"] == t["pages"] and 2 * t["chars"] >= t["host_chars"]]
    if not slots:
        return None
    slot = max(slots, key=lambda t: (t["named"], t["depth"], t["chars"], t["token"]))
    # a parent stands on every page of its children, so all paths are here
    below = {slot["token"]}
    for t in sorted((t for t in tokens if t["kind"] == "tag"), key=lambda t: t["depth"]):
        if t["parent"] in below:
            below.add(t["token"])
    texts, shared = [], 0.0
    room = slot["chars"] / slot["pages"]
    runs = sorted((t for t in tokens if t["kind"] == "text" and t["parent"] in below), key=lambda t: -t["pages"])
    for pages, group in groupby(runs, key=lambda t: t["pages"]):
        group = list(group)
        shared += sum(t["chars"] for t in group) / pages
        if shared <= (1 - 1 / max(1, pages - 1)) * room:
            texts += sorted(t["token"] for t in group if t["token"] in valid)
    return slot["token"], texts


def deduce_templates(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, slot, texts): token of the element that holds the article and
    tokens of template text in it, for hosts with a template."""
    tokens = written(_host_tokens(pages).filter("pages > 1"), "html-tokens")
    hosts = tokens.filter("token = 0").select("host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    # a table of its own: the join may be split, and only the few rows left of a host meet
    tokens = written(tokens.filter("token <> 0").join(hosts, "host").filter(F.col("pages") >= min_share * F.col("host_pages")),
                     "html-shared")

    def deduce(table: pa.Table) -> pa.Table:
        found = host_template(table.to_pylist())
        rows = [(table.column("host")[0].as_py(), *found)] if found else []
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.int64())))],
                        names=["host", "slot", "texts"])

    # tokens on half of a host's pages: as few as a page has, so a host is a small group
    return tokens.groupBy("host").applyInArrow(deduce, "host string, slot long, texts array<long>")


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                 min_share: float = MIN_SHARE) -> DataFrame:
    """(key, url, text, n_chars) per row: the blocks of the article joined by
    newlines.

    Null and empty html give an empty text; a null url or one without a host
    leaves the page to itself; repeated rows give repeated results; an empty
    table gives an empty result; further columns are not read.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    # few rows a host; as a table of its own it is either broadcast or joined so that Spark may split a large host
    templates = if_small(written(deduce_templates(rows.select("url", "html"), min_share), "html-templates"),
                         F.size("texts") + 1)
    host = F.lower(F.regexp_extract("url", _HOST.pattern, 1))
    joined = rows.withColumn("host", F.when(F.col("url").isNotNull() & (host != ""), host)).join(templates, "host", "left")

    def run(batches):
        cache: dict = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = []
                for source, slot, texts in zip(*(part.column(c).to_pylist() for c in (2, 3, 4))):
                    page = Page(source, cache, slot)
                    roots = {i for i, e in enumerate(page.elements) if e[0] == slot} if slot is not None else set()
                    found = bool(roots)
                    roots = roots or page.own_slot()
                    blocks = page.inside(roots) if roots else [t for t, _ in page.blocks]
                    if found and texts:
                        blocks = page.inside(roots, set(texts))
                    out.append("\n".join(blocks))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                    names=["key", "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    out = joined.select("key", "url", "html", "slot", "texts").mapInArrow(run, f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
