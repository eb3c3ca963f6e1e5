"""Main text of web pages by tag-path ratios.

The text nodes of a page are grouped by their path of block tags from the root. Per path, text length and punctuation outside links
are added up; a path's ratios are its text and its punctuation per node. Ratios are smoothed over nodes next to each other in page
order, fused, and cut at a share of the mean over all text. The paths above are content, an ``article`` or ``main`` only raises
their scores. The text is that of the element that holds all content nodes, or from the first to the last of them where that
is the page itself, with the heading that stands before it; parts that by tag or class are page furniture are left out.

A page is scanned once, and its elements are kept as numbers of their parent and their path, so time and memory
follow its length, however its tags are nested or left open.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kontora.llm.common import CHUNK

# Tags of the HTML standard by their part in a page, and class words of page furniture.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style xmp".split())
HARD = frozenset("aside audio button canvas dialog footer head math menu nav object option select svg template textarea title video".split())
SOFT = frozenset("form header".split())
HEAD_TAGS = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLASS_WORDS = frozenset(
    """ad ads adbox advert advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies disclaimer
    footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted promotion
    related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split()
)
COMMENT_WORDS = frozenset("comment commentlist comments disqus replies reply respond".split())
#: Words that with a word of furniture still name furniture.
NEUTRAL = frozenset(
    """area article articles bar block body bottom box button buttons container content entry form global group icons inner item items left link links list
    main media outer page panel post posts primary right row secondary section site slot thread top unit user wrap wrapper""".split()
)
PAGE = frozenset(["", "html", "body"])
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table select body article section div".split())
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRS = re.compile(r"(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+>")
_NAMED = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
_PUNCT = re.compile(r"[.,;:!?。、，！？]")
_DIGITS = re.compile(r"[0-9]+")
#: A path within an article or main weighs so much more; a path is content from this share of the mean score on.
PRIOR, SHARE = 8.0, 0.2


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, text)`` in page order; kind is ``text``, ``open`` or ``close``, a tag's text is what stands behind its name.

    Comments and raw elements (scripts, styles) are skipped; one that is never closed takes the rest. A tag ends at the first ``>``
    outside quotes. If quotes are never closed, that tag and all later ones end at the first ``>``; what no ``>`` ends is text.
    """
    at, size, quotes = 0, len(page), True
    last = page.rfind(">")
    while at < size:
        start = page.find("<", at)
        if start < 0 or start > last:
            yield "text", "", page[at:]
            return
        if start > at:
            yield "text", "", page[at:start]
        at = start
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        tag = _TAG.match(page, at)
        if tag is None:
            if page[at + 1 : at + 2] in ("!", "?", "/"):
                at = page.find(">", at) + 1
            else:
                yield "text", "", "<"
                at += 1
            continue
        ends = _ATTRS.match(page, tag.end()) if quotes else None
        quotes = ends is not None
        stop = ends.end() if ends else page.find(">", tag.end()) + 1
        name = tag.group(1).lower()
        if page[at + 1] == "/":
            yield "close", name, ""
            at = stop
            continue
        yield "open", name, page[tag.end() : stop - 1]
        at = stop
        if name in RAW:
            closing = re.compile(f"</{name}(?![a-z0-9])", re.I).search(page, at)
            yield "close", name, ""
            at = size if closing is None else closing.start()


def _class_mark(tag: str, names: list[tuple[str, str]]) -> int:
    """0 nothing, 1 furniture, 2 readers' comments, by whole class tokens; ids of headings and sections are slugs of their titles."""
    mark = 0
    for kind, value in names:
        slug = kind == "id" and (tag in HEADINGS or tag == "section")
        for token in value.lower().split():
            words = [w for w in re.split(r"[^a-z]+", token) if w]
            if not words:
                continue
            if not COMMENT_WORDS.isdisjoint(words) and tag not in HEADINGS and all(w in COMMENT_WORDS or w in NEUTRAL or w in CLASS_WORDS for w in words):
                return 2
            if not slug and not CLASS_WORDS.isdisjoint(words) and all(w in CLASS_WORDS or w in NEUTRAL for w in words):
                mark = 1
    return mark


class Page:
    """Elements as parallel lists (tag, parent, path, mark) and text nodes: element, text, characters outside links, marks among them."""

    def __init__(self, page: str):
        self.tags, self.parents, self.paths, self.marks = [""], [-1], [0], [0]
        self.nodes: list[tuple[int, str, int, int]] = []
        ids: dict[tuple[int, str], int] = {}
        stack = [0]
        places: dict[str, list[int]] = {}  # depths of the open elements of a tag
        scopes = [0]
        pieces: list[str] = []
        link, size, punct = False, 0, 0

        def flush() -> None:
            nonlocal size, punct
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.nodes.append((stack[-1], text, size, punct))
                pieces.clear()
                size = punct = 0

        def cut(depth: int) -> None:
            while len(stack) > depth:
                tag = self.tags[stack.pop()]
                places[tag].pop()
                if tag in _SCOPES:
                    scopes.pop()

        for kind, name, text in tokens(page):
            if kind == "text":
                words = html.unescape(text)
                if self.tags[stack[-1]] == "head" and words.strip():
                    cut(len(stack) - 1)
                pieces.append(words)
                if not link:
                    size += len(words.strip())
                    punct += len(_PUNCT.findall(words))
                continue
            if name == "a":
                link = kind == "open"
            if name in INLINE:
                continue
            flush()
            if name in VOID:
                continue
            if kind == "close":
                if places.get(name):
                    cut(places[name][-1])
                continue
            if self.tags[stack[-1]] == "head" and name not in HEAD_TAGS:
                cut(len(stack) - 1)
            closes = ("p",) if name in _CLOSES_P else _SIBLINGS.get(name, ())
            depth = min((d[-1] for t in closes if (d := places.get(t)) and d[-1] > scopes[-1]), default=0)
            if depth:
                cut(depth)
            here = stack[-1]
            names = [(k.lower(), v.strip("\"'")) for k, v in _NAMED.findall(text) if k.lower() in ("class", "id", "role")] if "=" in text else []
            mark = 3 if name in HARD else 0
            if not mark and name not in ("body", "html", "main"):
                found = _class_mark(name, names)
                mark = found if name != "article" or found == 2 else 0
                if not mark and name in SOFT and not (name == "header" and (places.get("article") or places.get("main"))):
                    mark = 1
            label = ".".join([name, *[w for k, v in names if k == "class" for w in _DIGITS.sub("", v.lower()).split()[:2]]])
            path = ids.setdefault((self.paths[here], label), len(ids) + 1)
            places.setdefault(name, []).append(len(stack))
            if name in _SCOPES:
                scopes.append(len(stack))
            stack.append(len(self.tags))
            self.tags.append(name)
            self.parents.append(here)
            self.paths.append(path)
            self.marks.append(mark)
        flush()

    def summed(self, values: dict[int, int]) -> list[int]:
        """Per element the sum of ``values`` in it and below it."""
        out = [values.get(k, 0) for k in range(len(self.tags))]
        for k in range(len(out) - 1, 0, -1):
            out[self.parents[k]] += out[k]
        return out

    def inherited(self, flags: list[bool]) -> list[bool]:
        """Per element whether it or one above it is flagged."""
        out = list(flags)
        for k in range(1, len(out)):
            out[k] = out[k] or out[self.parents[k]]
        return out

    def furniture(self) -> list[bool]:
        """Per element whether it is page furniture. What by class (or as a form or header) would be, is not if it wraps every article of the
        page or, on a page without any, other blocks with most of its text; readers' comments only in the first case."""
        hard = self.inherited([m == 3 for m in self.marks])
        held: dict[int, int] = {}
        for tag in ("article", "main"):
            held = held or {k: 1 for k, t in enumerate(self.tags) if t == tag and self.marks[k] == 0 and not hard[k]}
        holders = self.summed(held)
        own: dict[int, int] = {}
        for e, _, size, _ in self.nodes:
            if not hard[e]:
                own[e] = own.get(e, 0) + size
        texts = self.summed(own)

        def wraps(k: int) -> bool:
            if held:
                return holders[k] == holders[0]
            return self.marks[k] == 1 and 2 * texts[k] >= texts[0] and not own.get(k) and texts[k] > 0

        return self.inherited([m == 3 or (m > 0 and not wraps(k)) for k, m in enumerate(self.marks)])


def path_scores(found: list[tuple[int, str, int, int]], paths: list[int], boosted: list[bool]) -> dict[int, float]:
    """Path -> score: text and punctuation per node, smoothed along the page, fused; more within an article."""
    sums: dict[int, list[int]] = {}
    for e, _, size, punct in found:
        s = sums.setdefault(paths[e], [0, 0, 0])
        s[0] += 1
        s[1] += size
        s[2] += punct
    ratios = [(sums[paths[e]][1] / sums[paths[e]][0], sums[paths[e]][2] / sums[paths[e]][0]) for e, *_ in found]
    last = len(ratios) - 1
    score: dict[int, float] = {}
    for k, (e, *_) in enumerate(found):
        size, marks = (0.25 * ratios[max(0, k - 1)][c] + 0.5 * ratios[k][c] + 0.25 * ratios[min(last, k + 1)][c] for c in (0, 1))
        value = size * (1 + marks) * (PRIOR if boosted[e] else 1.0) * (ratios[k][0] > 0)
        score[paths[e]] = max(score.get(paths[e], 0.0), value)
    return score


def main_text(page: str | None) -> str:
    """The main text of a page; empty if it has none."""
    tree = Page(page or "")
    furniture = tree.furniture()
    found = [n for n in tree.nodes if not furniture[n[0]]]
    if not found:
        return ""
    named = tree.inherited([t in ("article", "main") for t in tree.tags])
    score = path_scores(found, tree.paths, named)
    total = sum(n[2] for n in found)
    mean = sum(n[2] * score[tree.paths[n[0]]] for n in found) / total if total else 0.0
    content = [k for k, n in enumerate(found) if score[tree.paths[n[0]]] >= SHARE * mean]
    # the deepest element that holds all content nodes: the elements that do are each other's parents, so the last of them
    counts: dict[int, int] = {}
    for k in content:
        counts[found[k][0]] = counts.get(found[k][0], 0) + 1
    held = tree.summed(counts)
    holder = max(k for k, n in enumerate(held) if n == len(content))
    if tree.tags[holder] in ("p", "li", "blockquote", "pre", "td", "dd", *HEADINGS):  # a block of text and not a part of the page
        holder = tree.parents[holder]
    chain = [holder]
    while chain[-1] > 0:
        chain.append(tree.parents[chain[-1]])
    holder = next((k for k in chain if tree.tags[k] in ("article", "main")), holder)
    inside = tree.inherited([k == holder for k in range(len(tree.tags))])
    shown = [k for k, n in enumerate(found) if inside[n[0]]]
    first, end = shown[0], shown[-1]
    if tree.tags[holder] in PAGE:
        first, end = content[0], content[-1]
    if not named[holder]:
        first = _heading(tree, found, first, end, set(chain))
    return " ".join(n[1] for n in found[first : end + 1])


def _heading(tree: Page, found: list[tuple[int, str, int, int]], first: int, end: int, chain: set[int]) -> int:
    """Where the text begins: at the last top heading before it, if it has none itself and the heading's parent (or that one's, below the page) holds it."""
    if any(tree.tags[n[0]] == "h1" for n in found[first : end + 1]):
        return first
    for k in range(first - 1, -1, -1):
        if tree.tags[found[k][0]] == "h1":
            above = tree.parents[found[k][0]]
            outer = tree.parents[above]
            return k if above in chain or (outer in chain and tree.tags[outer] not in PAGE) else first
    return first


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, first, held, out = batch.column("html"), 0, 0, []
        for k in range(batch.num_rows):
            page = pages[k].as_py() or ""
            held += len(page)
            out.append(main_text(page))
            if held >= CHUNK or k == batch.num_rows - 1:
                part = batch.slice(first, len(out))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )
                first, held, out = k + 1, 0, []


def report(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    A null or empty page, and one without text outside its furniture, has an empty text. A page without tags is all content. Paths
    that tie at the limit are content. Null ids and addresses stay null, repeated rows give equal rows, an empty table gives
    none. Other columns are ignored. A very long page takes memory in proportion to its length; no part of it is left unread.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
