"""Main text of HTML pages by tree scoring.

A page becomes a flat list of elements in page order with their parents, and a list of text pieces. A paragraph earns points for
length and commas, less its share of link text; it passes them to its ancestors, full to the parent and less further up. The container
with most points, again less its share of links, is the article (or the ``article`` or ``main`` element around it), together with siblings that
score alike and, where no ``article`` bounds it, with its title: what stands between a heading before it and its last block, sentences beside it, sections
with a heading after it, and the page's only ``h1`` further up. Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and
styles are left out by element, role or class. A class word that also has other meanings (``share-price``) is only a penalty: half the points, out where
a third is links. Lists and boxes that consist of links are out, but for lists of sources: under a heading that says so, or inside an ``article`` after its
first paragraph, unless their heading offers more to read.

Nothing is recursive, so depth does not matter, and each step is linear in the page.

Defined results: NULL, empty and textless pages give an empty text. Repeated rows and equal ids are extracted alike. Broken markup is read as far
as it goes: unclosed elements end with their parents, stray end tags are ignored, ``<`` without a name is text. An empty table gives an empty result.
Further columns, whatever their names, are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split()
)
NEVER = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map form button select textarea input nav footer aside menu dialog title noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt".split()
)
SELF_CLOSING = {
    "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table tr body html article section div td th blockquote".split())
# Words in class names and ids that mark what is not the article.
UNWANTED = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored sponsors promo promos promotion promoted
    comment comments commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice notices notification notifications alert alerts
    disclaimer popup modal overlay newsletter subscribe subscription signup sidebar sidebars aside rail widget widgets footer foot footnav header masthead topbar nav navbar
    navigation menu menus submenu breadcrumb breadcrumbs pagination pager paging share sharing sharebar social related recommended recommendations
    toc login signin search toolbar skip hidden paywall tags taglist""".split()
)
NEGATIONS = frozenset("no has with without hide not is".split())
# Those of them that also name other things, and words beside them that change nothing.
AMBIGUOUS = frozenset(
    """alert alerts share notice notices social related search skip rail tags hidden menu menus header footer discussion reply replies respond
    overlay disclaimer recommended recommendations promotion login signup subscription""".split()
)
LAYOUT = frozenset(
    """area articles bar block body bottom box btn button buttons card center class col column container content count counts css data div global group
    header icon icons id info inner item items js label left line link links list main message more news options outer page panel post posts primary
    reading right row secondary section site stories text this title tools top topics unit via wrap wrapper""".split()
)
# Headings over lists of links, and the start of a line of rights.
SOURCES = re.compile(r"(?i)\b(?:sources?|references|bibliography|citations|literature|footnotes|quellen|literatur|références|bibliographie|fuentes|referencias|bibliografía)\b")
MORE = re.compile(r"(?i)\b(?:related|more|also|read|popular|latest|trending|share|follow|contents|mehr|auch|lesen|aussi|plus|también|más)\b")
RIGHTS = re.compile(r"(?i)\s*(?:©|\(c\)|copyright|all rights reserved)")

_ATTRIBUTES = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_SHORT = 25  # a shorter paragraph earns nothing
_LABEL = 200  # headings over lists and lines of rights are no longer
_LINKS = 1 / 3  # text with a larger share of links is no prose
_KEPT, _PENALTY, _OUT = 0, 1, 2
_SHARES = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``(text, '', text)``, ``(open, name, attributes)`` and ``(close, name, '')`` in order; raw elements come without content."""
    at, n = 0, len(html)
    last = html.rfind(">")
    text_from = 0
    while True:
        lt = html.find("<", at)
        if lt < 0 or lt > last:
            break
        sign = html[lt + 1 : lt + 2]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            stop = n if end < 0 else end + 3
            found = None
        elif sign and sign in "!?":
            stop, found = html.find(">", lt) + 1, None
        elif sign.isascii() and (sign.isalpha() or sign == "/"):
            found = _TAG.match(html, lt) or _LOOSE.match(html, lt)
            if not found:
                at = lt + 1
                continue
            stop = found.end()
        else:
            at = lt + 1
            continue
        if lt > text_from:
            yield "text", "", html[text_from:lt]
        at = text_from = stop
        if found is None:
            continue
        name = found[2].lower()
        if found[1]:
            yield "close", name, ""
            continue
        yield "open", name, found[3]
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = text_from = n if end is None else end.start()
            if end is None:
                return
    if text_from < n:
        yield "text", "", html[text_from:]


def _class_verdict(words: list[str]) -> int:
    """Verdict on one class or id from its words."""
    if not words or words[0] in NEGATIONS or not (words[0] in UNWANTED or words[-1] in UNWANTED):
        return _KEPT
    named = [w for w in words if w in UNWANTED]
    doubtful = all(w in AMBIGUOUS for w in named) and any(w not in UNWANTED and w not in LAYOUT for w in words)
    return _PENALTY if doubtful else _OUT


def _unwanted(name: str, attributes: str) -> int:
    """Whether the element by itself is no part of an article."""
    if name in NEVER:
        return _OUT
    if not attributes or not attributes.strip(" /"):
        return _KEPT
    verdict = _KEPT
    for found in _ATTRIBUTES.finditer(attributes):
        key, value = found[1].lower(), unescape(found[2] or found[3] or found[4] or "").lower()
        if key == "role" and value.strip() in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return _OUT
        if key == "style" and _HIDDEN.search(value):
            return _OUT
        if key in ("class", "id") and name not in ("html", "body", "main", "article"):
            for one in value.split():
                verdict = max(verdict, _class_verdict([w for w in re.split(r"[^a-z]+", one) if w]))
                if verdict == _OUT:
                    return _OUT
    return verdict


class _Page:
    """Elements in page order (0 is the page), their parents, and text pieces with block bounds between them."""

    def __init__(self, html: str):
        self.tag, self.parent, self.bad = ["html"], [0], [_KEPT]
        self.pieces: list[tuple[int, str | None]] = []
        self.open: Counter[str] = Counter()  # open elements by name, so that nothing is looked for in vain
        stack = [0]
        for kind, name, data in _tokens(html):
            if kind == "text":
                if data.strip():
                    self.pieces.append((stack[-1], unescape(data)))
                else:
                    self.pieces.append((stack[-1], " "))
            elif kind == "open":
                self._open(stack, name, data)
            else:
                self._close(stack, name)

    def _end(self, stack: list[int], depth: int) -> None:
        if any(self.tag[i] not in INLINE for i in stack[depth:]):
            self.pieces.append((stack[depth - 1], None))
        self.open.subtract(self.tag[i] for i in stack[depth:])
        del stack[depth:]

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name == "br":
            self.pieces.append((stack[-1], " "))
            return
        ended = ("p",) if name in CLOSES_P else ()
        for names, scopes in ((ended, SCOPES), (SELF_CLOSING.get(name, ()), frozenset(("ul", "ol", "dl", "table")))):
            for depth in range(len(stack) - 1, 0, -1) if any(self.open[x] > 0 for x in names) else ():
                tag = self.tag[stack[depth]]
                if tag in names:
                    self._end(stack, depth)
                    break
                if tag in scopes:
                    break
        if name not in INLINE:
            self.pieces.append((stack[-1], None))
        if name in VOID:
            return
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.bad.append(_unwanted(name, attributes))
        self.open[name] += 1
        stack.append(len(self.tag) - 1)

    def _close(self, stack: list[int], name: str) -> None:
        if self.open[name] <= 0:
            return
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] == name:
                self._end(stack, depth)
                return
            if name in INLINE and self.tag[stack[depth]] not in INLINE:
                return

    def dropped(self) -> list[bool]:
        """Elements that are out, with what they contain. A box around an article is not out by its class; a header inside one stays."""
        n = len(self.tag)
        around, inside = [False] * n, [False] * n
        for i in range(n - 1, 0, -1):
            around[self.parent[i]] |= around[i] or self.tag[i] in ("article", "main")
        out = [False] * n
        for i in range(1, n):
            p = self.parent[i]
            inside[i] = inside[p] or self.tag[p] in ("article", "main")
            own = self.bad[i] == _OUT and not (around[i] and self.tag[i] not in NEVER) or self.tag[i] == "header" and not inside[i] and not around[i]
            out[i] = out[p] or own
        return out

    def main_text(self) -> str:
        n, out = len(self.tag), self.dropped()
        # The block each element belongs to, whether it lies in a link, and whether a doubtful class is on it or around it.
        block, linked, doubtful = list(range(n)), [False] * n, [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.tag[i] == "a"
            doubtful[i] = doubtful[self.parent[i]] or self.bad[i] == _PENALTY
            if self.tag[i] in INLINE:
                block[i] = block[self.parent[i]]
        length, commas, links, anchors, label = [0] * n, [0] * n, [0] * n, [0] * n, [""] * n
        for i, text in self.pieces:
            if text and not out[i] and text != " ":
                plain = " ".join(text.split())
                b = block[i]
                length[b] += len(plain)
                commas[b] += text.count(",") + text.count("、") + text.count("，")
                links[b] += len(plain) if linked[i] else 0
                label[b] = label[b] + " " + plain if length[b] <= _LABEL else plain[-1:]
        for i in range(1, n):
            anchors[block[i]] += self.tag[i] == "a" and not out[i]
        all_length, all_links, all_anchors = length[:], links[:], anchors[:]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            all_length[p] += all_length[i]
            all_links[p] += all_links[i]
            all_anchors[p] += all_anchors[i]

        sources = self._sources(all_length, all_anchors, all_links, label)
        for i in range(1, n):
            menu = self.tag[i] in ("ul", "ol", "div", "section", "table", "dl") and all_anchors[i] >= 3 and all_links[i] > 0.8 * all_length[i] and i not in sources
            cut = self.bad[i] == _PENALTY and all_links[i] > _LINKS * all_length[i]
            out[i] = out[i] or out[self.parent[i]] or menu or cut

        score = [0.0] * n
        for i in range(1, n):
            if out[i] or length[i] < _SHORT or self.tag[i] in HEADINGS or block[i] != i:
                continue
            points = (1 + commas[i] + min(length[i] / 100, 3)) * (1 - links[i] / length[i]) * (0.5 if doubtful[i] else 1)
            at = i if self.tag[i] in ("div", "section", "article", "main", "body") else self.parent[i]
            for share in _SHARES:
                score[at] += points * share
                if at == 0:
                    break
                at = self.parent[at]
        final = [s * (1 - all_links[i] / all_length[i]) if s else 0.0 for i, s in enumerate(score)]
        best = max(range(n), key=lambda i: (final[i], -i))
        if final[best] <= 0:
            return self._joined(self._fallback(out), out)
        prose = [0 < all_length[i] and all_links[i] <= _LINKS * all_length[i] and not out[i] and self.bad[i] == _KEPT for i in range(n)]
        return self._joined(self._article(best, final, out, prose, label), out)

    def _sources(self, all_length: list[int], all_anchors: list[int], all_links: list[int], label: list[str]) -> set[int]:
        """Lists that consist of links but belong to the text: sources, by the block before them or their place in an article."""
        found, last, begun, begins = set(), {}, [False] * len(self.tag), {}
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            begun[i] = begun[p] or self.tag[i] == "article"
            if begun[i] and self.tag[i] == "p" and all_length[i] >= _SHORT:
                begins.setdefault(p, i)
            if self.tag[i] in ("ul", "ol") and all_anchors[i] >= 3 and all_links[i] > 0.8 * all_length[i]:
                before = label[last[p]] if p in last else ""
                if SOURCES.search(before) or p in begins and not MORE.search(before if p in last and self.tag[last[p]] in HEADINGS or before.endswith(":") else ""):
                    found.add(i)
            if self.tag[i] not in INLINE and all_length[i]:
                last[p] = i
        return found

    def _article(self, best: int, final: list[float], out: list[bool], prose: list[bool], label: list[str]) -> set[int]:
        top = at = best
        while at:
            if self.tag[at] in ("article", "main"):
                top = at
                if self.tag[at] == "article":
                    break
            at = self.parent[at]
        if self.tag[top] in ("html", "body"):
            return {top}
        beside = [i for i in range(1, len(self.tag)) if self.parent[i] == self.parent[top] and i != top and not out[i]]
        least = max(10.0, 0.2 * final[best])
        chosen = {top} | {i for i in beside if final[i] >= least or self.tag[i] == "article" and final[i] > 0}
        if self.tag[top] in ("article", "main"):
            return chosen
        return chosen | self._title(top, max(chosen), [i for i in beside if prose[i]], prose, label)

    def _title(self, top: int, last: int, beside: list[int], prose: list[bool], label: list[str]) -> set[int]:
        """Title, lead and short parts of the article in ``top``, from the prose ``beside`` it and the page's only ``h1``."""
        n = len(self.tag)
        headed = [tag in HEADINGS for tag in self.tag]
        titled = [tag == "h1" for tag in self.tag]
        for i in range(n - 1, 0, -1):
            headed[self.parent[i]] |= headed[i] and prose[i]
            titled[self.parent[i]] |= titled[i] and prose[i]

        def sentence(i: int) -> bool:
            return self.tag[i] == "p" and label[i].endswith((".", "!", "?", "…", "。", ":", '"', "”")) and not RIGHTS.match(label[i])

        heads = [i for i in beside if i < top and (titled[i] or self.tag[i] in HEADINGS)]
        first = min([i for i in heads if titled[i]] or heads or [top])
        chosen = {i for i in beside if first <= i <= last or sentence(i) or i > last and self.tag[i] == self.tag[top] == "section" and headed[i]}
        only = [i for i in range(1, n) if self.tag[i] == "h1" and prose[i]]
        if len(only) == 1 and only[0] < first and not titled[top]:
            chosen |= {i for i in range(only[0], top) if prose[i] and (i == only[0] or self.parent[i] == self.parent[only[0]] and sentence(i))}
        return chosen

    def _fallback(self, out: list[bool]) -> set[int]:
        """Without any paragraph that earns points: the articles, or the main element, or the body."""
        for name in ("article", "main", "body"):
            found = {i for i, tag in enumerate(self.tag) if tag == name and not out[i]}
            if found:
                return found
        return {0}

    def _joined(self, chosen: set[int], out: list[bool]) -> str:
        inside = [i in chosen for i in range(len(self.tag))]
        for i in range(1, len(self.tag)):
            inside[i] = (inside[i] or inside[self.parent[i]]) and not out[i]
        blocks, current = [], []
        for i, text in self.pieces:
            if text is None:
                if current:
                    blocks.append(" ".join("".join(current).split()))
                    current = []
            elif inside[i]:
                current.append(text)
        blocks.append(" ".join("".join(current).split()))
        return "\n\n".join(b for b in blocks if b)


def main_text(html: str | None) -> str:
    """Blocks of the article in page order, joined by an empty line."""
    return _Page(html).main_text() if html else ""


_BATCH_CHARS = 4 << 20


def _extracted(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Adds ``text`` and ``n_chars`` to rows whose last column is the page."""
    for batch in batches:
        texts, held, first = [], 0, 0
        for i, html in enumerate(batch.column(batch.num_columns - 1)):
            texts.append(main_text(html.as_py()))
            held += len(texts[-1])
            if held > _BATCH_CHARS or i == batch.num_rows - 1:
                part = batch.slice(first, i + 1 - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())], schema=kind)
                texts, held, first = [], 0, i + 1


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page`` (struct of the columns of ``pages`` without ``html``), ``text``, ``n_chars``."""
    others = [c for c in pages.columns if c != html]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("page") if others else F.struct(F.lit(0).alias("none")).alias("page"), F.col(html).alias("html"))
    ddl = f"page {rows.schema['page'].dataType.simpleString()}, text string, n_chars bigint"

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        kind = pa.schema([first.schema.field(0), ("text", pa.string()), ("n_chars", pa.int64())])
        yield from _extracted((b for many in ((first,), batches) for b in many), kind)

    return rows.mapInArrow(run, ddl)
