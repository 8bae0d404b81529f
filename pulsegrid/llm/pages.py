"""HTML extraction by template deduction: tokens of one occurrence vector across a host's pages form classes."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written
from pulsegrid.llm.urls import url_host

GROUP = 48  # pages of a host that a template is deduced from together, about
LEAST_PAGES = 3  # fewer pages give no occurrence vectors worth trusting

# An attribute's value may be quoted, or hold quotes anywhere but at its start; loops give nothing back, so no page is slow.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|title|textarea|select|svg|iframe|object|annotation)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)|[^>])*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mspace semantics".split())
# Elements, and words of class, id and role, that mark what is not the article.
_OTHER_ELEMENTS = set("nav header footer aside form button menu dialog fieldset template".split())
_OTHER_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies copyright"
    " disqus footer header login menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply"
    " respond share sharing sidebar signup skip social sponsor sponsored subscribe tags toc toolbar topbar widget consent gdpr search".split()
)
_MAIN_WORDS = set("article main content post entry story body text".split())
# Words that say nothing of their own beside these: a "share-buttons" is other, "related-work" or "search-results" are not.
_CARRIERS = set(
    "area bar block bottom box btn button buttons col column container content footer form global holder icons inner item items left link links list"
    " outer page panel primary right row secondary section site slot strip text top unit wrap wrapper".split()
)
_SPACE = re.compile(r"\s+")
# Elements that end an open one of their kind without its closing tag, and what that search stops at.
_SIBLINGS = {n: set(names.split()) for names in ("li", "dt dd", "tr", "td th", "option") for n in names.split()}
_CONTAINERS = set("ul ol dl table tbody thead tfoot tr select div section article main body".split())


@dataclass(slots=True)
class Token:
    """A run of text, or a tag: name empty for text, else the tag with its naming words."""

    kind: str  # "text", "open", "close"
    name: str
    label: str  # the tag with its class, id and role
    role: int = 0  # what occurrence vectors count: the label under the labels it is nested in
    text: str = ""
    other: bool = False  # opens something that is not the article
    main: bool = False


def tokens_of(page: str) -> list[Token]:
    """Tags and the text between them; comments, scripts, styles and the like are no tokens."""
    out, at = [], 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            out.append(Token("text", "", "", 0, page[at : m.start()]))
        at = m.end()
        name = (m[3] or "").lower()
        if m[0].startswith("<![CDATA["):
            out.append(Token("text", "", "", 0, html.escape(m[0][9:].removesuffix("]]>"))))
        if not name:
            continue
        if m[2]:
            out.append(Token("close", name, f"/{name}"))
            continue
        marks = " ".join(f"{k.lower()}={v.strip(chr(34) + chr(39))}" for k, v in _NAMED.findall(m[4]))
        names = [set(re.findall(r"[a-z]+", w)) for w in re.sub(r"\b(class|id|role)=", " ", marks).lower().split()]
        words = set().union(*names)
        # a page's outer elements may carry such words (class="has-sidebar") without being one
        other = name in _OTHER_ELEMENTS or (name not in ("html", "body", "main", "article") and any(n & _OTHER_WORDS and n <= _OTHER_WORDS | _CARRIERS for n in names)) or bool(m[4] and _HIDDEN.search(m[4]))
        main = name in ("article", "main") or (name in ("div", "section", "td") and bool(words & _MAIN_WORDS) and not other)
        out.append(Token("open", name, f"{name} {re.sub(r'[0-9]+', '0', marks)}", 0, "", other, main))
        if m[4].rstrip().endswith("/") and name not in _VOID and name not in _INLINE and name != "p":
            out.append(Token("close", name, f"/{name}"))
    if at < len(page):
        out.append(Token("text", "", "", 0, page[at:]))
    _nest(out)
    return out


def _nest(page: list[Token]) -> None:
    """Sets the roles of tags: one label in two places of a page (a paragraph of the article, of the footer) is two roles."""
    stack: list[tuple[str, int]] = []  # open elements, name and role
    for t in page:
        if t.kind == "open":
            if t.name not in _INLINE and t.name not in _VOID:
                while stack and (stack[-1][0] in _INLINE or stack[-1][0] == "p"):
                    stack.pop()  # no block lies in a paragraph or in text
                siblings = _SIBLINGS.get(t.name, ())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in siblings:
                        del stack[k:]
                        break
                    if stack[k][0] in _CONTAINERS:
                        break
            t.role = hash((stack[-1][1] if stack else 0, t.label))
            if t.name not in _VOID:
                stack.append((t.name, t.role))
        elif t.kind == "close":
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == t.name), None)
            if k is None:
                t.role = hash((stack[-1][1] if stack else 0, t.label))
            else:
                t.role = hash((stack[k][1], "/"))
                del stack[k:]


def equivalence_classes(pages: list[list[Token]]) -> dict[int, tuple[int, ...]]:
    """Roles of tags -> their occurrence vector (how often in each page), for tags that most pages have."""
    vectors: dict[int, list[int]] = defaultdict(lambda: [0] * len(pages))
    for i, page in enumerate(pages):
        for role, n in Counter(t.role for t in page if t.kind != "text").items():
            vectors[role][i] = n
    return {role: tuple(v) for role, v in vectors.items() if sum(map(bool, v)) >= max(2, 0.9 * len(pages))}


def template_of(pages: list[list[Token]]) -> set[int]:
    """Roles of the template's tags: the root's, which come once per page, and those of the classes nested in its slots.

    A class of the root is valid if its tags keep one order in all pages, also against the classes chosen before;
    those that do not are left out, smallest first. A class of repeated tags (rows of a list, paragraphs) is valid if
    every page repeats its tags in one order. One that does not is cut into single tags: roles carry the
    elements around a tag, so each of them still lies within one slot of what it is nested in.
    """
    classes = defaultdict(list)
    for role, vector in equivalence_classes(pages).items():
        classes[vector].append(role)
    once = {v: c for v, c in classes.items() if set(v) <= {0, 1}}
    places = [{t.role: k for k, t in enumerate(page) if t.kind != "text"} for page in pages]
    chosen: list[int] = []
    for _, roles in sorted(once.items(), key=lambda c: (-sum(c[0]), -len(c[1]))):
        wanted = [*chosen, *roles]
        rank = {role: sum(p.get(role, 0) / max(1, len(q)) for p, q in zip(places, pages, strict=True)) for role in wanted}
        order = sorted(wanted, key=rank.get)
        if all(_increasing([p[x] for x in order if x in p]) for p in places):
            chosen = order
    return set(chosen).union(*(c for v, c in classes.items() if v not in once))


def _increasing(values: list[int]) -> bool:
    return all(a < b for a, b in zip(values, values[1:], strict=False))


def slots_of(page: list[Token], template: set[int]) -> list[tuple[int, list[Token]]]:
    """(role of the template's tag before, tokens) for each slot between the template's tags that this page has."""
    out, role, current = [], 0, []
    for t in page:
        if t.kind != "text" and t.role in template:
            out.append((role, current))
            role, current = t.role, []
        current.append(t)
    out.append((role, current))
    return out


def _text(part: list[Token]) -> str:
    return _SPACE.sub(" ", "".join(t.text for t in part)).strip()


def _by_role(slots: list[tuple[int, list[Token]]]) -> dict[int, list[str]]:
    texts = defaultdict(list)
    for role, part in slots:
        texts[role].append(_text(part))
    return texts


@dataclass(slots=True)
class Constant:
    """What slots hold in nearly all pages: the one text of each occurrence, and all texts of a page in order."""

    each: dict[int, str]
    pages: dict[int, list[str]]

    def fixed(self, slots: list[tuple[int, list[Token]]]) -> set[int]:
        """Places of the slots of a page whose text is the template's."""
        texts = _by_role(slots)
        whole = {role for role, own in texts.items() if any(own) and own == self.pages.get(role)}
        return {i for i, (role, part) in enumerate(slots) if role in whole or (role in self.each and _text(part) == self.each[role])}


def constant_slots(pages: list[list[Token]], template: set[int]) -> Constant:
    """Texts that slots hold in nearly all pages though the pages differ: part of the template.

    A slot of a repeated tag is constant by occurrence (the same words after every row) or by page (the same list
    in every page). A page with another text in such a slot has content there.
    """
    constant = Constant({}, {})
    whole = Counter(tuple(t.text for t in page) for page in pages)
    if max(whole.values(), default=0) > len(pages) / 2:  # copies of one page show nothing
        return constant
    by_page, by_row, having = defaultdict(Counter), defaultdict(Counter), Counter()
    for page in pages:
        for role, texts in _by_role(slots_of(page, template)).items():
            by_page[role][tuple(texts)] += 1
            by_row[role].update(texts)
            having[role] += any(texts)
    least = max(LEAST_PAGES, 0.9 * len(pages))
    for role, seen in by_page.items():
        texts, n = seen.most_common(1)[0]
        if any(texts) and n >= least:
            constant.pages[role] = list(texts)
        text, n = by_row[role].most_common(1)[0]
        if text and having[role] >= least and n >= 0.9 * by_row[role].total():
            constant.each[role] = text
    return constant


def extract(page: list[Token], template: set[int], constant: Constant) -> str:
    """Text of the slots that are left when the template and what is not the article are taken away.

    Where a page marks an article, only slots inside it count, and the template decides among these as it does
    elsewhere. A mark by a class word only counts if most of the text lies in it. Only if it would take more than half of the marked text are pages near copies of each other, and the mark wins.
    """
    slots = slots_of(page, template)
    marked = "article" if any(t.main and t.name == "article" for t in page) else "main" if any(t.main for t in page) else ""
    fixed = constant.fixed(slots)
    if marked == "main" and not any(t.name == "main" for t in page) and 2 * len(_extract(slots, marked, fixed)) < len(_extract(slots, "", fixed)):
        marked = ""
    text = _extract(slots, marked, fixed)
    if marked and fixed and 2 * len(text) < len(whole := _extract(slots, marked, set())):
        return whole
    return text


def _extract(slots: list[tuple[int, list[Token]]], marked: str, fixed: set[int]) -> str:
    blocks, words = [], []
    skip: list[str] = []  # open elements that are not the article, and what is open inside them
    inside: list[str] = []

    def close_block() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(words))).strip()
        if text:
            blocks.append(text)
        words.clear()

    for i, (_, part) in enumerate(slots):
        for t in part:
            if t.kind == "text":
                if not skip and i not in fixed and (inside or not marked):
                    words.append(t.text)
                continue
            if t.name not in _INLINE:
                close_block()
            elif t.name == "br":
                words.append(" ")
            if t.name in _VOID:
                continue
            if t.kind == "open":
                if skip:
                    if t.name == skip[0]:
                        skip.append(t.name)
                elif t.other:
                    skip.append(t.name)
                elif inside:
                    if t.name == inside[0]:
                        inside.append(t.name)
                elif t.main and (t.name == "article" or marked == "main"):
                    inside.append(t.name)
            elif skip:
                if t.name == skip[0]:
                    skip.pop()
                elif t.name in ("body", "html") or (inside and t.name == inside[0] and t.name != skip[0] and t.name in ("article", "main")):
                    skip.clear()  # an element that was never closed ends with what it lies in
                    inside.pop() if inside and t.name == inside[0] else None
            elif inside and t.name == inside[0]:
                inside.pop()
    close_block()
    return "\n\n".join(blocks)


def extract_group(pages: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    parsed = [tokens_of(p) for p in pages]
    template = template_of(parsed) if len(parsed) >= LEAST_PAGES else set()
    constant = constant_slots(parsed, template) if template else Constant({}, {})
    return [extract(p, template, constant) for p in parsed]


def extract_pages(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """`key`, url, text, n_chars for every row of `pages`: the main text of the whole page.

    Pages are grouped by host, a host with many pages into parts of about 48, so that no task needs a whole
    host; each part deduces its own template. The number of
    parts comes from counts per host, joined by measured size. Pages without host form parts as well. Null
    pages have an empty text, and so do pages with nothing left; blocks are joined by two line feeds.
    """
    large = pages.select(url_host(F.col(url)).alias("__host")).groupBy("__host").agg(F.ceil(F.count("*") / GROUP).alias("__parts")).where("__parts > 1")
    rows = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"), F.coalesce(F.col(page), F.lit("")).alias("__html"), url_host(F.col(url)).alias("__host"))
    part = F.coalesce(F.pmod(F.xxhash64("__key", "__url"), "__parts"), F.lit(0).cast("long"))
    # a group has one key of its own: were it keyed by host and part, Spark could deal it by host alone
    rows = rows.join(written(large, "hosts"), "__host", "left").select("__key", "__url", "__html", F.concat_ws("/", "__host", part).alias("__group"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        texts = extract_group(frame["__html"].tolist())
        return pd.DataFrame({key: frame["__key"], "url": frame["__url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema[key].dataType.simpleString()
    return rows.groupBy("__group").applyInPandas(run, f"`{key}` {kind}, url string, text string, n_chars long")
