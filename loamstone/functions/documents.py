"""Functions over whole documents that need a parser: HTML, JSON inside text, and calls to outside models."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SKIPPED = {"script", "style", "noscript", "template", "svg", "head"}
_BLOCKS = {
    "p", "div", "br", "li", "ul", "ol", "table", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header", "footer", "main", "nav",
    "aside", "blockquote", "pre", "figure", "figcaption", "dl", "dt", "dd", "hr", "form",
}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.depth += 1
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.depth = max(0, self.depth - 1)
        elif tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def text_of_html(html: str | None) -> str | None:
    """The visible text: one line per block, without scripts, styles and blank lines."""
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    lines = (" ".join(x.split()) for x in "".join(parser.parts).split("\n"))
    return "\n".join(x for x in lines if x)


def html_text(html: Column) -> Column:
    """text_of_html over a column, in Arrow batches."""

    @F.pandas_udf("string")
    def convert(values: pd.Series) -> pd.Series:
        return values.map(text_of_html, na_action="ignore")

    return convert(html)


_VOID = {"meta", "link", "br", "hr", "img", "input", "source", "wbr", "area", "base", "col", "embed", "track"}
_SELECTOR = re.compile(r"^(?P<tag>[a-z0-9]*)(?:#(?P<id>[^.\[@]+))?(?:\.(?P<cls>[^\[@]+))?(?:\[(?P<attr>[^=\]]+)(?:=(?P<value>[^\]]*))?\])?(?:@(?P<take>.+))?$")


class _Select(HTMLParser):
    """Texts (or attributes) of the elements that match each of a list of selectors, in document order."""

    def __init__(self, selectors: list[str]):
        super().__init__(convert_charrefs=True)
        self.rules = [_SELECTOR.match(s).groupdict() for s in selectors]
        self.found: list[list[str]] = [[] for _ in selectors]
        self.open: list[tuple[str, list[tuple[int, _Text]]]] = []
        self.active: list[_Text] = []

    def _hits(self, tag: str, attrs: dict) -> Iterator[int]:
        for i, r in enumerate(self.rules):
            if r["tag"] and r["tag"] != tag or r["id"] and attrs.get("id") != r["id"] or r["cls"] and r["cls"] not in (attrs.get("class") or "").split():
                continue
            if r["attr"] and (r["attr"] not in attrs or r["value"] is not None and attrs[r["attr"]] != r["value"]):
                continue
            yield i

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        begun = []
        for i in self._hits(tag, attrs):
            take = self.rules[i]["take"]
            if take:
                self.found[i].append((attrs.get(take) or "").strip())
            elif tag not in _VOID:
                begun.append((i, _Text()))
        for text in self.active:
            text.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.append((tag, begun))
            self.active += [t for _, t in begun]

    def handle_endtag(self, tag):
        for text in self.active:
            text.handle_endtag(tag)
        if tag not in [t for t, _ in self.open]:
            return
        while self.open:
            name, begun = self.open.pop()
            self._end(begun)
            if name == tag:
                break

    def _end(self, begun):
        for i, text in begun:
            self.active.remove(text)
            self.found[i].append(_lines("".join(text.parts)))

    def handle_data(self, data):
        for text in self.active:
            text.handle_data(data)

    def close(self):
        super().close()
        while self.open:
            self._end(self.open.pop()[1])


def _lines(text: str) -> str:
    return "\n".join(x for x in (" ".join(y.split()) for y in text.split("\n")) if x)


def selected_text(html: str | None, selectors: list[str], least: int = 1, whole: bool = False) -> str | None:
    """The text of the first selector in the list that gives at least `least` characters; else the text of the whole page if
    `whole`, or null. A selector is `tag#id.class[attribute=value]`, each part optional, with `@attribute` at its end for an
    attribute in place of the text. Of several elements the first that is long enough counts."""
    if html is None:
        return None
    parser = _Select(selectors)
    parser.feed(html)
    parser.close()
    for texts in parser.found:
        for text in texts:
            if len(text) >= least:
                return text
    return text_of_html(html) if whole else None


def html_field(html: Column, selectors: list[str], least: int = 1, whole: bool = False) -> Column:
    """selected_text over a column, in Arrow batches."""

    @F.pandas_udf("string")
    def pick(values: pd.Series) -> pd.Series:
        return values.map(lambda x: selected_text(x, selectors, least, whole), na_action="ignore")

    return pick(html)


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links: list[list[str]] = []
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.inside = bool(dict(attrs).get("href"))
            if self.inside:
                self.links.append([dict(attrs)["href"], ""])

    def handle_endtag(self, tag):
        if tag == "a":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.links[-1][1] += data


def links_of_html(html: str | None, base: str) -> list[tuple[str, str]]:
    """(address, anchor text) of a page's links to its own site, `www.` aside, resolved against its address, without
    fragments and slashes at the end, each address once."""
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    site = lambda u: urlsplit(u).netloc.lower().removeprefix("www.")
    out: dict[str, str] = {}
    for href, text in parser.links:
        try:
            url = urljoin(base, href.strip()).split("#")[0].rstrip("/")
            if url.startswith("http") and site(url) == site(base):
                out.setdefault(url, " ".join(text.split()))
        except ValueError:  # an address that cannot be read is no link
            continue
    return list(out.items())


def html_links(html: Column, base: Column) -> Column:
    """links_of_html over columns: an array of (url, text)."""

    @F.pandas_udf("array<struct<url:string,text:string>>")
    def find(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([[{"url": u, "text": t} for u, t in links_of_html(p, b or "")] for p, b in zip(pages, bases, strict=True)])

    return find(html, base)


def first_object(text: str | None) -> str | None:
    """The first JSON object that can be read from any `{` on, in canonical form."""
    if not text:
        return None
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            value, _ = decoder.raw_decode(text, at)
            return json.dumps(value, sort_keys=True, ensure_ascii=False)
        except ValueError:
            at = text.find("{", at + 1)
    return None


def json_object(text: Column) -> Column:
    """The first JSON object inside free text, or null: a text that is one as a whole stays in the JVM."""

    @F.pandas_udf("string")
    def convert(values: pd.Series) -> pd.Series:
        return values.map(first_object, na_action="ignore")

    return convert(text)


def with_model(df: DataFrame, columns: list[str], schema: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """df's columns through an outside model: `load` runs once per partition and gives a function from a batch of the
    columns to a batch in `schema`. Language models and embedders are plugged in here."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load()
            yield model(batch)

    return df.select(*columns).mapInPandas(apply, schema)
