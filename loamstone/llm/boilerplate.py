"""Main text of web pages by a tree-structured graphical model of their lines.

The lines of a page form a tree: a teaser's sentence hangs on the teaser's title, a title on the title before it, anything
else on the line before it. Every line is article or boilerplate. Its own words, shape and place give the odds of either (a
logistic model); every parent-child pair has a potential that depends on the shapes of both. Sum-product messages, once
upward and once downward, give each line's exact marginal, and a line is boilerplate if that is more probable than not.
There are no phrases in the model but the words it has learned weights for.

Both parts are trained from labelled pages, at most `train_pages` of them, a bounded sample that is the same on every run;
by default the rules of page_labels.py label them, which take no part in judging. The model is a few thousand numbers,
whatever the corpus; pages are then worked through one by one within their partitions, with no shuffle. A page whose words
the training pages hardly hold (another language) is judged by a second set of weights, fitted without words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstone.session import spread

_HEADER = re.compile(r"^(?:[A-Z][A-Z_-]{1,30}|[a-z][a-z_-]{1,30}):(?:\s|$)")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_END = re.compile(r"[.!?。](?:[\"”»)\]]*)$")
_STOPS = re.compile(r"[^\W\d_]{2}[.!?][\"”»]?\s+[\"“«]?[A-ZÀ-Þ]|[%\d][.!?]\s+[A-ZÀ-Þ]")
_DIGIT = re.compile(r"\d")
_NUMBERED = re.compile(r"^\d{1,2}[.)]\s")
_SPLIT = re.compile(r"\s+[|·/>•–]\s+|\s{2,}|\s*[|•]\s*")


def parts_of(content: str) -> tuple[str, str, list[tuple[int, str, bool]]]:
    """(site, title, lines) of a content: lines are (number from 1, text, whether a blank line stands before it),
    without header lines and blank lines."""
    raw = content.split("\n")
    head, first = {}, 0
    for i, line in enumerate(raw):
        if not line.strip():
            first = i if i else 0
            break
        if not _HEADER.match(line):
            head, first = {}, 0
            break
        k, _, v = line.partition(":")
        head[k.strip().lower()] = v.strip()
    else:
        first = len(raw) if head else 0
    out, gap = [], False
    for i in range(first, len(raw)):
        text = raw[i].strip()
        if text:
            out.append((i + 1, text, gap))
        gap = not text
    return head.get("target", ""), head.get("title", ""), out


def kind_of(text: str, n: int) -> str:
    """The shape of a line."""
    if not (text[-1].isalnum() or text[-1] in ".!?"):
        end = len(text)
        while end and not (text[end - 1].isalnum() or text[end - 1] in "_.!?。\"”»)]:;,*%|-"):
            end -= 1
        text = text[:end] or text
    if "\t" in text:
        return "table"
    if not any(c.isalpha() for c in text):
        return "figures"
    if text[0] in "›»>→":
        return "item"
    if _NUMBERED.match(text) and not _END.search(text):
        return "numbered"
    if text[:2] in ("- ", "* ", "• "):
        return "dash"
    if _END.search(text):
        return "para" if n >= 10 and _STOPS.search(text) else "sent"
    if n >= 3 and len(_SPLIT.split(text)) >= 3:
        return "split"
    return "head" if n <= 3 else "title" if n <= 18 else "long"


def tree_of(kinds: list[str]) -> tuple[list[int], list[str]]:
    """(parent, edge) of each line: -1 for the first."""
    parent, edge = [], []
    for i, k in enumerate(kinds):
        if not i:
            parent.append(-1)
            edge.append("root>" + k)
            continue
        p, rel = i - 1, ""
        before = kinds[i - 1]
        if k == "title" and before == "sent" and kinds[parent[i - 1]] == "title" and edge[i - 1].startswith("title"):
            p, rel = parent[i - 1], "alternate"  # title, its sentence, next title
        elif before == "sent" and i > 1 and edge[i - 1].startswith("title") and k in ("sent", "para"):
            rel = "second"
        elif k == "sent" and before == "title" and i > 1 and kinds[i - 2] == "title":
            rel = "run"  # the titles before have no sentences
        parent.append(p)
        edge.append(f"{kinds[p]}>{k}{rel}")
    return parent, edge


def page_features(site: str, title: str, lines: list[tuple[int, str, bool]]) -> tuple[list[str], list[list[str]], list[list[str]]]:
    """(kinds, features, words) of a page's lines: features are names of shape and place."""
    count = len(lines)
    lows = [x.lower() for _, x, _ in lines]
    words = [_WORD.findall(x) for x in lows]
    kinds = [kind_of(x, len(w)) for (_, x, _), w in zip(lines, words, strict=True)]
    body = [i for i, k in enumerate(kinds) if k == "para" or k == "sent" and len(words[i]) >= 10]
    title, site = title.lower(), site.lower()
    named = next((i for i, x in enumerate(lows) if title and x.startswith(title) and len(x) < len(title) + 12), None)
    if named is None and body:
        # without a title in the header, the last title-like line before the text takes its place
        named = next((i for i in range(body[0] - 1, -1, -1) if kinds[i] in ("title", "long")), None)
        if named is not None:
            title = lows[named]
    begin = named if named is not None else body[0] if body else 0
    end = body[-1] if body else count
    seen = Counter(lows)
    # how many lines of one shape follow one another
    run = [1] * count
    for i in range(1, count):
        if kinds[i] == kinds[i - 1]:
            run[i] = run[i - 1] + 1
    for i in range(count - 2, -1, -1):
        if kinds[i] == kinds[i + 1]:
            run[i] = run[i + 1]
    out = []
    for i, (_, text, gap) in enumerate(lines):
        kind, low, n = kinds[i], lows[i], len(words[i])
        zone = "top" if i < begin else "title" if i == begin else "foot" if i > end else "mid"
        last, first = text[-1], text[0]
        before, after = kinds[i - 1] if i else "", kinds[i + 1] if i + 1 < count else ""
        own = [
            "k:" + kind, f"n:{kind}:{n if n < 13 else min(n // 10, 9) * 10}", "e:" + ("x" if last.isalnum() else last), "s:" + ("x" if first.isalnum() else first),
            f"z-{zone}:{kind}", f"t{min(i, 4)}:{kind}", f"b{min(count - 1 - i, 4)}:{kind}", f"{'gap' if gap else 'nogap'}:{kind}",
            f"r:{kind}:{min(run[i], 6)}:{zone}", f"a:{before}>{kind}>{after}",
        ]
        caps = sum([x[0].isupper() for x in text.split()])
        own.append(f"c:{kind}:{min(4, 4 * caps // max(1, n))}")
        if text.isupper():
            own.append("upper:" + kind)
        if seen[low] > 1:
            own.append("twice:" + kind)
        if title:
            if low.startswith(title) and len(low) < len(title) + 12:
                own.append("is-title")
            elif title in low:
                own.append("has-title:" + kind)
        if site and site in low:
            own.append("site:" + kind)
        if _DIGIT.search(text):
            own.append("digits:" + kind)
        out.append(own)
    return kinds, out, [["0" if w.isdigit() else w for w in x] for x in words]


def _terms(words: list[str]) -> list[str]:
    """The words of a line and its pairs of words."""
    return [*words, *map(" ".join, zip(words, words[1:]))] if len(words) > 1 else words


class Weights:
    """A bias, the weights of features and words, and the potentials of edges."""

    def __init__(self, bias: float, weights: dict[str, float], edges: dict[str, tuple[float, float, float, float]]):
        self.bias, self.edges = bias, edges
        self.weights = {x: w for x, w in weights.items() if x[:2] != "w:"}
        self.words = {x[2:]: w for x, w in weights.items() if x[:2] == "w:"}

    @classmethod
    def fit(cls, rows: list[list[str]], terms: list[list[str]], labels: list[int], pairs: list[tuple[int, int, str]], *, least: int, rounds: int, ridge: float) -> Weights:
        """By pseudo-likelihood; rows are feature names, terms words, pairs (row of the child, row of the parent, edge)."""
        terms = [["w:" + x for x in t] for t in terms]
        seen = Counter(x for f, t in zip(rows, terms, strict=True) for x in {*f, *t})
        common = {e for e, n in Counter(e for _, _, e in pairs).items() if n >= least}
        names = sorted(x for x, n in seen.items() if n >= least) + sorted(f"{e}|{a}{b}" for e in common for a in (0, 1) for b in (0, 1))
        number = {x: i for i, x in enumerate(names)}
        at, col, val = [], [], []

        def put(row: int, name: str, value: float) -> None:
            if (c := number.get(name)) is not None:
                at.append(row)
                col.append(c)
                val.append(value)

        for r, (f, t) in enumerate(zip(rows, terms, strict=True)):
            for x in f:
                put(r, x, 1.0)
            for x in t:
                put(r, x, _scale(len(t)))
        # given the states around it, a line's odds are linear in the potentials of its edges
        for child, parent, e in pairs:
            put(child, f"{e}|{labels[parent]}1", 1.0)
            put(child, f"{e}|{labels[parent]}0", -1.0)
            put(parent, f"{e}|1{labels[child]}", 1.0)
            put(parent, f"{e}|0{labels[child]}", -1.0)
        at, col, val, y = np.array(at, np.int64), np.array(col, np.int64), np.array(val), np.array(labels, float)
        weight, bias = np.zeros(len(number)), 0.0
        first, second = np.zeros(len(number) + 1), np.zeros(len(number) + 1)
        for k in range(1, rounds + 1):  # Adam on the whole sample
            z = np.bincount(at, val * weight[col], len(y)) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            g = (p - y) / max(1, len(y))
            grad = np.append(np.bincount(col, val * g[at], len(number)) + ridge * weight, g.sum())
            first = 0.9 * first + 0.1 * grad
            second = 0.99 * second + 0.01 * grad**2
            step = 0.3 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8) * min(1.0, 30 / k)
            weight, bias = weight - step[:-1], bias - step[-1]
        edges = {e: tuple(float(np.exp(weight[number[f"{e}|{s}"]])) for s in ("00", "01", "10", "11")) for e in common}
        return cls(float(bias), {x: float(weight[i]) for x, i in number.items() if "|" not in x and abs(weight[i]) > 1e-3}, edges)

    def odds(self, features: list[str], terms: list[str]) -> float:
        """A line's own odds of being boilerplate, without its neighbours."""
        get, word = self.weights.get, self.words.get
        z = self.bias + sum([get(x, 0.0) for x in features]) + _scale(len(terms)) * sum([word(x, 0.0) for x in terms])
        return math.exp(max(-30.0, min(30.0, z)))

    def marginals(self, own: list[float], parent: list[int], edge: list[str]) -> list[float]:
        """The probability of boilerplate of each line of a tree, from its own odds and the messages of both directions."""
        n = len(own)
        psi = [self.edges.get(e, (1.0, 1.0, 1.0, 1.0)) for e in edge]
        up = [1.0] * n  # odds that a child's message gives its parent
        inside = own[:]
        for i in range(n - 1, 0, -1):  # children come after their parents
            a, b, c, d = psi[i]
            o = inside[i]
            up[i] = (c + d * o) / (a + b * o)
            p = parent[i]
            inside[p] = min(1e30, max(1e-30, inside[p] * up[i]))
        belief = inside[:]
        for i in range(1, n):
            a, b, c, d = psi[i]
            rest = belief[parent[i]] / up[i]
            belief[i] = min(1e30, max(1e-30, inside[i] * (b + d * rest) / (a + c * rest)))
        return [o / (1 + o) for o in belief]


def _scale(n: int) -> float:
    """The weight of one of n terms: long lines do not count for more than short ones."""
    return min(1.0, 16 / max(1, n))


class PageModel:
    """Weights with words, weights without, and the words of the training pages."""

    #: Share of a page's words that must be known for the weights with words.
    KNOWN = 0.35

    def __init__(self, full: Weights, shape: Weights, known: set[str]):
        self.full, self.shape, self.known = full, shape, known

    @classmethod
    def train(cls, pages: list[str], label=None, *, least: int = 3, rounds: int = 100, ridge: float = 1e-5) -> PageModel:
        """The model of the contents; label(site, title, lines) gives 0 or 1 for each line, by default the rules of
        page_labels."""
        if label is None:
            from loamstone.llm.page_labels import labelled as label
        rows, terms, labels, pairs = [], [], [], []
        seen: Counter = Counter()
        for content in pages:
            site, title, lines = parts_of(content)
            if not lines:
                continue
            kinds, names, words = page_features(site, title, lines)
            base = len(rows)
            rows += names
            terms += [_terms(w) for w in words]
            seen.update({x for w in words for x in w})
            labels += label(site, title, lines)
            parents, edges = tree_of(kinds)
            pairs += [(base + i, base + p, edges[i]) for i, p in enumerate(parents) if p >= 0]
        options = {"least": least, "rounds": rounds, "ridge": ridge}
        full = Weights.fit(rows, terms, labels, pairs, **options)
        shape = Weights.fit(rows, [[] for _ in rows], labels, pairs, **options)
        return cls(full, shape, {w for w, n in seen.items() if n > 1})

    def marginals(self, site: str, title: str, lines: list[tuple[int, str, bool]], words_count: bool | None = None) -> list[float]:
        """The probability of boilerplate for each line. words_count chooses the weights; by default the page's words do."""
        kinds, names, words = page_features(site, title, lines)
        if words_count is None:
            total = sum(map(len, words))
            words_count = sum([w in self.known for x in words for w in x]) >= self.KNOWN * total
        weights = self.full if words_count else self.shape
        own = [weights.odds(f, _terms(w) if words_count else []) for f, w in zip(names, words, strict=True)]
        return weights.marginals(own, *tree_of(kinds))


def train_model(pages: DataFrame, content: str, *, train_pages: int = 2000) -> PageModel:
    """A model from at most train_pages contents: those with the least hash of their text, the same on every run."""
    text = F.col(f"`{content}`")
    hashed = pages.select(text.alias("c"), F.xxhash64(text).alias("h")).where(F.length("c") > 0)
    # first the hashes alone decide, so that no more than the sample's texts ever reach the driver
    least = hashed.select("h").distinct().orderBy("h").limit(train_pages).agg(F.max("h")).first()[0]
    if least is None:
        return PageModel.train([])
    sample = hashed.where(F.col("h") <= least).dropDuplicates(["h"]).orderBy("h").limit(train_pages)
    return PageModel.train([r.c for r in sample.collect()])


def boilerplate_lines(
    pages: DataFrame, key: str, content: str, *, model: PageModel | None = None, train_pages: int = 2000, certainty: float = 0.5
) -> DataFrame:
    """(key, line_no, probability): the boilerplate lines of every content, numbered from 1 over the whole content.

    Lines end at line feeds; carriage returns and other white space at their ends mean nothing. Header lines at the top
    (`KEY: value` up to the first blank line) and lines of white space are never given. Null and empty contents give no
    rows; repeated rows give theirs once per row, a null key stays null, extra columns are not read, and an empty table
    gives an empty one. A page of any length is judged whole, in time proportional to its lines.
    """
    model = model or train_model(pages, content, train_pages=train_pages)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    frame = spread(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{content}`").alias("_c")).where(F.length("_c") > 0))
    kind = frame.schema["key"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, odds = [], [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                site, title, lines = parts_of(text)
                if not lines:
                    continue
                for (no, _, _), p in zip(lines, shared.value.marginals(site, title, lines), strict=True):
                    if p > certainty:
                        row.append(r)
                        number.append(no)
                        odds.append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(odds, pa.float64())],
                ["key", "line_no", "probability"],
            )

    return frame.mapInArrow(judge, f"key {kind}, line_no int, probability double").withColumnRenamed("key", key)


def main_text(pages: DataFrame, key: str, content: str, **options) -> DataFrame:
    """(key, text): the contents without their boilerplate and header lines; repeated rows of a key stay apart."""
    return boilerplate_free(pages, key, content, options.pop("model", None) or train_model(pages, content, **options))


def boilerplate_free(pages: DataFrame, key: str, content: str, model: PageModel) -> DataFrame:
    """(key, text) of each row: the article's lines, joined by line feeds; null where the content is null."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    frame = spread(pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{content}`").alias("_c")))
    kind = frame.schema["key"].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                if text is None:
                    out.append(None)
                    continue
                site, title, lines = parts_of(text)
                marks = shared.value.marginals(site, title, lines) if lines else []
                out.append("\n".join(t for (_, t, _), p in zip(lines, marks, strict=True) if p <= 0.5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])

    return frame.mapInArrow(keep, f"key {kind}, text string").withColumnRenamed("key", key)
