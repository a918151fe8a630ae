"""Pages stuffed with keywords, links or tags instead of sentences.

A text is divided at line ends and at sentence ends; a line that is wrapped inside a sentence is put together again. Six
measures are taken of every piece, each in twentieths:

top      share of its words that are its few most frequent words (one in eight of its places)
pairs    share of its words that belong to the page's three most repeated pairs of content words
copies   how often the page repeats the line, or what its entries have in common
links    share of the line that is links, addresses, hash tags or a site's name behind a title
density  entries for its words: separators in the line, or short lines that follow one another
function share of its words that are function words

Ordinary sentences of a language keep each measure within narrow limits, and these are calibrated per language over all
documents: a native aggregate gives the quartiles of every measure over the words of ended sentences. A piece is stuffed if
one of the first five passes the upper fence of its language (the third quartile and three times the distance of the
quartiles, but no less than the measure's floor), or if its function words are fewer than a fraction of the language's
median. A document is spam if most of its words stand in stuffed pieces. Tables of figures, dated values, programme lines,
glossary entries, headings and references are neutral.

Function words are listed for seven languages. Texts of other languages form groups by script, whose function words are
learned from the corpus: short words (single signs in scripts without words) that stand in many of the group's sentences.
A group with too few sentences, or whose sentences share no such words, is not judged by function words at all. Texts with
few function words and no letters foreign to the listed languages may be keyword strings of these; where their group has no
sentences of its own, their unended pieces are judged by the median of the listed languages, and their sentences are not.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstone.session import spread, stored

#: Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an which they were their has would could should will more than after before while if how why what who its been over under into about when there these those may might through during between against",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei während rund obwohl ohne blieb",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d l à ou été cette s n depuis sans selon tandis bien près environ y leur mais comme entre ont qu aurait",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era según mientras aunque desde cerca unos habría",
    "it": "di e il la che in un a per è una sono del con non si da dei le al nel alla della più ma come anche dal gli lo ha o se tra su",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando muito nos já",
    "nl": "de en van het een in is dat op te zijn met voor niet aan er om ook als dan maar bij uit nog door over naar worden werd heeft",
}
_LANGUAGES = {w: [k for k, words in FUNCTION_WORDS.items() if w in words.split()] for words in FUNCTION_WORDS.values() for w in words.split()}
_LISTED = frozenset(_LANGUAGES)
#: The letters of these languages.
_LETTERS = set("abcdefghijklmnopqrstuvwxyzäöüßàâçéèêëîïôûùœæáíñóúìòãõÿªº")
#: Share of a language's function words from which a text counts as written in it.
WRITTEN = 0.15
#: The measures with the floors of their thresholds, in twentieths.
FLOORS = {"top": 13, "pairs": 7, "copies": 10, "links": 10, "density": 10}
#: Short lines in a row that make a list.
RUN = 8
#: Words of the longest line that can be an entry of a list of like lines.
SHORT = 12
#: Letters of the longest function word that is learned, and the share of sentences that must hold it (signs: in scripts
#: without words).
LEARNED_LETTERS, LEARNED_SHARE, LEARNED_SIGNS = 3, 0.02, 0.2
#: Words of sentences that calibrate a group whose function words are learned, and the least median share of them.
LEARNED_WORDS, LEARNED_MEDIAN = 1000, 2
#: Kinds of pieces: ended sentences, other running pieces, list lines.
SENTENCE, OPEN, LINE = 1, 2, 3
ENDS = tuple(".!?:\"”»。؟।۔…")
_CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯฀-๿]")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_CJK_WORD = re.compile(rf"{_CJK.pattern}{{1,2}}|(?:(?!{_CJK.pattern})[^\W_])+")
_SPACED = re.compile(r"[가-힯฀-๿]")  # scripts in which blanks are no separators
_CJK_SEPARATORS, _CJK_BLANKS = re.compile(r"[|｜/／・･·•、，,;；»>›~]+"), re.compile(r"[|｜/／・･·•、，,;；»>›~\s]+")
_CJK_PIECES = re.compile(r"[|｜/／・･·•、，,;；»>›~\s。．！？.!?]+")
_CJK_STOP, CJK_ENDS = re.compile(r"[。．！？]"), (*ENDS, "！", "？", "．")
_CJK_SENTENCE = re.compile(r"(?<=[。．！？!?])|(?<=\.)\s+")
_LINK = re.compile(r"\[[^\[\]\n]*\]\([^)\s]*\)?|(?:https?://|www\.)\S+")
_SITE = re.compile(r"\s[-–—|·]\s*[a-z0-9-]+(?:\.[a-z0-9-]+)+$")
_PRICE = re.compile(r"\s[$€£]?\d+[.,]\d\d ?[$€£]?$")
_SEPARATORS = re.compile(r"\s[|/·•»>~]\s|[|•;]\s*|\s{2,}|\s›\s")
_NEUTRAL = re.compile(r"^\s*(?:[-*]\s*)?(?:\d{1,2}:\d{2}\b|\d{4}-\d{2}-\d{2}\b|\[\d+\]\s|[A-Z_]{3,30}:\s?[^,]*$|[QA]:\s)")
_SEPARATOR = re.compile(r"[|/·•»>~;›]|\s\s")
_SENTENCE = re.compile(r"(?<=[.!?。！？؟।۔])\s+")
_LABEL = re.compile(r"^\s*[^\s:][^:\n]{0,40}:\s+")
_REFERENCE = re.compile(r"\s*\[\d+\]\s")
_COUNT = re.compile(r"\(\d+\)")
_LOWER = re.compile(r"[^\W\d_]+")

#: (n, kind, top, pairs, copies, links, density, function) of a piece.
Piece = tuple[int, int, int, int, int, int, int, int]
_SCRIPTS: dict[str, str] = {}


def script_of(letter: str) -> str:
    """The script of a letter, by its name in the Unicode tables."""
    got = _SCRIPTS.get(letter)
    if got is None:
        name = unicodedata.name(letter, "OTHER").split(" ")[0].split("-")[0]
        got = _SCRIPTS[letter] = {"HIRAGANA": "kana", "KATAKANA": "kana", "CJK": "han"}.get(name, name.lower())
    return got


def group_of(text: str, counts: Counter, words: int) -> str:
    """The language of a text if it is a listed one, else `latin` (no foreign letters), `latin other` or the script;
    scripts without words give `kana`, `han`, `hangul` and `thai`. The language is the one with most different function
    words in the text, since a repeated keyword may hold one of any language."""
    different, votes = Counter(), Counter()
    for w, n in counts.items():
        for k in _LANGUAGES.get(w, ()):
            different[k] += 1
            votes[k] += n
    best = max(votes, key=lambda k: (different[k], votes[k], k)) if votes else ""
    written = best and votes[best] >= WRITTEN * words
    if text.isascii():
        return best if written else "latin"
    if len(_CJK.findall(text)) * 2 > len(text):
        signs = Counter(script_of(c) for c in text if c.isalpha())
        return "kana" if signs["kana"] * 10 > signs["han"] > 0 or signs["kana"] > 0 and not signs["han"] else max(("han", "hangul", "thai"), key=lambda s: (signs[s], s))
    if written:
        return best
    scripts: Counter = Counter()
    foreign = total = 0
    for c, n in Counter(text.lower()).items():
        if c.isalpha():
            total += n
            scripts[script_of(c)] += n
            foreign += n * (c not in _LETTERS)
    first = max(scripts, key=lambda s: (scripts[s], s)) if scripts else "latin"
    return first if first != "latin" else "latin other" if foreign * 100 >= total else "latin"


def listed_language(group: str) -> bool:
    return group in FUNCTION_WORDS


def measures(text: str, learned: dict[str, frozenset] | None = None) -> tuple[str, int, list[Piece]]:
    """(group, words, pieces) of a text. `learned` has the function words of groups that are no listed language."""
    lines = [x for x in text.split("\n") if x.strip()]
    words = [_WORD.findall(x.lower()) for x in lines]
    total = sum(map(len, words))
    if not total:
        return "", 0, []
    group = group_of(text, Counter(chain.from_iterable(words)), total)
    own = (learned or {}).get(group, frozenset())
    if group in ("kana", "han", "hangul", "thai"):
        words = [_CJK_WORD.findall(x.lower()) for x in lines]
        return group, sum(map(len, words)), _merged(_cjk_pieces(lines, words, own))
    # a word of any language's function words counts, since pages mix languages
    return group, total, _merged(_pieces(*_unwrapped(lines, words), _LISTED | own if own else _LISTED))


def _merged(pieces: list[Piece]) -> list[Piece]:
    """Pieces of equal kind and measures as one."""
    sums: dict[tuple, int] = {}
    for n, *rest in pieces:
        sums[tuple(rest)] = sums.get(tuple(rest), 0) + n
    return [(n, *rest) for rest, n in sums.items()]


def _unwrapped(lines: list[str], words: list[list[str]]) -> tuple[list[str], list[list[str]]]:
    """Lines that break off inside a sentence joined to the line that ends it: each goes on in small letters, and the last
    one is ended."""
    out, held = ([], []), []
    for line, own in zip(lines, words, strict=True):
        if held and not line.lstrip()[:1].islower():
            for h in held:
                out[0].append(h[0])
                out[1].append(h[1])
            held = []
        ended = line.rstrip()[-1:] in ENDS
        if not ended and len(own) > 5 and "\t" not in line:
            held.append((line, own))
            continue
        if held and ended:
            held.append((line, own))
            out[0].append(" ".join(h[0].strip() for h in held))
            out[1].append([w for h in held for w in h[1]])
            held = []
            continue
        for h in [*held, (line, own)]:
            out[0].append(h[0])
            out[1].append(h[1])
        held = []
    for h in held:
        out[0].append(h[0])
        out[1].append(h[1])
    return out


def _pieces(lines: list[str], words: list[list[str]], functions: frozenset | set) -> list[Piece]:
    heads = Counter(_lead(x) for x, w in zip(lines, words, strict=True) if len(w) <= SHORT)
    same = Counter(x.strip().lower() for x in lines)
    out, prose = _lists(lines, words, heads, same)
    parts = []
    for line, own in prose:
        sentences = _SENTENCE.split(line)
        if len(sentences) == 1:
            parts.append((own, line.rstrip()[-1:]))
        else:
            parts += [(_WORD.findall(s.lower()), s.rstrip()[-1:]) for s in sentences]
    repeated = _repeated(parts, functions)
    for part, end in parts:
        m = len(part)
        if not m:
            continue
        pairs = sum([w in repeated for w in part]) * 20 // m if repeated else 0
        ended = end in ENDS and m >= 6
        function = 20
        if ended or m > 10:
            function = sum([w in functions for w in part]) * 20 // m
        top = _top(part, m) if m >= 25 or ended and m >= SHORT else 0
        out.append((m, SENTENCE if ended else OPEN, top if m >= 25 and not ended else min(top, FLOORS["top"] - 1), pairs, 0, 0, 0, function))
    return out


def _top(part: list[str], m: int) -> int:
    """Twentieths of the words that are the m // 8 most frequent ones."""
    few = max(1, m // 8)
    if len(set(part)) == m:
        return few * 20 // m
    return sum(n for _, n in Counter(part).most_common(few)) * 20 // m


def _lists(lines: list[str], words: list[list[str]], heads: Counter, same: Counter) -> tuple[list[Piece], list[tuple[str, list[str]]]]:
    """(list lines, the other lines with their words that are not neutral)."""
    out, run, prose = [], [], []
    for line, own in zip([*lines, ""], [*words, []], strict=True):
        n = len(own)
        kind, copies, links, density = _line(line, n, heads, same) if n else ("", 0, 0, 0)
        if kind == "short":
            run.append((line, own))
            continue
        if run and kind != "listed":
            # short lines count as a list where many follow one another
            if len(run) >= RUN:
                out.append((sum(len(w) for _, w in run), LINE, 0, 0, 0, 0, min(20, 10 * len(run) // RUN), 20))
            else:
                prose += run
            run = []
        if kind == "listed":
            out.append((n, LINE, 0, 0, copies, links, density, 20))
        elif kind == "prose":
            prose.append((line, own))
    return out, prose


def _line(line: str, n: int, heads: Counter, same: Counter) -> tuple[str, int, int, int]:
    """(kind, copies, links, density): `listed` (a measure reaches its floor), `neutral`, `short` (an unended line of a few
    words) or `prose`."""
    bare = line.strip()
    if _REFERENCE.match(line):
        return "neutral", 0, 0, 0
    links = 0
    if "://" in line or "](" in line or "www." in line:
        links = 20 * sum(len(m.group(0)) for m in _LINK.finditer(line)) // len(bare)
    tags = line.count("#")
    if tags >= 2:
        links = max(links, min(20, 20 * tags // len(line.split())))
    if links >= FLOORS["links"]:
        return "listed", 0, links, 0
    tabs = bare.count("\t")
    if _NEUTRAL.match(line) or tabs and n <= 6 * (tabs + 1):
        return "neutral", 0, links, 0
    # sites and prices stand at the end: the last three words tell
    tail = " ".join([" ", *bare.rsplit(None, 3)[-3:]])
    copies = min(20, 4 * (same[bare.lower()] - 1))
    lead = heads[_lead(line)] if n <= SHORT else 0
    ended = bare[-1:] in ENDS
    if n <= SHORT and ":" not in line and lead >= 2 and _PRICE.search(tail):
        copies = max(copies, min(20, 5 * lead))
    if n <= 10 and not ended:
        copies = max(copies, min(20, 10 * lead // 6))
    if _SITE.search(tail):
        links = 20
    density = 0
    if "(" in line:
        density = min(20, 10 * len(_COUNT.findall(line)) // 3)
    if _SEPARATOR.search(line):
        parts = [p for p in _SEPARATORS.split(line) if p.strip()]
        if len(parts) >= 5 and sum(p.rstrip()[-1:] in ".!?" for p in parts) * 3 < len(parts):
            density = max(density, min(20, 90 * len(parts) // n))
    if not ended and line.count(", ") >= 3:
        commas = _LABEL.sub("", line).split(", ")
        if len(commas) >= 4:
            density = max(density, min(20, 70 * len(commas) // max(1, sum(len(c.split()) for c in commas))))
    if copies >= FLOORS["copies"] or links >= FLOORS["links"] or density >= FLOORS["density"]:
        return "listed", copies, links, density
    return ("short" if n <= 10 and not ended else "prose"), copies, links, density


def _repeated(parts: list[tuple[list[str], str]], functions) -> set[str]:
    """The words of the most frequent pairs of content words, if these make up a quarter of all content words."""
    content = [w for part, _ in parts for w in part if w not in functions and not w.isdigit()]
    top = [(p, n) for p, n in Counter(zip(content, content[1:])).most_common(3) if n >= 4]
    if sum(n for _, n in top) * 8 < len(content):
        return set()
    return {w for p, _ in top for w in p}


def _lead(line: str) -> str:
    """What lines of one list have in common: their words in small letters, without numbers and names; where there are none,
    the first two words."""
    words = _LOWER.findall(line)
    return " ".join([w for w in words if w[0].islower()]) or " ".join(words[:2]) or line.strip()


# --- scripts without words: two characters count as a word ---
def _cjk_pieces(lines: list[str], words: list[list[str]], functions: frozenset) -> list[Piece]:
    heads = Counter(_lead(x) for x, w in zip(lines, words, strict=True) if len(w) <= SHORT)
    same = Counter(x.strip().lower() for x in lines)
    pieces = Counter(p for x in lines for p in _CJK_PIECES.split(x.lower()) if len(p) > 1)
    out, prose = _lists(lines, words, heads, same)
    rest = []
    for line, own in prose:
        bare = line.strip()
        parts = [p for p in (_CJK_SEPARATORS if _SPACED.search(bare) else _CJK_BLANKS).split(bare) if p]
        stopped = bare[-1:] in CJK_ENDS or _CJK_STOP.search(bare)
        density = min(20, 90 * len(parts) // max(1, len(own))) if not stopped and len(parts) >= 5 else 0
        if density >= FLOORS["density"]:
            out.append((len(own), LINE, 0, 0, 0, 0, density, 20))
        else:
            rest += [x for x in _CJK_SENTENCE.split(bare) if x and x.strip()]
    repeated = _repeated_signs(rest)
    for sentence in rest:
        n = len(_CJK_WORD.findall(sentence.lower()))
        if not n:
            continue
        letters = sum(map(str.isalnum, sentence)) or 1
        held = min(n, sum(len(_CJK_WORD.findall(p)) for p in _CJK_PIECES.split(sentence.lower()) if pieces[p] >= 4))
        pairs = min(20, 20 * sum(_covered(sentence, repeated)) // letters) if repeated else 0
        function = 20 * sum([c in functions for c in sentence]) // letters if n >= 6 else 20
        kind = SENTENCE if sentence.rstrip()[-1:] in CJK_ENDS and n >= 6 else OPEN
        # the part that recurs word for word counts as copies, the rest is judged by itself
        if held:
            out.append((held, kind, 0, pairs, 20, 0, 0, function))
        if n > held:
            out.append((n - held, kind, 0, pairs, 0, 0, 0, min(20, function)))
    return out


def _covered(sentence: str, grams: set[str]) -> list[bool]:
    """Which characters belong to one of the three-character strings."""
    out = [False] * len(sentence)
    for i in range(len(sentence) - 2):
        if sentence[i : i + 3] in grams:
            out[i : i + 3] = [True] * 3
    return out


def _repeated_signs(sentences: list[str]) -> set[str]:
    """The most frequent strings of three characters, if they cover a quarter of all letters."""
    grams = Counter(g for x in sentences for g in (x[i : i + 3] for i in range(len(x) - 2)) if g.isalpha())
    top = {g for g, n in grams.most_common(3) if n >= 4}
    if not top or sum(sum(_covered(x, top)) for x in sentences) * 4 < sum(map(str.isalnum, "".join(sentences))):
        return set()
    return top


# --- function words that are learned ---
def sentence_tokens(text: str, group: str) -> Iterator[set[str]]:
    """The short words (or signs) of every ended sentence of at least six words."""
    signs = group in ("kana", "han", "hangul", "thai")
    lines = [x for x in text.split("\n") if x.strip()]
    if not signs:
        lines = _unwrapped(lines, [_WORD.findall(x.lower()) for x in lines])[0]
    for line in lines:
        for s in (_CJK_SENTENCE if signs else _SENTENCE).split(line.strip()):
            if s and s.rstrip()[-1:] in (CJK_ENDS if signs else ENDS):
                words = (_CJK_WORD if signs else _WORD).findall(s.lower())
                if len(words) >= 6:
                    yield {c for c in s if c.isalpha()} if signs else {w for w in words if len(w) <= LEARNED_LETTERS and not w.isdigit()}


def learned_words(texts: DataFrame) -> dict[str, frozenset]:
    """The function words of each group of (language, text), counted over all of its sentences. A group has at most its
    sentences' mean number of short words over the least share, a few hundred: that is all that reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: Counter = Counter()
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for words in sentence_tokens(text, group):
                    sums[group, ""] += 1
                    sums.update((group, w) for w in words)
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k] for k in keys], pa.int64())],
                ["language", "token", "n"],
            )

    counted = texts.select("language", "text").mapInArrow(count, "language string, token string, n long").groupBy("language", "token").agg(F.sum("n").alias("n"))
    counted = stored(counted, "tokens")
    whole = counted.where("token = ''").select("language", F.col("n").alias("all"))
    signs = F.col("language").isin("kana", "han", "hangul", "thai")
    least = F.when(signs, LEARNED_SIGNS).otherwise(LEARNED_SHARE)
    rows = counted.where("token <> ''").join(F.broadcast(whole), "language").where(F.col("n") >= least * F.col("all"))  # one row per script
    out: dict[str, set] = {}
    for r in rows.select("language", "token").collect():
        out.setdefault(r.language, set()).add(r.token)
    return {k: frozenset(v) for k, v in out.items()}


def page_measures(documents: DataFrame, key: str, text: str, learned: dict[str, frozenset] | None = None) -> DataFrame:
    """(key, language, words, pieces, text): the pieces of measures() for each row; text only where the language is none of
    the listed ones."""
    frame = spread(documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("_text")))
    kind = frame.schema["key"].dataType.simpleString()
    names = ["n", "kind", *FLOORS, "function"]
    struct = pa.struct([("n", pa.int32()), *[(x, pa.int8()) for x in names[1:]]])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [measures(t or "", learned) for t in texts]
            flat = list(zip(*[p for r in rows for p in r[2]], strict=True)) or [[] for _ in names]
            ends = [0]
            for r in rows:
                ends.append(ends[-1] + len(r[2]))
            values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, struct, strict=True)], fields=list(struct))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                    pa.array([None if not r[1] or listed_language(r[0]) else t for r, t in zip(rows, texts, strict=True)], pa.string()),
                ],
                ["key", "language", "words", "pieces", "text"],
            )

    inner = ", ".join(["n: int", *[f"{x}: tinyint" for x in names[1:]]])
    return frame.mapInArrow(make, f"key {kind}, language string, words int, pieces array<struct<{inner}>>, text string")


def calibrated(measured: DataFrame, fraction: float = 0.35, least: int = 2000) -> DataFrame:
    """(language, top, pairs, copies, links, density, function): the thresholds of every language, from the quartiles of
    its sentences' measures by words, over all documents; `function` is null where the language is not judged by it.

    A row with a null language has the thresholds over the listed languages, for those with fewer than `least` words of
    sentences.
    """
    names = [*FLOORS, "function"]
    rows = measured.where("words > 0").select("language", F.inline("pieces")).where(F.col("kind") == SENTENCE)
    rows = rows.select("language", "n", F.inline(F.array(*[F.struct(F.lit(x).alias("measure"), F.col(x).cast("int").alias("bin")) for x in names])))
    bins = rows.groupBy("language", "measure", "bin").agg(F.sum("n").alias("n"))
    listed = F.col("language").isin(*FUNCTION_WORDS)
    whole = bins.where(listed).groupBy("measure", "bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("language"), "measure", "bin", "n")
    sized = bins.union(whole).groupBy("language", "measure").agg(F.percentile("bin", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"), F.sum("n").alias("words"))
    q = lambda i: F.col("q")[i]
    fence = q(2) + 3 * (q(2) - q(0))
    # a language of its own function words is calibrated by fewer words than one whose function words are learned
    enough = listed | F.col("language").isNull() | ((F.col("words") >= LEARNED_WORDS) & (q(1) >= LEARNED_MEDIAN))
    pick = lambda name, c: F.max(F.when(F.col("measure") == name, c)).alias(name)
    return sized.where((F.col("words") >= least) | F.col("language").isNull()).groupBy("language").agg(
        *[pick(x, F.greatest(F.lit(float(floor)), fence)) for x, floor in FLOORS.items()], pick("function", F.when(enough, F.floor(q(1) * fraction).cast("double")))
    )


def _stuffed(piece: Column) -> Column:
    """Whether one of the measures of a piece passes its threshold."""
    over = F.lit(False)
    for x in FLOORS:
        over = over | (piece[x] >= F.coalesce(F.col(f"own.{x}"), F.col(f"any.{x}"), F.lit(float(FLOORS[x]))))
    # without a threshold of its own, a text in the letters of the listed languages has that of all of them for what is no sentence
    any_open = F.when((F.col("language") == "latin") & (piece["kind"] == OPEN), F.coalesce(F.col("any.function"), F.lit(1.0)))
    any_listed = F.when(F.col("language").isin(*FUNCTION_WORDS), F.coalesce(F.col("any.function"), F.lit(1.0)))
    least = F.coalesce(F.col("own.function"), any_open, any_listed)
    return over | F.coalesce(piece["function"] < least, F.lit(False))


def stuffed_pages(documents: DataFrame, key: str, text: str, *, share: float = 0.5, fraction: float = 0.35) -> DataFrame:
    """(key, language, words, spam_words): the rows in which more than `share` of the words stand in stuffed pieces.

    Null, empty and blank texts and texts without words are never found. Repeated rows are judged one by one, extra
    columns are not read, an empty table gives an empty one. The language is found from the function words and letters, so
    a wrong or missing label does not matter. Counts and thresholds are over all documents; the tables of thresholds and of
    learned words have a row per language or script.
    """
    measured = stored(page_measures(documents, key, text), "pages")
    rest = measured.where("text IS NOT NULL")
    if rest.limit(1).count():
        learned = learned_words(rest)
        known = F.col("text").isNotNull() & F.col("language").isin(*learned) if learned else F.lit(False)
        again = stored(page_measures(measured.where(known).select("key", "text"), "key", "text", learned), "pages")
        measured = measured.where(~known).union(again)
    measured = measured.drop("text")
    levels = stored(calibrated(measured, fraction), "levels").coalesce(1)
    names = [*FLOORS, "function"]
    own = levels.where("language IS NOT NULL").select("language", F.struct(*names).alias("own"))
    # one row for each listed language and script, and one for all: both have a proven size
    every = levels.where("language IS NULL").select(F.struct(*names).alias("any"), F.lit(1).alias("_one"))
    judged = measured.where("words > 0").withColumn("_one", F.lit(1)).join(F.broadcast(own), "language", "left").join(F.broadcast(every), "_one", "left")
    spam = F.aggregate("pieces", F.lit(0), lambda s, x: s + F.when(_stuffed(x), x["n"]).otherwise(0))
    return (
        judged.select("key", "language", "words", spam.alias("spam_words")).where(F.col("spam_words") > share * F.col("words"))
        .select(F.col("key").alias(key), "language", "words", "spam_words")
    )
