"""Texts, titles, addresses and terms as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s\x{00A0}]+", " "))


def plain_title(title: Column) -> Column:
    """Lower case, without characters other than letters, digits, `_` and space, runs of white space as one space.

    White space at the ends goes before punctuation does, so punctuation at an end may leave a space.
    """
    bare = F.regexp_replace(F.lower(F.trim(title)), r"[^\p{L}\p{N}_\s]", "")
    return F.regexp_replace(bare, r"\s+", " ")


def ascii_title(title: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else as single spaces."""
    return F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " "))


def slug(value: Column, most: int) -> Column:
    """ASCII letters and digits joined by `_`, cut to `most` characters without a trailing `_`."""
    joined = F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.regexp_replace(F.substring(joined, 1, most), "_+$", "")


def solid_lines(text: Column) -> Column:
    """The lines, trimmed, without blank ones."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def url_domain(url: Column) -> Column:
    """Host in lower case without user, port and `www.`; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def path_pattern(url: Column) -> Column:
    """The first segment of the path as `/segment/`; empty where there is none."""
    segment = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]+/([^/?#]+)", 1)
    return F.when(segment != "", F.concat(F.lit("/"), segment, F.lit("/"))).otherwise("")


def is_url(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/\s?#]+"), F.lit(False))


def in_scope(url: Column, allowed: Sequence[str], blocked: Sequence[str]) -> Column:
    """Starts with an allowed prefix (none given: all are) and holds no blocked fragment in any letter case."""
    ok = F.lit(not allowed)
    for prefix in allowed:
        ok = ok | url.startswith(prefix)
    for fragment in blocked:
        ok = ok & ~F.contains(F.lower(url), F.lit(fragment.lower()))
    return F.coalesce(ok, F.lit(False))


def language_guess(text: Column, share: float = 0.9) -> Column:
    """`en` where at least `share` of the characters are ASCII, else `non_en`; `unknown` for null and empty texts."""
    ascii_chars = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
    return F.when(F.length(text) > 0, F.when(ascii_chars >= share * F.length(text), "en").otherwise("non_en")).otherwise("unknown")


def word_count(text: Column) -> Column:
    """Runs of letters, digits and `_`."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}_]+"))


def terms_found(text: Column, terms: Sequence[str], lowered: bool = False) -> Column:
    """How many different terms occur in the text, in any letter case and inside words too; `lowered` texts are in lower
    case already."""
    low = text if lowered else F.lower(F.coalesce(text, F.lit("")))
    total = F.lit(0)
    for term in dict.fromkeys(t.lower() for t in terms):
        total = total + F.contains(low, F.lit(term)).cast("int")
    return total


def labels_found(text: Column, labels: dict[str, Sequence[str]]) -> Column:
    """The labels any of whose words occur in the text, in the order given."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(F.lit(False) | _any(low, words), F.lit(label)) for label, words in labels.items()]))


def _any(low: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(low, F.lit(w.lower()))
    return found


def tokens(text: Column) -> Column:
    """Distinct runs of ASCII letters and digits, percentages as one, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9.]+%|[a-z0-9]+)"), F.lit(1)))


def clean_tokens(text: Column, stopwords: Sequence[str] = (), least: int = 2) -> Column:
    """Words in order, without stop words and words under `least` characters."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    stop = F.array(*[F.lit(w) for w in stopwords]) if stopwords else F.array().cast("array<string>")
    return F.filter(words, lambda w: (F.length(w) >= least) & ~F.array_contains(stop, w))


def ngrams(words: Column, low: int = 1, high: int = 3) -> Column:
    """The distinct n-grams of low to high words, joined by a space."""
    def of(n: int) -> Column:
        last = F.size(words) - n
        starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(low, high + 1)])))


def links(text: Column) -> Column:
    """All addresses in a text, without punctuation at their ends."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(https?://[^\s()<>\[\]\"']+)"), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))


def plain_number(value: Column) -> Column:
    """Up to four decimals without zeros at the end."""
    return F.regexp_replace(F.format_string("%.4f", value.cast("double")), r"\.?0+$", "")


def html_title(html: Column) -> Column:
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    heading = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return F.nullif(collapsed(F.regexp_replace(F.coalesce(F.nullif(title, F.lit("")), heading), r"<[^>]+>", " ")), F.lit(""))


def site_name(domain: Column) -> Column:
    """A readable name of a domain: without its last label, `-` and `_` as spaces, words with capitals."""
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(domain, r"\.[^.]+$", ""), r"[-_.]+", " ")))


def safe_name(name: Column) -> Column:
    """A file name without the characters that file systems forbid."""
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def paper_id(url: Column) -> Column:
    """The number of an arXiv abstract's address, without its version; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"arxiv\.org/abs/([0-9]{4}\.[0-9]+)", 1), F.lit(""))


def padded_id(value: Column, width: int = 10) -> Column:
    """A number as text without leading zeros, then padded with zeros to its width."""
    return F.lpad(F.regexp_replace(F.trim(value), "^0+", ""), width, "0")
