"""Deterministic identities: hashes and ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamstone.functions.text import ascii_title, collapsed, plain_title, slug


def url_hash(url: Column) -> Column:
    """16 hex digits of the address without slashes at its end, in lower case."""
    return F.substring(F.sha2(F.lower(F.regexp_replace(url, "/+$", "")), 256), 1, 16)


def title_hash(title: Column) -> Column:
    return F.substring(F.sha2(plain_title(title), 256), 1, 16)


def content_hash(text: Column) -> Column:
    """16 hex digits of the text in lower case with runs of white space as one space."""
    return F.substring(F.sha2(F.lower(collapsed(text)), 256), 1, 16)


def title_fingerprint(title: Column) -> Column:
    return F.sha1(ascii_title(title))


def content_fingerprint(text: Column) -> Column:
    return F.sha1(F.lower(collapsed(text)))


def event_fingerprint(domain: Column, published: Column, event_type: Column) -> Column:
    """Hash of domain, day and event type; null if any of them is blank."""
    parts = [F.nullif(F.lower(F.trim(c)), F.lit("")) for c in (domain, F.substring(published, 1, 10), event_type)]
    whole = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.when(whole, F.sha1(F.concat_ws("|", *parts)))


def link_id(a: Column, b: Column) -> Column:
    return F.concat(F.lit("link_"), F.substring(F.sha2(F.concat_ws(":", a, b), 256), 1, 16))


def callback_key(record_id: Column) -> Column:
    return F.substring(F.sha1(record_id), 1, 28)


def record_id(source: Column, title: Column, url: Column) -> Column:
    """Slugs of source and title with eight digits of the address's hash."""
    return F.concat_ws("_", slug(source, 30), slug(title, 60), F.substring(F.sha1(url), 1, 8))


def candidate_id(lane: Column, domain: Column, title: Column, url: Column) -> Column:
    """Lane, the domain's first label, up to five words of the title in at most 25 letters, and a hash."""
    root = F.split_part(domain, F.lit("."), F.lit(1))
    words = F.array_join(F.slice(F.split(slug(title, 200), "_"), 1, 5), "_")
    return F.concat_ws("_", lane, root, F.regexp_replace(F.substring(words, 1, 25), "_+$", ""), F.substring(url_hash(url), 1, 8))
