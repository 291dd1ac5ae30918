"""Identifiers, URLs and titles as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists.
URL = r"(?i)(?<![A-Za-z0-9+.\-])https?://[^\s<>]+"
DOI = r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"
RESOLVER = r"(?i)^(?:https?://)?doi\.org/"
TITLE_STOPWORDS = "a an and for in of on the to".split()
MIN_TITLE_OVERLAP = 0.6
BACKOFF_CAP = 60.0


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times but computes it once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _count(c: Column, what: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def trim_url(url: Column) -> Column:
    """Without trailing punctuation, and without closing brackets that nothing opens.

    The ends of a run of ``.,;:!?"'`` and ``)`` come off one at a time: a bracket
    only while there are more closing than opening ones in what is left.
    """
    # What the run of punctuation leaves, then how many of its brackets have an opening one.
    head = F.regexp_replace(url, r"""[.,;:!?"')]+$""", "")
    run = F.substring(url, F.length(head) + F.lit(1), F.length(url))
    keep = F.least(F.greatest(_count(head, "(") - _count(head, ")"), F.lit(0)), _count(run, ")"))
    kept = F.when(keep > 0, F.concat(F.array_join(F.slice(F.split(run, r"\)"), F.lit(1), keep), ")"), F.lit(")"))).otherwise(F.lit(""))
    return F.concat(head, kept)


def urls_in(text: Column) -> Column:
    """The distinct web addresses of a text in the order they come."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(text, F.lit(URL), F.lit(0)), trim_url), lambda u: u != ""))


def first_doi(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, DOI, 0), F.lit(""))


def trim_doi(doi: Column) -> Column:
    """Without trailing ``.,;:``, then without one closing round and one square bracket that nothing opens."""
    d = F.regexp_replace(doi, r"[.,;:]+$", "")
    return _let(_let(d, lambda v: _without_lone(v, "(", ")")), lambda v: _without_lone(v, "[", "]"))


def _without_lone(v: Column, opening: str, closing: str) -> Column:
    return F.when(v.endswith(closing) & (_count(v, closing) > _count(v, opening)), F.left(v, F.length(v) - F.lit(1))).otherwise(v)


def doi_key(text: Column) -> Column:
    """The first DOI of a text, trimmed, in lower case; null if there is none."""
    return F.lower(trim_doi(first_doi(text)))


def candidate_key(doi: Column, url: Column) -> Column:
    """The key of the stated DOI, or of the address where none is stated."""
    return F.when(doi.isNotNull() & (doi != ""), doi_key(doi)).otherwise(doi_key(url))


def bare_doi(doi: Column) -> Column:
    return F.regexp_replace(doi, RESOLVER, "")


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def title_from_url(url: Column) -> Column:
    """Words of an address's last path segment; null if it has no letter."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", "")
    # url_decode reads a plus as a blank; here it is kept until it is one by rule.
    name = F.try_url_decode(F.replace(last_segment(path), F.lit("+"), F.lit("%2B")))
    words = F.trim(F.regexp_replace(F.regexp_replace(name, r"^\d+[_-]", ""), r"[_+]+", " "))
    return F.when(words.rlike(r"(?U)\p{L}"), words)


def slug_tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def content_tokens(text: Column) -> Column:
    return F.array_except(slug_tokens(text), F.array(*[F.lit(w) for w in TITLE_STOPWORDS]))


def title_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the content tokens; 0 where either has none."""
    x, y = content_tokens(a), content_tokens(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def name_reflects_title(name: Column, title: Column) -> Column:
    """Whether every token of a non-empty name is one of the title's."""
    n = slug_tokens(name)
    return (F.size(n) > 0) & (F.size(F.array_except(n, slug_tokens(title))) == 0)


def target_name(url: Column, extension: str) -> Column:
    """The file name for an address: its last segment, or ``index``, with the extension."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    name = F.coalesce(F.nullif(last_segment(F.regexp_replace(path, r"/+$", "")), F.lit("")), F.lit("index"))
    return F.when(F.endswith(F.lower(name), F.lit(extension)), name).otherwise(F.concat(name, F.lit(extension)))


def model_slug(model: Column) -> Column:
    return F.replace(model, F.lit("/"), F.lit("_"))


def content_hash(*parts: Column) -> Column:
    """sha256 over the parts, each followed by a zero byte."""
    return F.sha2(F.concat(*[x for p in parts for x in (F.encode(p, "UTF-8"), F.unhex(F.lit("00")))]), 256)


def clickable_doi(doi: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), doi)


def retry_after(header: Column) -> Column:
    """Seconds of a Retry-After header; null if it is no number or below zero."""
    seconds = F.trim(header).try_cast("double")
    return F.when(seconds >= 0, seconds)


def backoff(base: Column, attempt: Column) -> Column:
    return F.least(base * F.pow(F.lit(2.0), attempt), F.lit(BACKOFF_CAP))
