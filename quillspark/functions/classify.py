"""Predicates and reasons, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
GOLD_LANGUAGES = ("english", "en_ch_mixed")
PDF_MAGIC = "%PDF"
MIN_CONTENT_CHARS = 200


def usable_abstract(abstract: Column, present: Column) -> Column:
    return F.coalesce(present, F.lit(True)) & F.coalesce(F.regexp_replace(abstract, r"(?U)\s+", "") != "", F.lit(False))


def valid_count(count: Column) -> Column:
    return F.coalesce(count >= 0, F.lit(False))


def in_gold_subset(data_source: Column, layout: Column, language: Column, want_source: str, want_layout: str) -> Column:
    return F.coalesce((data_source == want_source) & (layout == want_layout) & language.isin(*GOLD_LANGUAGES), F.lit(False))


def response_type(content_type: Column, body: Column) -> Column:
    """``pdf`` by type or first bytes, ``html`` by type, else null."""
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    magic = F.coalesce(F.substring(body, 1, 4) == PDF_MAGIC, F.lit(False))
    return F.when((kind == "application/pdf") | magic, "pdf").when(kind.isin("text/html", "application/xhtml+xml"), "html")


def bot_wall(status: Column, url: Column, hosts: tuple[str, ...]) -> Column:
    """The walled host that a refused (403) address belongs to, itself or as a subdomain."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    hit = F.lit(None).cast("string")
    for h in reversed(hosts):
        hit = F.when((host == h) | F.endswith(host, F.lit("." + h)), h).otherwise(hit)
    return F.when(status == 403, hit)


def is_doi_url(url: Column) -> Column:
    """Whether a path segment is a DOI's registrant."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return F.exists(F.split(path, "/"), lambda x: x.rlike(r"^10\.\d{4,}$"))


def search_outcome(status: Column, hits: Column, has_key: Column) -> Column:
    return F.when(~has_key, "missing-key").when(status == 429, "rate-limited").when(status >= 400, "api-error").when(hits == 0, "empty").otherwise("ok")


def html_reason(valid_utf8: Column, suffix: Column, chars: Column) -> Column:
    """Why a saved page cannot be converted; null if it can."""
    return F.when(~F.lower(suffix).isin(".html", ".htm"), "not-html").when(~valid_utf8, "not-utf8").when(chars < MIN_CONTENT_CHARS, "too-thin")
