"""Reference-free and reference-based quality of texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, abbreviations and layout labels.
RULE = r"^(?:(?:-\s*){3,}|(?:\*\s*){3,}|(?:_\s*){3,})$"
PANEL_LABEL = r"^[(\[]?[A-Za-z][)\].]?$"
SENTENCE_END = r"(?U)(?<=[.?!])\s+"
ABBREVIATIONS = "fig eq no vol pp al e.g i.e cf vs dr mr ms prof ref sec ch etc approx".split()
HYPHEN_ARTIFACT = r"(?U)(?<=\w)-\s+(?=\w)"
CITATION_GROUP = r"\[\d+(?:\s*,\s*\d+)*\]"
CJK_OR_IPA = r"[㐀-䶿一-鿿ɐ-ʯ]"
LINE_BREAK = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85  ]"
FENCE = r"(?s)\A```(?:markdown)?[ \t]*\n(.*?)\n?```\s*\z"
BOX = r"(?s)<\|det\|>.*?<\|/det\|>"
REF_MARK = r"<\|/?ref\|>"
REF_LABEL = r"<\|ref\|>[^<]*<\|/ref\|>"
LAYOUT_LABELS = "text title sub_title table figure_title image image_caption".split()

#: Stands between sentences while they are joined.
_END = "\uE000"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def substantive_lines(text: Column) -> Column:
    """Trimmed lines that are neither blank nor rules nor labels of figure panels."""
    lines = F.transform(F.split(text, LINE_BREAK), strip)
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(RULE) & ~x.rlike(PANEL_LABEL))


def sentences(text: Column) -> Column:
    """Sentences; an abbreviation's point ends none."""
    parts = F.filter(F.transform(F.split(strip(text), SENTENCE_END), strip), lambda p: p != "")
    last = lambda p: F.lower(F.regexp_replace(F.element_at(F.split(p, r"(?U)\s+"), -1), r"[.!?]+$", ""))
    marked = F.transform(parts, lambda p: F.concat(p, F.when(last(p).isin(ABBREVIATIONS), " ").otherwise(_END)))
    return F.filter(F.transform(F.split(F.array_join(marked, ""), _END), strip), lambda p: p != "")


def dup_units(text: Column) -> Column:
    """Lines, or sentences where there is no more than one line."""
    lines = substantive_lines(text)
    return F.when(F.size(lines) > 1, lines).otherwise(sentences(F.array_join(lines, "\n")))


def dup_pct(text: Column) -> Column:
    """Per cent of the units that repeat an earlier one, to one place."""
    u = dup_units(text)
    return F.when(F.size(u) > 0, F.round(100.0 * (F.size(u) - F.size(F.array_distinct(u))) / F.size(u), 1)).otherwise(0.0)


def hyphen_artifacts(text: Column) -> Column:
    return F.regexp_count(text, F.lit(HYPHEN_ARTIFACT))


def citation_groups(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CITATION_GROUP))


def cjk_present(text: Column) -> Column:
    return text.rlike(CJK_OR_IPA)


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def content_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"(?U)\s", ""))


def strip_fence(text: Column) -> Column:
    """The inside of a fence around the whole text, else the text, with plain line ends."""
    t = F.regexp_replace(text, "\r\n", "\n")
    return F.when(t.rlike(FENCE), F.regexp_extract(t, FENCE, 1)).otherwise(t)


def decode_grounding(text: Column) -> Column:
    """Without boxes and reference marks; what was referred to stays."""
    return strip(F.regexp_replace(F.regexp_replace(text, BOX, ""), REF_MARK, ""))


def decode_layout(text: Column) -> Column:
    """Without boxes, whole references and lines that are only a layout label."""
    t = F.regexp_replace(text, "\r\n", "\n")
    for pattern in (BOX, REF_LABEL, REF_MARK):
        t = F.regexp_replace(t, pattern, "")
    t = F.array_join(F.filter(F.split(t, "\n"), lambda x: ~strip(x).isin(LAYOUT_LABELS)), "\n")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length, 0 where both are empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 0.0).otherwise(F.levenshtein(a, b) / longest)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 for other lengths, a zero vector or a result that is no number."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    value = dot(a, b) / F.nullif(norm, F.lit(0.0))
    ok = (F.size(a) == F.size(b)) & value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(ok, value).otherwise(0.0)
