"""Identities of candidate records, as column expressions.

An identity is a *node* ``<block>|<spelling>``. The block of a DOI is its
registrant and all digits of its suffix in order, which no way of writing or
damage of letters and separators changes; the spelling is the letters of the
suffix. Two DOIs are the same if their blocks are equal and their spellings are
close (``MAX_SPELLING``). A source id's block is the id itself with its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levenshtein distance between two spellings of one DOI's letters.
MAX_SPELLING = 3
#: Suffixes with fewer digits than this are compared as they are written.
MIN_DIGITS = 6

# Words written where an identifier is missing.
PLACEHOLDERS = ("", "unknown", "none", "null", "n/a", "na", "nan", "-", "0", "tbd", "pending", "doi pending", "not available", "missing", "10.")

_INVISIBLE = "[\\s\\u00A0\\u200B-\\u200F\\u2028\\u2029\\u2060\\uFEFF]+"
_HYPHENS = "[\\u2010-\\u2015\\u2212\\uFE63\\uFF0D]"
_TAIL_PATH = "(/(fulltext|full|abstract|abs|pdf|epdf|html|xml|download|meta))+$"


def _tidy(c: Column) -> Column:
    s = F.regexp_replace(F.lower(c), _INVISIBLE, "")
    s = F.regexp_replace(s, _HYPHENS, "-")
    s = F.regexp_replace(F.regexp_replace(s, "%2f", "/"), "%3a", ":")
    s = F.regexp_replace(F.regexp_replace(s, "%28", "("), "%29", ")")
    return s


def doi_parts(doi: Column) -> Column:
    """``struct<block, spelling, registrant, damaged_form>``; null where no DOI is written.

    ``damaged_form`` marks letters in the place of digits (``1O.`` or ``44O1``).
    """
    s = _tidy(doi)
    registrant = F.regexp_extract(s, "(1[0o]\\.[0-9o]{4,9})/", 1)
    suffix = F.regexp_extract(s, "1[0o]\\.[0-9o]{4,9}/(.*)$", 1)
    suffix = F.regexp_replace(suffix, "[?#].*$", "")
    suffix = F.regexp_replace(suffix, "[.,;:)\\]}>'\"/]+$", "")
    suffix = F.regexp_replace(suffix, _TAIL_PATH, "")
    suffix = F.regexp_replace(suffix, "[.,;:)\\]}>'\"/]+$", "")
    reg = F.regexp_replace(registrant, "o", "0")
    # Letters first, then digits with separators: the usual serial suffix.
    serial = suffix.rlike("^[a-z]*[-._/]?[0-9][0-9o._/-]*$") | suffix.rlike("^[a-z]+[-._/]o[0-9o._/-]*$")
    letters = F.regexp_extract(suffix, "^([a-z]*)", 1)
    rest = F.substring(suffix, F.length(letters) + F.lit(1), F.length(suffix))
    digits = F.regexp_replace(F.regexp_replace(rest, "o", "0"), "[^0-9]", "")
    by_digits = serial & (F.length(digits) >= MIN_DIGITS)
    usable = (registrant != "") & (suffix != "") & suffix.rlike("[0-9]")
    joined = by_digits & rest.rlike("^[0-9]") & (letters != "")
    return F.when(
        usable,
        F.struct(
            F.concat(F.lit("d:"), reg, F.lit("/"), F.when(by_digits, digits).otherwise(suffix)).alias("block"),
            F.when(by_digits, letters).otherwise("").alias("spelling"),
            reg.alias("registrant"),
            (registrant.contains("o") | (by_digits & rest.contains("o"))).alias("damaged_form"),
            joined.alias("joined"),
        ),
    )


def source_id_block(source: Column, source_id: Column) -> Column:
    """The id with its source, one writing for all; null where there is none."""
    raw = F.regexp_replace(source_id, _INVISIBLE, "")
    last = F.regexp_extract(F.regexp_replace(raw, "[?#].*$", ""), "([^/]+)/*$", 1)
    src = F.lower(F.trim(source))
    arxiv = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(raw, "(?:[aA][bB][sS]/|[pP][dD][fF]/|^[aA][rR][xX][iI][vV]:|^)([^:]+)$", 1)), "\\.pdf$", ""), "v[0-9]+$", "")
    ident = (
        F.when(src == "arxiv", arxiv)
        .when(src == "s2", F.lower(last))
        .when(src == "openalex", F.upper(last))
        .otherwise(F.when(raw.rlike("^https?://"), last).otherwise(raw))
    )
    return F.when(source.isNotNull() & ident.isNotNull() & ~F.lower(ident).isin(*PLACEHOLDERS), F.concat(F.lit("s:"), src, F.lit(":"), ident))


def record_identities(records: DataFrame) -> DataFrame:
    """``cand_id, d_block, d_spelling, s_block``: each record's DOI and source id; either may be null; and the DOI's form."""
    d = doi_parts(F.col("doi"))
    rows = records.where(F.col("cand_id").isNotNull()).select(
        F.col("cand_id").cast("bigint").alias("cand_id"), d.alias("d"), source_id_block(F.col("source"), F.col("source_id")).alias("s_block")
    )
    return rows.select("cand_id", F.col("d.block").alias("d_block"), F.col("d.spelling").alias("d_spelling"), "s_block", "d.registrant", "d.damaged_form", "d.joined")


def node_rows(identities: DataFrame, *keep: str) -> DataFrame:
    """``cand_id, node, block, spelling`` and the columns to ``keep``: up to two rows per record."""
    both = F.array_compact(
        F.array(
            F.when(F.col("d_block").isNotNull(), F.struct(F.col("d_block").alias("block"), F.col("d_spelling").alias("spelling"))),
            F.when(F.col("s_block").isNotNull(), F.struct(F.col("s_block").alias("block"), F.lit("").alias("spelling"))),
        )
    )
    return identities.select("cand_id", *keep, F.inline(both)).withColumn("node", F.concat_ws("|", "block", "spelling"))
