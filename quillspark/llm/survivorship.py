"""One surviving record per identity, each field from the row that holds it best.

Groups are those of ``final_groups``. Text, identifier and link are kept from the
earliest row whose value is sound; a count goes stale, so the latest fetched one
is current. All choices are one aggregation with partial sums, so a hot group
costs no more than its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.identity import doi_parts
from quillspark.llm.linkage import final_groups
from quillspark.llm.truncation import MIN_WORDS, flag_cut

#: A form of a registrant's DOIs is damaged if one this close is so many times as frequent.
FORM_DISTANCE = 2
FORM_RATIO = 4

# A link whose path is that of a PDF file or of a site's PDF view.
_PDF_LINK = r"(?i)^\s*https?://[^\s/?#]+\.[^\s/?#]+/(?:[^\s?#]*\.pdf|(?:[^\s?#]*/)?e?pdf/[^\s?#]*[^\s?#/])/?(?:[?#]\S*)?\s*$"
_BLANK = "[\\s\\u00A0]+"


def pdf_link(url: Column) -> Column:
    """Whether the value is an absolute web link to the PDF itself."""
    return F.coalesce(url.rlike(_PDF_LINK), F.lit(False))


def damaged_forms(dois: DataFrame) -> DataFrame:
    """``registrant, spelling, joined``: forms of DOIs that a far more frequent one of the same registrant explains.

    ``dois`` are ``record_identities``. A form is the letters of the suffix and
    whether digits follow them without a separator. Blocks are counted, not rows,
    so a hot work does not vouch for its own damage.
    """
    forms = dois.where("d_spelling <> ''").select("registrant", F.col("d_spelling").alias("spelling"), "joined", F.col("d_block").alias("block")).distinct()
    forms = forms.groupBy("registrant", "spelling", "joined").agg(F.count("*").alias("n"))
    a, b = forms.alias("a"), forms.alias("b")
    near = (F.levenshtein("a.spelling", "b.spelling") <= FORM_DISTANCE) & (F.col("b.n") >= F.col("a.n") * FORM_RATIO)
    return a.join(b, (F.col("a.registrant") == F.col("b.registrant")) & near).select("a.registrant", "a.spelling", "a.joined").distinct()


def _chosen(candidates: DataFrame) -> DataFrame:
    """One row per group of two or more: per field the chosen ``cand_id`` and value."""
    have = candidates.where(F.col("cand_id").isNotNull()).select("cand_id", "source", "abstract", "doi", "pdf_url", "cited_by", "fetched_at")
    groups, identities = final_groups(candidates)
    # Groups of one row have no survivor to choose: they go before anything is looked at.
    groups = groups.join(groups.groupBy("first_cand_id").agg(F.count("*").alias("members")).where("members >= 2"), "first_cand_id")
    bad = damaged_forms(identities).withColumn("bad", F.lit(True))
    known = identities.join(bad, (F.col("d_spelling") == bad["spelling"]) & (identities["registrant"] == bad["registrant"]) & (identities["joined"] == bad["joined"]), "left")
    known = known.select("cand_id", (F.col("d_block").isNotNull() & ~F.col("damaged_form") & F.col("bad").isNull()).alias("__doi_ok"))
    rows = flag_cut(have)
    body = F.trim(F.regexp_replace("abstract", _BLANK, " "))
    words = F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))) + 1
    sound = {
        "abstract": F.col("abstract").isNotNull() & (words >= MIN_WORDS) & ~F.col("is_cut"),
        "doi": F.col("doi").isNotNull(),
        "pdf_url": pdf_link(F.col("pdf_url")),
        "cited_by": F.coalesce(F.col("cited_by") >= 0, F.lit(False)),
    }
    rows = rows.select("cand_id", "fetched_at", *sound, *[c.alias(f"{f}_ok") for f, c in sound.items()])
    rows = groups.join(known, "cand_id").join(rows, "cand_id").withColumn("doi_ok", F.coalesce("__doi_ok", F.lit(False)))

    def first(f: str) -> Column:
        return F.when(F.col(f"{f}_ok"), F.struct("cand_id"))

    # The latest count, then the smallest row: a null fetched_at comes last.
    latest = F.when(F.col("cited_by_ok"), F.struct(F.col("fetched_at"), (-F.col("cand_id")).alias("k")))
    picks = []
    for f in ("abstract", "doi", "pdf_url"):
        picks += [F.min(first(f))["cand_id"].alias(f"{f}_from"), F.min_by(f, first(f)).alias(f)]
    picks += [(-F.max(latest)["k"]).alias("cited_by_from"), F.max_by("cited_by", latest).alias("cited_by")]
    return rows.groupBy("first_cand_id").agg(F.count("*").alias("members"), *picks).where("members >= 2")


FIELDS = ("abstract", "doi", "pdf_url", "cited_by")


def best_rows(candidates: DataFrame) -> DataFrame:
    """``first_cand_id, field, cand_id``: the row that each group's field is taken from; none where no row has a sound value."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_from").alias("cand_id")) for f in FIELDS])
    return _chosen(candidates).select("first_cand_id", F.inline(each)).where("cand_id IS NOT NULL")


def surviving_records(candidates: DataFrame) -> DataFrame:
    """``first_cand_id, members`` and each field with the row it is from: one record per group of two or more."""
    return _chosen(candidates).select("first_cand_id", "members", *[c for f in FIELDS for c in (f, f"{f}_from")])
