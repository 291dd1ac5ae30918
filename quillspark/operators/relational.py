"""Dedup, ranking and lookup operators over candidate and log tables.

Each returns an ``OpResult``: the rows kept, and an audit row for each row dropped.
Windows are partitioned by key and ordered by ``ord``; a hot key's window sorts its
rows with spilling and gathers none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.audit import OpResult, audit_rows, union_audits
from quillspark.functions.classify import usable_abstract, valid_count
from quillspark.functions.identifiers import bare_doi, candidate_key, doi_key
from quillspark.functions.text_quality import cosine

TOP = 20
THRESHOLD = 0.65
LANE_CAP = 200


def first_per_key(rows: DataFrame, key: Column, stage: str, ord: str = "ord", name: str = "input") -> OpResult:
    """The first row of each key in input order; rows without a key all stay.

    Firsts are found by aggregation before the join, so a hot key costs no window.
    """
    keyed = rows.withColumn("__key", key)
    firsts = keyed.where("__key IS NOT NULL").groupBy("__key").agg(F.min(F.struct(ord, name)).alias("__first"))
    j = keyed.join(firsts, "__key", "left")
    kept = j.where(F.col("__key").isNull() | (F.col(ord) == F.col("__first")[ord])).select(*rows.columns)
    lost = j.where(F.col(ord) > F.col("__first")[ord])
    return OpResult(kept, audit_rows(lost, stage, "dedup-doi", ord=F.col(ord), url=F.col(name), doi=F.col("__key"), duplicate_of=F.col("__first")[name]))


def dedup_inputs(inputs: DataFrame) -> OpResult:
    """``ord, input``: one input per DOI; inputs without one stay."""
    return first_per_key(inputs, doi_key(F.col("input")), "dedup-inputs")


def with_abstracts(candidates: DataFrame) -> OpResult:
    """Candidates with a usable abstract, then the first of each DOI among them."""
    ok = usable_abstract(F.col("abstract"), F.col("abstract_present"))
    none = audit_rows(candidates.where(~ok), "abstract-filter", "no-abstract", ord=F.col("ord"), url=F.col("url"))
    one = first_per_key(candidates.where(ok), candidate_key(F.col("doi"), F.col("url")), "abstract-filter", name="url")
    return OpResult(one.kept, union_audits(none, one.audit))


def rank_by_similarity(candidates: DataFrame, query: Column, vector: str = "embedding", threshold: float = THRESHOLD) -> OpResult:
    """Candidates at least as similar as the threshold; similarity is rounded to six places first."""
    s = candidates.withColumn("similarity", F.round(cosine(F.col(vector), query), 6))
    low = s.where(F.col("similarity") < threshold)
    return OpResult(s.where(F.col("similarity") >= threshold), audit_rows(low, "abstract-filter", "below-threshold", ord=F.col("ord"), similarity=F.col("similarity")))


def top_cited(candidates: DataFrame, top: int = TOP) -> OpResult:
    """The most cited, ties in input order; rows without a count, and those beyond the top, are audited."""
    ok = valid_count(F.col("cited_by"))
    ranked = candidates.where(ok)
    kept = ranked.orderBy(F.desc("cited_by"), "ord").limit(max(top, 0))
    beyond = ranked.join(kept.select("ord"), "ord", "left_anti")
    return OpResult(
        kept,
        union_audits(
            audit_rows(candidates.where(~ok), "rank-cited", "no-cited-by", ord=F.col("ord"), url=F.col("url")),
            audit_rows(beyond, "rank-cited", "beyond-top", ord=F.col("ord"), url=F.col("url"), cited_by=F.col("cited_by")),
        ),
    )


def last_wins(rows: DataFrame, *keys: str, ord: str = "ord") -> DataFrame:
    """The last row of each key; nulls are keys like others."""
    cols = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), ord).alias("__last"))
    return last.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in cols])


def retry_urls(log: DataFrame) -> DataFrame:
    """``url, ord``: blocked addresses that were never recovered, by first sight."""
    blocked = log.where("stage = 'fetch-one' AND blocked_by <> '' AND url IS NOT NULL").groupBy("url").agg(F.min("ord").alias("ord"))
    saved = log.where("stage = 'browser-fetch' AND result = 'saved'").select("url").distinct()
    return blocked.join(saved, "url", "left_anti")


def last_success(outputs: DataFrame, log: DataFrame) -> DataFrame:
    """Outputs with the latency and finish of the last success logged for their model and page; nulls where none was."""
    done = last_wins(log.select("model", "page", "latency", "finish_reason", "ord"), "model", "page").withColumnRenamed("ord", "log_ord")
    return outputs.join(done, ["model", "page"], "left")


def enrich_abstracts(candidates: DataFrame, works: DataFrame) -> DataFrame:
    """Candidates with missing abstracts filled from works of the same DOI, and ``outcome`` per row.

    ``works`` has ``doi`` in lower case and ``abstract``; of several works of one DOI
    the first by text is taken.
    """
    have = usable_abstract(F.col("abstract"), F.col("abstract_present"))
    doi = F.nullif(F.trim(bare_doi(F.trim("doi"))), F.lit(""))
    w = works.where("doi IS NOT NULL").groupBy("doi").agg(F.min("abstract").alias("__found")).withColumnRenamed("doi", "__doi")
    j = candidates.withColumn("__have", have).withColumn("__key", F.when(~have, F.lower(doi))).join(w, F.col("__key") == F.col("__doi"), "left")
    outcome = (
        F.when(F.col("__have"), "present").when(F.col("__key").isNull(), "no-doi").when(F.col("__doi").isNull(), "doi-not-found")
        .when(F.col("__found").isNull(), "no-abstract-on-record").otherwise("enriched")
    )
    filled = F.when(F.col("__have"), F.col("abstract")).otherwise(F.col("__found"))
    return j.withColumn("outcome", outcome).withColumn("abstract", filled).select(*candidates.columns, "outcome")


def missing_outputs(pages: DataFrame, models: DataFrame, cached: DataFrame) -> DataFrame:
    """``page, model`` pairs that have no output yet; ``models`` is a configuration of a few rows."""
    return pages.select("page").distinct().crossJoin(F.broadcast(models.select("model").distinct())).join(cached.select("page", "model"), ["page", "model"], "left_anti")


def expand_citations(seeds: DataFrame, edges: DataFrame, works: DataFrame, cap: int = LANE_CAP) -> DataFrame:
    """``seed, lane, work, ord``: works the seeds cite, and works citing them by citations, capped per lane; each work once a seed, references first."""
    refs = seeds.join(edges, F.col("seed") == F.col("src")).select("seed", F.lit(0).alias("lane"), F.col("dst").alias("work"), F.col("pos").cast("bigint").alias("by"))
    cites = seeds.join(edges, F.col("seed") == F.col("dst")).join(works.select("work", "cited_by"), F.col("work") == F.col("src"))
    cites = cites.select("seed", F.lit(1).alias("lane"), "work", (-F.coalesce("cited_by", F.lit(0))).alias("by"))
    rank = F.row_number().over(W.partitionBy("seed", "lane").orderBy("by", "work"))
    both = refs.unionByName(cites).withColumn("ord", rank).where(F.col("ord") <= cap)
    return both.groupBy("seed", "work").agg(F.min(F.struct("lane", "ord")).alias("f")).select("seed", "work", F.col("f.lane").alias("lane"), F.col("f.ord").alias("ord"))


def upsert_sidecars(old: DataFrame, new: DataFrame, key: str = "stem") -> DataFrame:
    """One row per key; a new value replaces an old one unless it is null."""
    fields = [c for c in new.columns if c != key]
    o = old.select(key, *[F.col(f).alias(f"__old_{f}") for f in fields])
    return new.join(o, key, "full_outer").select(key, *[F.coalesce(f, f"__old_{f}").alias(f) for f in fields])


def assemble_pages(pages: DataFrame) -> DataFrame:
    """``paper, pages, whole, document``: pages in order under their markers; ``whole`` if none is missing."""
    text = F.concat(F.lit("<!-- page: "), F.col("page_no"), F.lit(" -->\n\n"), F.coalesce("content", F.lit("[page failed]")))
    per = pages.groupBy("paper").agg(F.count("*").alias("pages"), F.min("page_no").alias("lo"), F.max("page_no").alias("hi"), F.array_sort(F.collect_list(F.struct("page_no", text.alias("text")))).alias("p"))
    return per.select("paper", "pages", ((F.col("lo") == 1) & (F.col("hi") == F.col("pages"))).alias("whole"), F.array_join(F.transform("p", lambda x: x["text"]), "\n\n---\n\n").alias("document"))
