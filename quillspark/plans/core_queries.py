"""Queries of the relational and text operators over the test tables, each with its SQL.

Inputs are derived from whole tables: candidates are the candidates table, an audit
log comes from events, pages and scores from ocr_pages, citations from documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import classify as K
from quillspark.functions import identifiers as I
from quillspark.functions import text_quality as T
from quillspark.operators import relational as R
from quillspark.operators import scorecard as S
from quillspark.plans.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidates").withColumn("ord", F.col("cand_id"))


# -- SQL pieces of the oracles ------------------------------------------------
_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


def _first_doi(x: str) -> str:
    return rf"nullif(regexp_extract({x}, '(?i)10\.\d{{4,9}}/[-._;()/:A-Z0-9]+'), '')"


def _trim_doi(x: str) -> str:
    out = rf"regexp_replace({x}, '[.,;:]+$', '')"
    for o, c in ("()", "[]"):
        out = f"(SELECT CASE WHEN ends_with(v, '{c}') AND length(replace(v, '{c}', '')) < length(replace(v, '{o}', '')) THEN left(v, length(v) - 1) ELSE v END FROM (SELECT {out} AS v))"
    return out


def _key(x: str) -> str:
    return f"lower({_trim_doi(_first_doi(x))})"


_CAND_KEY = f"CASE WHEN doi IS NOT NULL AND doi <> '' THEN {_key('doi')} ELSE {_key('url')} END"
_USABLE = f"(coalesce(abstract_present, true) AND coalesce(regexp_replace(abstract, '{_SPACE}+', '', 'g') <> '', false))"
_TOKENS = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"
_STOPS = "['a','an','and','for','in','of','on','the','to']"


# -- identifiers --------------------------------------------------------------
@query(f"SELECT cand_id, {_CAND_KEY} AS doi_key FROM candidates")
def f3_f4_doi_keys(spark, d):
    return _candidates(spark, d).select("cand_id", I.candidate_key(F.col("doi"), F.col("url")).alias("doi_key"))


@query(r"""SELECT cand_id, regexp_replace(doi, '(?i)^(https?://)?doi\.org/', '') AS bare_doi, list_last(string_split(url, '/')) AS segment,
  replace(source || '/' || coalesce(source_id, ''), '/', '_') AS slug, 'https://doi.org/' || doi AS clickable,
  sha256(source || chr(0) || 'document' || chr(0) || coalesce(abstract, '') || chr(0)) AS hash FROM candidates""")
def f5_f6_f18_f19_f24_names(spark, d):
    c = _candidates(spark, d)
    return c.select(
        "cand_id", I.bare_doi(F.col("doi")).alias("bare_doi"), I.last_segment(F.col("url")).alias("segment"),
        I.model_slug(F.concat("source", F.lit("/"), F.coalesce("source_id", F.lit("")))).alias("slug"), I.clickable_doi(F.col("doi")).alias("clickable"),
        I.content_hash(F.col("source"), F.lit("document"), F.coalesce("abstract", F.lit(""))).alias("hash"),
    )


@query(r"""WITH t AS (SELECT cand_id, concat_ws(' ', title, url, '(' || pdf_url || ').', doi) AS text FROM candidates),
u AS (SELECT cand_id, unnest(list_transform(regexp_extract_all(text, '(?i)(?:^|[^A-Za-z0-9+.\-])(https?://[^\s<>]+)', 1), lambda x: x)) AS raw FROM t),
v AS (SELECT cand_id, regexp_replace(raw, '[.,;:!?"'')]+$', '') AS head, raw FROM u),
w AS (SELECT cand_id, head, regexp_extract_all(substr(raw, length(head) + 1), '[^)]*\)') AS runs,
  greatest(length(replace(head, ')', '')) - length(replace(head, '(', '')), 0) AS free FROM v)
SELECT DISTINCT cand_id, head || array_to_string(runs[1:free], '') AS url FROM w WHERE head || array_to_string(runs[1:free], '') <> ''""")
def f1_f2_dd7_urls(spark, d):
    text = F.concat_ws(" ", "title", "url", F.concat(F.lit("("), "pdf_url", F.lit(").")), "doi")
    return _candidates(spark, d).select("cand_id", F.explode(I.urls_in(text)).alias("url"))


@query(f"""WITH p AS (SELECT c.cand_id, d.deposit_id, {_TOKENS.format('c.title')} AS x0, {_TOKENS.format('d.title')} AS y0 FROM candidates c JOIN deposits d ON {_key('c.doi')} = {_key('d.doi')}),
q AS (SELECT cand_id, deposit_id, list_filter(x0, lambda t: NOT list_contains({_STOPS}, t)) AS x, list_filter(y0, lambda t: NOT list_contains({_STOPS}, t)) AS y FROM p)
SELECT cand_id, deposit_id, round(CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y))::double / len(list_distinct(list_concat(x, y))) ELSE 0.0 END, 6) AS overlap,
  CASE WHEN len(x) > 0 AND len(y) > 0 THEN len(list_intersect(x, y))::double / len(list_distinct(list_concat(x, y))) ELSE 0.0 END >= 0.6 AS confident FROM q""")
def f12_f13_f14_title_overlap(spark, d):
    """Titles of records that state one DOI, and whether the match is confident."""
    c = _candidates(spark, d).select("cand_id", "title", I.doi_key(F.col("doi")).alias("k"))
    dep = table(spark, d, "deposits").select("deposit_id", F.col("title").alias("other"), I.doi_key(F.col("doi")).alias("k"))
    o = I.title_overlap(F.coalesce("title", F.lit("")), F.coalesce("other", F.lit("")))
    return c.join(dep, "k").select("cand_id", "deposit_id", F.round(o, 6).alias("overlap"), (o >= I.MIN_TITLE_OVERLAP).alias("confident"))


@query(rf"""WITH u AS (SELECT cand_id, title, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS p, url FROM candidates WHERE NOT contains(url, '%')),
s AS (SELECT cand_id, title, url, list_last(string_split(p, '/')) AS name FROM u),
t AS (SELECT cand_id, title, name, trim(regexp_replace(regexp_replace(name, '^\d+[_-]', ''), '[_+]+', ' ', 'g')) AS words FROM s)
SELECT cand_id, CASE WHEN regexp_matches(words, '\p{{L}}') THEN words END AS slug_title,
  len({_TOKENS.format('name')}) > 0 AND len(list_filter({_TOKENS.format('name')}, lambda x: NOT list_contains({_TOKENS.format("coalesce(title, '')")}, x))) = 0 AS reflects FROM t""")
def f11_f15_f16_slugs(spark, d):
    c = _candidates(spark, d).where("NOT contains(url, '%')")
    name = I.last_segment(F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"/+$", ""))
    return c.select("cand_id", I.title_from_url(F.col("url")).alias("slug_title"), I.name_reflects_title(name, F.coalesce("title", F.lit(""))).alias("reflects"))


@query(r"""WITH u AS (SELECT cand_id, regexp_replace(regexp_replace(regexp_replace(pdf_url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*', ''), '/+$', '') AS p FROM candidates),
n AS (SELECT cand_id, coalesce(nullif(list_last(string_split(p, '/')), ''), CASE WHEN p IS NULL THEN NULL ELSE 'index' END) AS name FROM u)
SELECT cand_id, CASE WHEN ends_with(lower(name), '.pdf') THEN name ELSE name || '.pdf' END AS file FROM n WHERE name IS NOT NULL""")
def f17_target_names(spark, d):
    return _candidates(spark, d).where("pdf_url IS NOT NULL").select("cand_id", I.target_name(F.col("pdf_url"), ".pdf").alias("file"))


@query("""SELECT event_id, CASE WHEN try_cast(event_type AS double) >= 0 THEN try_cast(event_type AS double) END AS asked, CASE WHEN value - 50 >= 0 THEN value - 50 END AS wait,
  least(1.0 * power(2.0, event_id % 9), 60.0) AS delay FROM events""")
def f25_retries(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", I.retry_after(F.col("event_type")).alias("asked"), I.retry_after((F.col("value") - 50).cast("string")).alias("wait"), I.backoff(F.lit(1.0), F.col("event_id") % 9).alias("delay"))


# -- filters and dedup --------------------------------------------------------
@query(f"SELECT cand_id, {_USABLE} AS usable, coalesce(cited_by >= 0, false) AS counted FROM candidates")
def fl1_fl4_predicates(spark, d):
    return _candidates(spark, d).select("cand_id", K.usable_abstract(F.col("abstract"), F.col("abstract_present")).alias("usable"), K.valid_count(F.col("cited_by")).alias("counted"))


_DEDUP = """WITH k AS ({rows}), f AS (SELECT key, min(ord) AS first FROM k WHERE key IS NOT NULL GROUP BY key)
SELECT ord, CASE WHEN k.key IS NULL OR ord = first THEN 'kept' ELSE 'dedup-doi' END AS outcome, CASE WHEN ord > first THEN first END AS duplicate_of FROM k LEFT JOIN f ON k.key = f.key"""


def _outcomes(result, first: bool = True) -> DataFrame:
    kept = result.kept.select("ord", F.lit("kept").alias("outcome"), F.lit(None).cast("bigint").alias("duplicate_of"))
    lost = result.audit.select("ord", F.col("reason").alias("outcome"), F.col("attrs")["duplicate_of"].cast("bigint").alias("duplicate_of"))
    return kept.unionByName(lost)


@query(_DEDUP.format(rows=f"SELECT cand_id AS ord, {_key('coalesce(doi, url)')} AS key FROM candidates"))
def dd1_dedup_inputs(spark, d):
    c = _candidates(spark, d).select("ord", F.coalesce("doi", "url").alias("text"), F.col("ord").alias("input"))
    return _outcomes(R.first_per_key(c, I.doi_key(F.col("text")), "dedup-inputs"))


@query(f"""WITH a AS (SELECT cand_id AS ord, {_CAND_KEY} AS key, {_USABLE} AS ok FROM candidates), f AS (SELECT key, min(ord) AS first FROM a WHERE ok AND key IS NOT NULL GROUP BY key)
SELECT ord, CASE WHEN NOT ok THEN 'no-abstract' WHEN a.key IS NULL OR ord = first THEN 'kept' ELSE 'dedup-doi' END AS outcome FROM a LEFT JOIN f ON a.key = f.key""")
def fl2_dd2_with_abstracts(spark, d):
    return _outcomes(R.with_abstracts(_candidates(spark, d))).select("ord", "outcome")


@query("""WITH s AS (SELECT cand_id AS ord, nullif(source || ':' || source_id, '') AS key FROM candidates), f AS (SELECT key, min(ord) AS first FROM s WHERE key IS NOT NULL GROUP BY key)
SELECT ord FROM s LEFT JOIN f ON s.key = f.key WHERE s.key IS NULL OR ord = first""")
def dd5_by_source_id(spark, d):
    c = _candidates(spark, d).withColumn("input", F.col("ord"))
    return R.first_per_key(c, F.concat("source", F.lit(":"), "source_id"), "snowball").kept.select("ord")


@query(f"""SELECT cand_id, {_key('doi')} AS doi_identity, CASE WHEN source_id <> '' THEN source || ':' || source_id END AS source_identity FROM candidates""")
def dd4_identities(spark, d):
    return _candidates(spark, d).select("cand_id", I.doi_key(F.col("doi")).alias("doi_identity"), F.when(F.col("source_id") != "", F.concat("source", F.lit(":"), "source_id")).alias("source_identity"))


_LOG_SCORES = "SELECT model, CASE WHEN page_id % 11 = 0 THEN NULL ELSE host END AS page, page_id AS ord, latency, finish_reason FROM ocr_pages"


@query(f"SELECT model, page, arg_max(latency, ord) AS latency, max(ord) AS ord FROM ({_LOG_SCORES}) GROUP BY model, page")
def dd6_last_wins(spark, d):
    p = table(spark, d, "ocr_pages").select("model", F.when(F.col("page_id") % 11 != 0, F.col("host")).alias("page"), F.col("page_id").alias("ord"), "latency")
    return R.last_wins(p.withColumn("last", F.col("ord")), "model", "page").select("model", "page", "latency", F.col("last").alias("ord"))


# -- joins --------------------------------------------------------------------
@query("""WITH l AS (SELECT event_id AS ord, CASE event_type WHEN 'error' THEN 'fetch-one' WHEN 'purchase' THEN 'browser-fetch' ELSE 'resolve-oa' END AS stage, 'https://host.example/p/' || (event_id % 1500) AS url,
  CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'wall' END AS blocked_by, CASE WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 'saved' END AS result FROM events)
SELECT url, min(ord) AS ord FROM l WHERE stage = 'fetch-one' AND blocked_by <> '' AND url NOT IN (SELECT url FROM l WHERE stage = 'browser-fetch' AND result = 'saved') GROUP BY url""")
def j1_m6_retry_urls(spark, d):
    e = table(spark, d, "events")
    kind = F.col("event_type")
    log = e.select(
        F.col("event_id").alias("ord"), F.when(kind == "error", "fetch-one").when(kind == "purchase", "browser-fetch").otherwise("resolve-oa").alias("stage"),
        F.concat(F.lit("https://host.example/p/"), F.col("event_id") % 1500).alias("url"),
        F.when((kind == "error") & (F.col("user_id") % 3 == 0), "wall").alias("blocked_by"), F.when((kind == "purchase") & (F.col("user_id") % 2 == 0), "saved").alias("result"),
    )
    return R.retry_urls(log).select("url", "ord")


@query(f"""WITH done AS (SELECT model, page, arg_max(struct_pack(l := latency, f := finish_reason), ord) AS r FROM ({_LOG_SCORES}) GROUP BY model, page)
SELECT p.page_id, d.r.l AS latency, d.r.f AS finish_reason FROM ocr_pages p LEFT JOIN done d ON p.model = d.model AND p.host = d.page""")
def j2_last_success(spark, d):
    p = table(spark, d, "ocr_pages")
    log = p.select("model", F.when(F.col("page_id") % 11 != 0, F.col("host")).alias("page"), F.col("page_id").alias("ord"), "latency", "finish_reason")
    out = R.last_success(p.select("page_id", "model", F.col("host").alias("page")), log)
    return out.select("page_id", "latency", "finish_reason")


_WORKS = r"SELECT lower(trim(regexp_replace(trim(doi), '(?i)^(https?://)?doi\.org/', ''))) AS doi, min(abstract) AS found FROM candidates WHERE source = 'openalex' AND doi IS NOT NULL GROUP BY 1"


@query(rf"""WITH w AS ({_WORKS}), c AS (SELECT cand_id, abstract, {_USABLE} AS have, nullif(lower(trim(regexp_replace(trim(doi), '(?i)^(https?://)?doi\.org/', ''))), '') AS key FROM candidates)
SELECT cand_id, CASE WHEN have THEN 'present' WHEN key IS NULL THEN 'no-doi' WHEN w.doi IS NULL THEN 'doi-not-found' WHEN found IS NULL THEN 'no-abstract-on-record' ELSE 'enriched' END AS outcome,
  length(CASE WHEN have THEN abstract ELSE found END) AS chars FROM c LEFT JOIN w ON NOT have AND c.key = w.doi""")
def j4_h6_enrich_abstracts(spark, d):
    c = _candidates(spark, d)
    works = c.where("source = 'openalex'").select(F.lower(F.trim(I.bare_doi(F.trim("doi")))).alias("doi"), "abstract")
    return R.enrich_abstracts(c, works).select("cand_id", "outcome", F.length("abstract").alias("chars"))


@query("""SELECT p.page, m.model FROM (SELECT DISTINCT page FROM ocr_pages) p CROSS JOIN (SELECT DISTINCT model FROM ocr_pages) m
WHERE NOT EXISTS (SELECT 1 FROM ocr_pages o WHERE o.page = p.page AND o.model = m.model)""")
def j5_j6_missing_outputs(spark, d):
    p = table(spark, d, "ocr_pages")
    return R.missing_outputs(p, p, p)


@query("""WITH n AS (SELECT count(*) AS n FROM documents), e AS (SELECT doc_id AS src, (doc_id * 7 + 13) % n AS dst, 0 AS pos FROM documents, n UNION ALL SELECT doc_id, (doc_id * 3 + 5) % 40, 1 FROM documents),
seeds AS (SELECT doc_id AS seed FROM documents WHERE source = 'lab-wiki'),
refs AS (SELECT seed, 0 AS lane, dst AS work, pos AS "by" FROM seeds JOIN e ON seed = src),
cites AS (SELECT seed, 1 AS lane, src AS work, -coalesce(n_chars, 0) AS "by" FROM seeds JOIN e ON seed = dst JOIN documents ON doc_id = src),
r AS (SELECT *, row_number() OVER (PARTITION BY seed, lane ORDER BY "by", work) AS ord FROM (SELECT * FROM refs UNION ALL SELECT * FROM cites))
SELECT seed, work, min(lane) AS lane, arg_min(ord, lane * 1000 + ord)::int AS ord FROM r WHERE ord <= 200 GROUP BY seed, work""")
def j7_tk4_h5_snowball(spark, d):
    docs = table(spark, d, "documents")
    n = docs.select(F.count("*").alias("n"))
    one = docs.crossJoin(F.broadcast(n)).select(F.col("doc_id").alias("src"), ((F.col("doc_id") * 7 + 13) % F.col("n")).alias("dst"), F.lit(0).alias("pos"))
    two = docs.select(F.col("doc_id").alias("src"), ((F.col("doc_id") * 3 + 5) % 40).alias("dst"), F.lit(1).alias("pos"))
    seeds = docs.where("source = 'lab-wiki'").select(F.col("doc_id").alias("seed"))
    return R.expand_citations(seeds, one.unionByName(two), docs.select(F.col("doc_id").alias("work"), F.col("n_chars").alias("cited_by")))


@query("""WITH o AS (SELECT source AS stem, min(doi) AS doi, min(venue) AS venue FROM candidates WHERE batch_id = 1 GROUP BY source),
n AS (SELECT source AS stem, min(doi) AS doi, min(CASE WHEN batch_id % 2 = 0 THEN venue END) AS venue FROM candidates WHERE batch_id > 20 GROUP BY source)
SELECT coalesce(n.stem, o.stem) AS stem, coalesce(n.doi, o.doi) AS doi, coalesce(n.venue, o.venue) AS venue FROM n FULL JOIN o ON n.stem = o.stem""")
def sk4_j8_sidecars(spark, d):
    c = _candidates(spark, d).withColumn("stem", F.col("source"))
    old = c.where("batch_id = 1").groupBy("stem").agg(F.min("doi").alias("doi"), F.min("venue").alias("venue"))
    new = c.where("batch_id > 20").groupBy("stem").agg(F.min("doi").alias("doi"), F.min(F.when(F.col("batch_id") % 2 == 0, F.col("venue"))).alias("venue"))
    return R.upsert_sidecars(old, new)


@query(r"""WITH p AS (SELECT regexp_extract(page, '/([^/]+)/', 1) AS paper, regexp_extract(page, 'p_(\d+)', 1)::int AS page_no, content FROM ocr_pages)
SELECT paper, count(*) AS pages, min(page_no) = 1 AND max(page_no) = count(*) AS whole,
  string_agg('<!-- page: ' || page_no || ' -->' || chr(10) || chr(10) || coalesce(content, '[page failed]'), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page_no) AS document FROM p GROUP BY paper""")
def m3_documents(spark, d):
    p = table(spark, d, "ocr_pages")
    return R.assemble_pages(p.select(F.regexp_extract("page", "/([^/]+)/", 1).alias("paper"), F.regexp_extract("page", r"p_(\d+)", 1).cast("int").alias("page_no"), "content"))


# -- ranking ------------------------------------------------------------------
@query("SELECT cand_id, cited_by FROM candidates WHERE cited_by >= 0 ORDER BY cited_by DESC, cand_id LIMIT 20")
def tk1_top_cited(spark, d):
    return R.top_cited(_candidates(spark, d)).kept.select("cand_id", "cited_by")


@query("""WITH t AS (SELECT cand_id FROM candidates WHERE cited_by >= 0 ORDER BY cited_by DESC, cand_id LIMIT 20)
SELECT CASE WHEN cited_by >= 0 THEN 'beyond-top' ELSE 'no-cited-by' END AS reason, count(*) AS n FROM candidates WHERE cand_id NOT IN (SELECT cand_id FROM t) GROUP BY 1""")
def tk1_ag9_audit(spark, d):
    return R.top_cited(_candidates(spark, d)).audit.groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, round(list_cosine_similarity(embedding::double[], v::double[]), 6) AS similarity FROM embeddings, q WHERE round(list_cosine_similarity(embedding::double[], v::double[]), 6) >= 0.15""")
def t14_tk2_similar(spark, d):
    e = table(spark, d, "embeddings").withColumn("ord", F.col("vec_id"))
    q = e.groupBy().agg(F.min_by("embedding", "vec_id").alias("v"))
    return R.rank_by_similarity(e.crossJoin(F.broadcast(q)), F.col("v"), threshold=0.15).kept.select("vec_id", "similarity")


# -- text quality -------------------------------------------------------------
_LINES = (
    r"list_filter(list_transform(string_split_regex(text, '\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]'), lambda x: "
    + _strip("x")
    + r"), lambda x: x <> '' AND NOT regexp_matches(x, '^((-\s*){3,}|(\*\s*){3,}|(_\s*){3,})$') AND NOT regexp_matches(x, '^[(\[]?[A-Za-z][)\].]?$'))"
)
_ABBR = ", ".join(f"'{a}'" for a in T.ABBREVIATIONS)
_DUP = rf"""WITH src AS ($ROWS), l AS (SELECT id, {_LINES} AS lines FROM src WHERE text IS NOT NULL),
p AS (SELECT id, lines, list_filter(list_transform(string_split(regexp_replace({_strip("array_to_string(lines, chr(10))")}, '([.?!]){_SPACE}+', '\1' || chr(2), 'g'), chr(2)), lambda x: {_strip("x")}), lambda x: x <> '') AS parts FROM l),
m AS (SELECT id, CASE WHEN len(lines) > 1 THEN lines ELSE list_filter(list_transform(string_split(array_to_string(list_transform(parts, lambda y: y || CASE WHEN lower(regexp_replace(list_last(string_split_regex(y, '{_SPACE}+')), '[.!?]+$', '')) IN ({_ABBR}) THEN ' ' ELSE chr(2) END), ''), chr(2)), lambda x: {_strip("x")}), lambda x: x <> '') END AS units FROM p)
SELECT id, len(units) AS units, CASE WHEN len(units) > 0 THEN round(100.0 * (len(units) - len(list_distinct(units))) / len(units), 1) ELSE 0.0 END AS dup_pct FROM m"""


def _dup(rows: DataFrame) -> DataFrame:
    t = F.col("text")
    return rows.where("text IS NOT NULL").select("id", F.size(T.dup_units(t)).alias("units"), T.dup_pct(t).alias("dup_pct"))


@query(_DUP.replace("$ROWS", "SELECT doc_id AS id, text FROM documents"))
def t1_t2_ag8_documents(spark, d):
    return _dup(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query(_DUP.replace("$ROWS", "SELECT cand_id AS id, replace(abstract, chr(10), ' ') || ' See Fig. 3. See Fig. 3. ' || replace(abstract, chr(10), ' ') AS text FROM candidates"))
def t3_sentences(spark, d):
    one = F.replace("abstract", F.lit("\n"), F.lit(" "))
    return _dup(_candidates(spark, d).select(F.col("cand_id").alias("id"), F.concat(one, F.lit(" See Fig. 3. See Fig. 3. "), one).alias("text")))


_NOISY = "CASE WHEN doc_id % 3 = 0 THEN 'see [51, 53] and [7] ' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN 'low- quality a- b- c ' ELSE '' END || CASE WHEN doc_id % 7 = 0 THEN '中文 ' ELSE '' END || text"


@query(rf"""SELECT doc_id, len(regexp_extract_all(t, '\[\d+(\s*,\s*\d+)*\]')) AS citation_groups, regexp_matches(t, '[\x{{3400}}-\x{{4DBF}}\x{{4E00}}-\x{{9FFF}}\x{{0250}}-\x{{02AF}}]') AS cjk_present,
  length(regexp_replace(t, '{_SPACE}', '', 'g')) AS content_chars, trim(regexp_replace(left(t, 4000), '{_SPACE}+', ' ', 'g')) AS clean FROM (SELECT doc_id, {_NOISY} AS t FROM documents)""".replace("left(t, 4000)", "t"))
def t5_t6_t16_t17_texts(spark, d):
    t = F.col("t")
    docs = table(spark, d, "documents").selectExpr("doc_id", f"{_NOISY} AS t")
    return docs.select("doc_id", T.citation_groups(t).alias("citation_groups"), T.cjk_present(t).alias("cjk_present"), T.content_chars(t).alias("content_chars"), T.collapse_space(t).alias("clean"))


# A hyphen's count: places where what is left of the text after it starts with a blank and a word goes on.
@query(rf"""WITH t AS (SELECT doc_id, {_NOISY} AS t FROM documents)
SELECT doc_id, len(list_filter(string_split(regexp_replace(t, '([\p{{L}}\p{{N}}_])-{_SPACE}+', '\1' || chr(2), 'g'), chr(2))[2:], lambda x: regexp_matches(x, '^[\p{{L}}\p{{N}}_]'))) AS hyphen_artifacts FROM t WHERE t IS NOT NULL""")
def t4_hyphen_artifacts(spark, d):
    return table(spark, d, "documents").selectExpr("doc_id", f"{_NOISY} AS t").where("t IS NOT NULL").select("doc_id", T.hyphen_artifacts(F.col("t")).alias("hyphen_artifacts"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(content, '(?s)\A```(markdown)?[ \t]*\n(.*?)\n?```\s*\z') THEN regexp_extract(content, '(?s)\A```(?:markdown)?[ \t]*\n(.*?)\n?```\s*\z', 1) ELSE content END AS body FROM (SELECT page_id, replace(content, chr(13) || chr(10), chr(10)) AS content FROM ocr_pages)""")
def t18_fences(spark, d):
    return table(spark, d, "ocr_pages").select("page_id", T.strip_fence(F.col("content")).alias("body"))


_GROUNDED = "'<|ref|>title<|/ref|><|det|>[[1, 2]]<|/det|>' || chr(10) || content || chr(10) || 'text' || chr(10) || chr(10) || '<|ref|>text<|/ref|>' || chr(10) || chr(10) || '<|/ref|>end'"


@query(rf"""WITH g AS (SELECT page_id, {_GROUNDED} AS t FROM ocr_pages), b AS (SELECT page_id, regexp_replace(t, '(?s)<\|det\|>.*?<\|/det\|>', '', 'g') AS t FROM g),
s AS (SELECT page_id, regexp_replace(t, '<\|/?ref\|>', '', 'g') AS a, replace(regexp_replace(regexp_replace(t, '<\|ref\|>[^<]*<\|/ref\|>', '', 'g'), '<\|/?ref\|>', '', 'g'), chr(13) || chr(10), chr(10)) AS l FROM b)
SELECT page_id, {_strip("a")} AS plain, {_strip("regexp_replace(array_to_string(list_filter(string_split(l, chr(10)), lambda x: NOT list_contains(['text','title','sub_title','table','figure_title','image','image_caption'], " + _strip("x") + r")), chr(10)), '\n{3,}', chr(10) || chr(10), 'g')")} AS layout FROM s""")
def t19_t20_grounding(spark, d):
    g = table(spark, d, "ocr_pages").selectExpr("page_id", f"{_GROUNDED} AS t")
    return g.select("page_id", T.decode_grounding(F.col("t")).alias("plain"), T.decode_layout(F.col("t")).alias("layout"))


@query("""WITH g AS (SELECT cand_id, abstract AS g, replace(abstract, 'th', 't') AS p FROM candidates WHERE length(abstract) = octet_length(encode(abstract)))
SELECT cand_id, round(CASE WHEN greatest(length(g), length(p)) = 0 THEN 0.0 ELSE levenshtein(g, p) / greatest(length(g), length(p)) END, 4) AS text_edit_distance FROM g""")
def t8_t13_edit_distance(spark, d):
    c = _candidates(spark, d).where("length(abstract) = octet_length(abstract)")
    return c.select("cand_id", F.round(T.edit_distance(F.col("abstract"), F.replace("abstract", F.lit("th"), F.lit("t"))), 4).alias("text_edit_distance"))


# -- scorecard ----------------------------------------------------------------
_KINDS = {"latency": "float", "completion_tokens": "int", "citation_groups": "int", "cjk_present": "text", "finish_reason": "text"}
_CELLS_SQL = r"""WITH s AS (SELECT model, latency, completion_tokens, len(regexp_extract_all(content, '\[\d+(\s*,\s*\d+)*\]')) AS cg,
  CASE WHEN regexp_matches(content, '[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{0250}-\x{02AF}]') THEN 'True' WHEN content IS NOT NULL THEN 'False' END AS cjk, upper(left(finish_reason, 1)) || lower(substr(finish_reason, 2)) AS fr FROM ocr_pages),
cells AS (SELECT model, 'latency' AS dim, avg(latency) AS num, NULL AS txt FROM s GROUP BY model
UNION ALL SELECT model, 'completion_tokens', median(completion_tokens), NULL FROM s GROUP BY model
UNION ALL SELECT model, 'citation_groups', median(cg), NULL FROM s GROUP BY model
UNION ALL SELECT model, 'cjk_present', NULL, mode(cjk ORDER BY cjk) FROM s GROUP BY model
UNION ALL SELECT model, 'finish_reason', NULL, mode(fr ORDER BY fr) FROM s GROUP BY model)"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return S.aggregate_scores(S.long_scores(S.score_pages(table(spark, d, "ocr_pages")), _KINDS))


@query(f"{_CELLS_SQL} SELECT model, dim, round(num, 6) AS num, txt FROM cells")
def ag1_ag2_ag4_scorecard(spark, d):
    """The document-quality scorecard in long form: models by dimensions."""
    return _cells(spark, d).select("model", "dim", F.round("num", 6).alias("num"), "txt")


@query(f"""{_CELLS_SQL} SELECT model, max(round(num, 6)) FILTER (dim = 'latency') AS latency, max(num) FILTER (dim = 'completion_tokens') AS completion_tokens, max(num) FILTER (dim = 'citation_groups') AS citation_groups,
  max(txt) FILTER (dim = 'cjk_present') AS cjk_present FROM cells GROUP BY model""")
def ag3_pivot(spark, d):
    p = S.pivot_scores(_cells(spark, d), list(_KINDS))
    nums = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("latency", "completion_tokens", "citation_groups")]
    return p.select("model", *nums, "cjk_present")


@query(f"""{_CELLS_SQL}, g AS (SELECT model, dim, num * CASE dim WHEN 'latency' THEN -1 WHEN 'citation_groups' THEN 1 END AS good FROM cells),
b AS (SELECT dim, max(good) AS good FROM g WHERE good IS NOT NULL GROUP BY dim), w AS (SELECT dim, min(model) AS model FROM g JOIN b USING (dim, good) GROUP BY dim HAVING count(*) = 1)
SELECT c.model, coalesce(string_agg(w.dim, ', ' ORDER BY w.dim), 'none') AS leads FROM (SELECT DISTINCT model FROM cells) c LEFT JOIN w ON c.model = w.model GROUP BY c.model""")
def ag6_ag7_verdicts(spark, d):
    return S.verdicts(_cells(spark, d))


@query("""SELECT cand_id, (coalesce(nullif(cited_by, -1), 0) / 10.0 + (1 - len(authors) / 20.0)) / 2 AS accuracy FROM candidates""")
def ag5_composite(spark, d):
    c = _candidates(spark, d)
    size = F.when(F.col("authors").isNotNull(), F.size("authors"))
    return c.select("cand_id", S.composite_accuracy(F.coalesce(F.nullif("cited_by", F.lit(-1)), F.lit(0)) / 10.0, size / 20.0).alias("accuracy"))


@query(r"""SELECT cand_id, CASE WHEN ends_with(lower(pdf_url), '.pdf') THEN 'pdf' WHEN contains(url, '/doi/') THEN 'html' END AS kind,
  len(list_filter(string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/'), lambda x: regexp_matches(x, '^10\.\d{4,}$'))) > 0 AS doi_url,
  CASE WHEN cited_by IS NULL THEN 'missing-key' WHEN cited_by % 7 = 0 THEN 'rate-limited' WHEN cited_by % 5 = 0 THEN 'api-error' WHEN cited_by % 3 = 0 THEN 'empty' ELSE 'ok' END AS outcome FROM candidates WHERE url IS NOT NULL""")
def k1_k12_k13_classes(spark, d):
    c = _candidates(spark, d).where("url IS NOT NULL")
    kind = F.when(F.endswith(F.lower("pdf_url"), F.lit(".pdf")), "Application/PDF; q=1").when(F.contains("url", F.lit("/doi/")), "text/html")
    status = F.when(F.col("cited_by") % 7 == 0, 429).when(F.col("cited_by") % 5 == 0, 500).otherwise(200)
    return c.select(
        "cand_id", K.response_type(kind, F.lit("")).alias("kind"), K.is_doi_url(F.col("url")).alias("doi_url"),
        K.search_outcome(status, F.when(F.col("cited_by") % 3 == 0, 0).otherwise(1), F.col("cited_by").isNotNull()).alias("outcome"),
    )
