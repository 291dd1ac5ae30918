import datetime as dt

from pyspark.sql import functions as F

from quillspark.functions import classify as K
from quillspark.functions import identifiers as I
from quillspark.functions import text_quality as T
from quillspark.operators import relational as R
from quillspark.operators import scorecard as S
from quillspark.sources.jsonl import json_objects, line_list, numbered_lines, string_field


def _map(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_urls_are_trimmed_and_distinct(spark):
    text = "(https://ex.org/p_(v2).pdf), xhttps://no.org HTTPS://a.org/x. https://a.org/y)?! <https://a.org/z> https://ex.org/p_(v2).pdf"
    assert _map(spark, I.urls_in, [text, "", None]) == [["https://ex.org/p_(v2).pdf", "HTTPS://a.org/x", "https://a.org/y", "https://a.org/z"], [], None]


def test_dois(spark):
    got = _map(spark, I.doi_key, ["see https://doi.org/10.1000/AB.1.", "(10.1234/x(1))", "10.1234/y)", "none", None, "10.1234/z.,"])
    assert got == ["10.1000/ab.1", "10.1234/x(1)", "10.1234/y", None, None, "10.1234/z"]
    assert _map(spark, I.bare_doi, ["https://DOI.org/10.1/X", "dx.doi.org/10.1/x"]) == ["10.1/X", "dx.doi.org/10.1/x"]


def test_titles_and_names(spark):
    assert _map(spark, I.title_from_url, ["https://h/12_A+big_Title?x=1", "https://h/2020", "https://h/a%20b/"]) == ["A big Title", None, "a b"]
    assert _map(spark, lambda c: I.target_name(c, ".pdf"), ["https://h/a/b.PDF?x", "https://h/", "https://h/a#f"]) == ["b.PDF", "index.pdf", "a.pdf"]
    assert _map(spark, lambda c: I.title_overlap(c, F.lit("The art of war")), ["art of war", "", None and "x"])[:2] == [1.0, 0.0]
    assert _map(spark, I.retry_after, [" 3 ", "-1", "soon"]) == [3.0, None, None]


def test_text_scores(spark):
    assert _map(spark, T.dup_pct, ["a line\na line\n---\nA\n\nb line", "One two. One two. See Fig. 1 now.", "", " \n"]) == [33.3, 33.3, 0.0, 0.0]
    assert _map(spark, T.hyphen_artifacts, ["low- quality a- b- c", "é- à", "x -y"]) == [3, 1, 0]
    assert _map(spark, T.citation_groups, ["[1] [2, 3] [a]"]) == [2]
    assert _map(spark, T.cjk_present, ["中", "ə", "é"]) == [True, True, False]
    assert _map(spark, T.strip_fence, ["```markdown\nx\n```\n", "a ```\nx\n```"]) == ["x", "a ```\nx\n```"]
    marked = "<|ref|>title<|/ref|><|det|>[[1]]<|/det|>\nBody\ntext\n\n\n\nEnd"
    assert _map(spark, T.decode_grounding, [marked]) == ["title\nBody\ntext\n\n\n\nEnd"]
    assert _map(spark, T.decode_layout, [marked]) == ["Body\n\nEnd"]


def test_cosine_guards(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 2.0]), ([0.0], [1.0]), ([float("inf")], [1.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    assert [r[0] for r in df.select(T.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0, 0.0]


_CAND = "ord bigint, abstract string, abstract_present boolean, url string, doi string, cited_by bigint"


def test_a_copy_without_abstract_does_not_win(spark):
    rows = [(1, None, None, "u1", "10.1234/a", 5), (2, "text", None, "u2", "10.1234/A", 5), (3, "text", True, "u3", "10.1234/a.", 9), (4, "text", False, "u4", None, None), (5, "t", None, "u5", None, 0)]
    c = spark.createDataFrame(rows, _CAND)
    out = R.with_abstracts(c)
    assert sorted(r.ord for r in out.kept.collect()) == [2, 5]
    assert sorted((r.ord, r.reason) for r in out.audit.collect()) == [(1, "no-abstract"), (3, "dedup-doi"), (4, "no-abstract")]
    top = R.top_cited(c, 2)
    assert [r.ord for r in top.kept.collect()] == [3, 1]
    assert sorted((r.ord, r.reason) for r in top.audit.collect()) == [(2, "beyond-top"), (4, "no-cited-by"), (5, "beyond-top")]
    assert R.top_cited(c, 0).kept.count() == 0 and R.top_cited(c.limit(0)).audit.count() == 0


def test_last_wins_with_null_keys(spark):
    df = spark.createDataFrame([("m", None, 1, 1.0), ("m", None, 3, None), ("m", "p", 2, 2.0)], "model string, page string, ord bigint, latency double")
    assert sorted((r.page or "", r.ord, r.latency) for r in R.last_wins(df.withColumn("o", F.col("ord")), "model", "page", ord="o").collect()) == [("", 3, None), ("p", 2, 2.0)]


def test_scorecard(spark):
    rows = [("a", 1, 0.5, "stop"), ("a", 4, float("nan"), "length"), ("b", 2, 0.25, "stop"), ("b", 3, None, None)]
    s = spark.createDataFrame(rows, "model string, citation_groups int, latency double, finish string")
    cells = S.aggregate_scores(S.long_scores(s, {"citation_groups": "int", "latency": "float", "finish": "text"})).cache()
    assert {(r.model, r.dim): r.num if r.num is not None else r.txt for r in cells.collect()} == {
        ("a", "citation_groups"): 2.5, ("b", "citation_groups"): 2.5, ("a", "latency"): 0.5, ("b", "latency"): 0.25, ("a", "finish"): "Length", ("b", "finish"): "Stop",
    }
    assert {r.model: r.leads for r in S.verdicts(cells).collect()} == {"a": "none", "b": "latency"}
    assert S.render_markdown(cells).splitlines()[2] == "| a | 2.5 | Length | 0.5 |"


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"url": "u", "n": 1}\n\n[1]\n{bad\n"s"\n {"url": 5}\r\n', encoding="utf-8")
    lines = numbered_lines(spark, f"file://{tmp_path}/x.jsonl")
    out = json_objects(lines, "abstract-filter")
    assert [(r.line_no, r.url) for r in out.kept.select("line_no", string_field(F.col("doc"), "url").alias("url")).orderBy("line_no").collect()] == [(1, "u"), (6, None)]
    assert [r.reason for r in out.audit.orderBy("ord").collect()] == ["non-object candidate line 3", "unparseable candidate line 4", "non-object candidate line 5"]
    assert json_objects(lines, "x", audit=False).audit.count() == 0
    assert [r.ord for r in line_list(spark, f"file://{tmp_path}/x.jsonl").orderBy("ord").collect()] == [1, 3, 4, 5, 6]


def test_classes(spark):
    df = spark.createDataFrame([("text/html; charset=x", "%PDF-1"), ("Application/PDF", ""), ("text/html", "<p>"), (None, None)], "t string, b string")
    assert [r[0] for r in df.select(K.response_type(F.col("t"), F.col("b"))).collect()] == ["pdf", "pdf", "html", None]
    assert _map(spark, lambda c: K.bot_wall(F.lit(403), c, ("pub.example",)), ["https://www.PUB.example/x", "https://notpub.example/"]) == ["pub.example", None]
    assert _map(spark, K.is_doi_url, ["https://h/doi/10.1234/x", "https://h/a"]) == [True, False]


def test_pages_and_sidecars(spark):
    p = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 2, "y")], "paper string, page_no int, content string")
    got = {r.paper: r for r in R.assemble_pages(p).collect()}
    assert got["a"].whole and not got["b"].whole and got["a"].document == "<!-- page: 1 -->\n\nx\n\n---\n\n<!-- page: 2 -->\n\n[page failed]"
    o = spark.createDataFrame([("s", "d", "v")], "stem string, doi string, venue string")
    n = spark.createDataFrame([("s", None, "w"), ("t", "e", None)], "stem string, doi string, venue string")
    assert sorted(tuple(r) for r in R.upsert_sidecars(o, n).collect()) == [("s", "d", "w"), ("t", "e", None)]
