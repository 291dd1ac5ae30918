import datetime as dt

from quillspark.llm.queries import QUERIES
from quillspark.llm.survivorship import best_rows, pdf_link, surviving_records

_SCHEMA = "cand_id bigint, batch_id int, abstract string, source string, source_id string, doi string, pdf_url string, cited_by bigint, fetched_at timestamp"
_TEXT = "We measure how far survivors keep their fields."


def _rows(spark):
    day = [dt.datetime(2025, 1, d) for d in range(1, 8)]
    rows = [
        (1, 1, "See full text.", "s2", "a1", "10.92317/wfwn.2019.123456001", "/files/1.pdf", 9, day[5]),
        (2, 1, _TEXT, "s2", "a1", "https://doi.example/10.92317/WFNW.2019.123456001", "https://repo.example/abs/1.2", 4, day[6]),
        (3, 2, _TEXT, "s2", "a1", "10.92317/wfnw.2019.123456001", "https://repo.example/pdf/1.2", -1, dt.datetime(2026, 1, 1)),
        (4, 2, _TEXT, "s2", "a1", None, "http://archive.example/8/paper.PDF?download=1", 5, day[6]),
        (5, 2, _TEXT, "arxiv", "lonely", "10.92317/wfnw.2019.654321001", None, 1, day[1]),
    ]
    more = [(10 + i, 1, None, "openalex", f"W{i}", f"10.92317/wfnw.2018.77700{i}001", None, None, day[0]) for i in range(6)]
    return spark.createDataFrame(rows + more, _SCHEMA)


def test_each_field_comes_from_its_best_row(spark):
    assert {tuple(r) for r in best_rows(_rows(spark)).collect()} == {(1, "abstract", 2), (1, "doi", 2), (1, "pdf_url", 3), (1, "cited_by", 2)}
    assert {"p7_found", "p7_records"} <= set(QUERIES)


def test_one_record_survives_per_group(spark):
    (r,) = surviving_records(_rows(spark)).collect()
    assert (r.first_cand_id, r.members, r.abstract, r.cited_by, r.pdf_url) == (1, 4, _TEXT, 4, "https://repo.example/pdf/1.2")


def test_pdf_links(spark):
    good = ["https://oa.example/W1.pdf", "http://a.example/8/paper.PDF?download=1", "https://r.example/pdf/1.2"]
    bad = ["https://", "/files/1.pdf", "javascript:void(0)", "N/A", "https://r.example/login?next=/x.pdf", "https://r.example/landing/1.html", None]
    df = spark.createDataFrame([(u,) for u in good + bad], "u string")
    assert [r[0] for r in df.select(pdf_link(df.u)).collect()] == [True] * len(good) + [False] * len(bad)
