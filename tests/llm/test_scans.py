from quillspark.llm.scans import page_paragraphs, scan_noise

_SCHEMA = "page_id bigint, model string, page string, content string, line_no int"
_A = ["accuracy", "method", "panel", "sites", "resolution", "results", "survey", "archive"]


def _body(n):
    """Eight lines that no other page has."""
    return [f"{'  The' if i == 0 else 'and the'} {_A[i]} of {_A[(i + n) % 8]} reports its {_A[(3 * i + n) % 8]} with method accuracy" for i in range(8)]


def _pages(spark):
    rows = []
    for n in range(1, 7):
        body = _body(n)
        head = ["A study of panels and their methods", "Ada Lovelace, Alan M. Turing"] if n == 1 else ["A study of panels and"]
        extra = {2: ["Every high-resolution meth-", "od reports high-", "resolution sites."], 3: ["Each rnethod has its sit3s."], 4: ["Here the acc-"], 5: ["uracy goes on."]}.get(n, [])
        mid = extra + body if n == 5 else body + extra
        rows.append((n, "m", f"pages/paper_1/p_{n}.png", "\n".join(head + mid + [f"- {40 + n} -"])))
    rows.append((7, "m", "pages/paper_2/p_1.png", "```markdown\n" + "\n".join(_body(7)) + "\n```"))
    rows += [(8, None, None, None), (9, "m", None, ""), (None, "m", "pages/x/p_1.png", "lost"), (10, "m", "noslash", "word " * 30_000)]
    return spark.createDataFrame([(*r, 1) for r in rows], _SCHEMA)


def test_each_kind_of_noise(spark):
    got = {}
    for r in scan_noise(_pages(spark)).collect():
        got.setdefault(r.kind, set()).add((r.page_id, r.line_no))
    assert got["furniture"] == {(n, 1) for n in range(2, 7)} | {(1, 11), (2, 13), (3, 11), (4, 11), (5, 11), (6, 10)}
    assert got["hyphen"] == {(2, 10), (4, 10)}
    assert got["misread"] == {(3, 10)}


def test_paragraphs_are_continuous(spark):
    rows = {(r.page_id, r.paragraph): r.text for r in page_paragraphs(_pages(spark)).collect()}
    page2 = " ".join(t for (p, _), t in sorted(rows.items()) if p == 2)
    assert page2 == " ".join(_body(2)).strip() + " Every high-resolution method reports high-resolution sites."
    assert not any("- 4" in t or "```" in t for t in rows.values())


def test_an_empty_table(spark):
    assert scan_noise(_pages(spark).limit(0)).count() == 0
