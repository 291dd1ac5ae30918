from quillspark.llm.truncation import _LINK, _NAME, _PATTERNS, _START, _tokens, flag_cut


def test_fragments_of_one_and_two_letters_are_cut_texts(spark):
    whole = [f"Every study{i} gains from quick trials." for i in range(60)]
    cut = ["Some zebra jumped over q", "Another heron waded beyond qu", "Their otter swam beneath qui"]
    rows = spark.createDataFrame([("s2", t) for t in whole + cut], "source string, abstract string")
    assert {r.abstract for r in flag_cut(rows).where("is_cut").collect()} == set(cut)


def test_words_and_their_classes(spark):
    body = '(See "Ada") in 3.5 cases, x(y) a2. Then http://a.example/b, https://c.example Äb ("q") end.'
    text = spark.createDataFrame([(body,)], "body string")
    ws = spark.sql(f"SELECT {_tokens('body')} AS ws FROM {{text}}", args={k: v for k, v in _PATTERNS.items() if k.startswith(("find", "put"))}, text=text).first().ws
    s, n = _START, _NAME
    assert ws == [s, s, "see", n, "in", "#", "cases,", "x(y", "a2", s, s, "then", _LINK, _LINK, n, "q", "end"]


def test_no_pattern_looks_behind_at_every_place():
    assert not [p for k, p in _PATTERNS.items() if k.startswith("find") and ("|(?<" in p or p.startswith("(?<"))]


def test_trigrams_are_counted_over_distinct_sentences(spark):
    from pyspark.sql import functions as F

    from quillspark.llm import truncation as T

    texts = spark.createDataFrame([("s", "The cat sat. The cat sat. A dog ran on", 0), ("s", "The cat sat.", 0)], "src string, body string, len int")
    df = spark.sql(T._THREE, args=T._PATTERNS, texts=texts)
    s = T._START
    # The three sentences are two of a kind, so two are taken apart.
    got = {(r.c1, r.c2, r.c3): (r.inside, r.terminal) for r in df.collect()}
    assert got[s, s, "the"] == (3, 0) and got["the", "cat", "sat"] == (0, 3) and got["dog", "ran", "on"] == (0, 1) and len(got) == 7
    assert "GROUP BY sentence" in T._THREE
    tidy = F.regexp_replace("body", T._PATTERNS["space"], " ")
    rows = spark.createDataFrame([("a \n\u00a0 b  c\td \n",)], "body string")
    assert rows.select(tidy).first()[0] == "a b c d "
