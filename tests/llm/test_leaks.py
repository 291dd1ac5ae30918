import numpy as np
import pandas as pd

from quillspark.llm import leaks as module
from quillspark.llm.folding import letters_and_digits
from quillspark.llm.leaks import K, WINDOW, fingerprints, gram_hashes, leaks

_LEAD = "Consider the following passage and select the correct option below. "
_NAMES = ["Erdasor", "Breva", "Zanloril", "Pelquin", "Ostavar", "Mirdel"]
_ITEMS = [(i, f"{_LEAD}A ledger kept at {n} shows {31 + i}.5 loans and {77 - i} returns. When the {n}abakel valve opens, pressure climbs to {i}3.{i} before {n[::-1]} intervenes.") for i, n in enumerate(_NAMES)]


def _found(spark, docs, items=_ITEMS):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, benchmark string")
    i = spark.createDataFrame([(*r, "b") for r in items], "item_id bigint, text string, benchmark string")
    return sorted((r.doc_id, r.item_id) for r in leaks(d, i).collect())


def test_whole_altered_spread_and_half_passages_are_found(spark):
    one = _ITEMS[1][1]
    body = one[len(_LEAD) :]
    first, second = body.split(". ", 1)
    docs = [
        (10, "Before. " + one + " After.", None),
        (11, "x " + body.lower().replace(".", "").replace(",", ""), None),
        (12, first + ". Something quite different stands here. " * 9 + second, None),
        (13, "Intro. " + second, None),
        (14, "Intro. " + body.replace("e", "е"), None),
        (20, _LEAD + "Nothing of the item itself follows this line.", None),
        (21, "At Breva the valve opens.", None),
        (22, None, None), (23, "", None), (24, " ... ", None), (None, one, None),
    ]
    assert _found(spark, docs + docs[:1]) == [(10, 1), (11, 1), (12, 1), (13, 1), (14, 1)]


def test_items_of_one_wording_are_all_reported(spark):
    items = [*_ITEMS, (90, _ITEMS[0][1].upper()), (91, None), (92, "")]
    assert _found(spark, [(1, _ITEMS[0][1], None)], items) == [(1, 0), (1, 90)]


def test_empty_tables(spark):
    assert _found(spark, []) == [] and _found(spark, [(1, "text", None)], []) == []


def test_every_long_enough_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("abcdef"), 80)) for _ in range(2))
        span = "".join(rng.choice(list("uvwxyz"), K + WINDOW - 1))
        i, j = rng.integers(0, 80, 2)
        assert set(fingerprints(a[:i] + span + a[i:])) & set(fingerprints(b[:j] + span + b[j:]))


def test_folding():
    assert letters_and_digits("Café 1⁄2 Ａ​Bа") == "cafe12aba"


def test_pairs_with_too_few_common_grams_are_not_measured(monkeypatch):
    calls, covered = [], module._covered
    monkeypatch.setattr(module, "_covered", lambda s, w: calls.append(1) or covered(s, w))
    items = [t[len(_LEAD) :] for _, t in _ITEMS]
    docs = [items[0], *[f"{items[0][:20]} {i} and nothing more of it" for i in range(50)], "", "-"]
    got = module._carried(0.33).func(pd.Series(docs), pd.Series([items[0]] * len(docs)), pd.Series([np.empty(0, np.int64)] * len(docs)))
    assert got[0] == 1.0 and not got[1:].any() and len(calls) == 2


def test_hashes_are_those_of_each_gram_and_window():
    rng = np.random.default_rng(11)
    for n in (1, 5, K - 1, K, K + 1, K + WINDOW - 2, K + WINDOW - 1, K + WINDOW, 90):
        text = "".join(rng.choice(list("abcé"), n))
        h = gram_hashes(text)
        assert [int(x) for x in h] == [int(gram_hashes(text[i : i + K])[0]) for i in range(len(h))]
        assert list(fingerprints(text)) == sorted({h[i : i + WINDOW].min() for i in range(max(1, len(h) - WINDOW + 1))})
