import random

from quillspark.llm.abuse import _compressor, abuse_rates, abuse_scores, fit, windows

_FINE = ["The {a} method scales to {n} documents without loss of recall.", "We discuss limits of {a} planning and outline the next {n} steps.", "Across {n} repeated runs the {a} error varied by less than ten percent."]
_BAD = ["You are a worthless {a} and nobody here wants your {n} papers.", "Get out of this {a} lab, you pathetic liar, before I count to {n}."]
_WORDS = ["sparse", "glacier", "causal", "robust", "medical", "optical"]


def _text(r, bad):
    s = [r.choice(_FINE) for _ in range(5)] + ([r.choice(_BAD)] if bad else [])
    r.shuffle(s)
    return " ".join(x.format(a=r.choice(_WORDS), n=r.randrange(10, 4000)) for x in s)


def _data(n=240):
    r = random.Random(5)
    y = [i % 5 == 0 for i in range(n)]
    return [_text(r, b) for b in y], y


def test_held_out_accuracy_with_erring_reviewers():
    texts, y = _data()
    said = [not b if i % 40 == 7 else b for i, b in enumerate(y)]
    model = fit(texts[:160], said[:160])
    s = model.scorer()
    got = [s.document(windows(t)) >= model.threshold for t in texts[160:]]
    assert sum(a == b for a, b in zip(got, y[160:])) >= 78


def test_obfuscated_spellings_are_one():
    assert windows("You are a w.o.r.t.h.l.e.s.s c0w, stooooop it")[0] == b"you are a worthless cow, stop it"


def test_scores_of_odd_rows(spark):
    texts, y = _data(120)
    docs = [(i, t, "s2" if i % 2 else None, "x") for i, t in enumerate(texts)] + [(500, None, "s2", "x"), (501, "", "s2", "x"), (502, " \n ", None, "x"), (None, texts[0], "s2", "x"), (503, "long text. " * 9000, "s2", "x")]
    d = spark.createDataFrame(docs + docs[-1:], "doc_id bigint, text string, source string, abusive string")
    lab = spark.createDataFrame([(i, "r", int(b)) for i, b in enumerate(y)] + [(1, "q", None), (None, "q", 1)], "doc_id bigint, reviewer string, abusive int")
    out = abuse_scores(d, lab).collect()
    assert len(out) == len(docs) + 1
    got = {r.doc_id: r for r in out}
    assert all(got[i].abusive == b for i, b in enumerate(y)) and got[None].abusive and not got[503].abusive
    assert [got[i].score for i in (500, 501, 502)] == [None] * 3
    rates = {r.source: r for r in abuse_rates(d, lab).collect()}
    assert rates["s2"].documents == 60 + 3 and rates[None].abusive == 12
    none = abuse_scores(d, lab.limit(0)).collect()
    assert len(none) == len(docs) + 1 and not any(r.abusive for r in none)
    assert abuse_scores(d.limit(0), lab).count() == 0


def test_a_large_dictionary_is_seen_whole():
    r = random.Random(1)
    lines = ["".join(r.choices("abcdefghij klmnopqrst uvwxyz", k=90)).encode() for _ in range(45_000)]
    c = _compressor(b"\n".join(lines))
    assert max(len(c.compress(w)) for w in lines[:40] + lines[-40:]) < 30


def test_ordinary_sentences_are_known_however_many_documents_are_labelled():
    r = random.Random(2)
    noise = lambda: "".join(r.choices("abcdefghij klmnopqrst uvwxyz", k=2000))
    texts, y = _data(240)
    fine = [t for t, b in zip(texts, y) if not b]
    filler = [f"{noise()}. {noise()}." for _ in range(900)]
    model = fit(texts[:200] + filler, y[:200] + [False] * len(filler))
    s = model.scorer()
    assert not any(s.document(windows(t)) >= model.threshold for t in fine)
    assert all(s.document(windows(t)) >= model.threshold for t, b in zip(texts, y) if b)
