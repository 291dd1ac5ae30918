"""Abusive, hateful or sexual content, by compression distance.

Two zstandard dictionaries are made of labelled documents' windows (sentences):
one of ordinary text, one of abusive text. A window's score is the share of its
bytes that the abusive dictionary saves against the ordinary one; a document's
score is its worst window's. The threshold is calibrated on labelled documents
scored by dictionaries that have not seen them.

Labels are per document, but only some windows of an abusive one are abusive:
its windows that the ordinary dictionary writes no worse than held-out ordinary
windows are left out of the abusive dictionary. Reviewers err: ordinary documents
that score as abusive out of their fold are left out of the ordinary dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.folding import fold

#: Labelled documents of each kind that the dictionaries are fitted on at most, taken by a hash of their id.
FIT_DOCUMENTS = 3_000
#: Longer labelled texts are no part of the fit, so that its memory has a bound.
FIT_CHARS = 200_000
FOLDS = 3
LEVEL = 3
#: Bytes of a dictionary beyond which zstandard's double hash tables leave its beginning out.
TAGGED = (1 << 24) - 64
#: Shorter windows go with their neighbour: a frame's overhead would hide them.
MIN_WINDOW = 20
#: An abusive window compresses worse by the ordinary dictionary than this share of held-out ordinary ones.
NOVEL = 0.97

# Digits and signs written for letters.
_LEET = str.maketrans("013457@$!", "oieastasi")
_SPACED = re.compile(r"\b\w(?:[._\-*]\w){2,}\b")
_LEET_WORD = re.compile(r"\b(?=[\w@$!]*[^\W\d_])(?=[\w@$!]*[0-9@$!])[\w@$!]+\b")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
# What every match of the above has, and is found sooner.
_SPACED_END = re.compile(r"[._\-*]\w[._\-*]\w\b")
_THRICE = tuple(c * 3 for c in ascii_lowercase)


def windows(text: str) -> list[bytes]:
    """The text's sentences in one spelling; short ones go with the one before."""
    t = fold(text)
    if _SPACED_END.search(t):
        t = _SPACED.sub(lambda m: re.sub(r"[._\-*]", "", m[0]), t)
    t = _LEET_WORD.sub(lambda m: m[0].translate(_LEET), t)
    if not t.isascii() or any(c in t for c in _THRICE):
        t = _DRAWN.sub(r"\1", t)
    out: list[bytes] = []
    for s in _SENTENCE.split(t):
        b = " ".join(s.split()).encode()
        if out and b and (len(b) < MIN_WINDOW or len(out[-1]) < MIN_WINDOW):
            out[-1] += b" " + b
        elif b:
            out.append(b)
    return out


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    """A compressor that sees the whole dictionary.

    A level's own tables reach its last megabyte or so, and leave the rest out. With
    tables of its size it is seen whole; from 16 MB on that needs hash chains, whose
    search may miss the best place.
    """
    d = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    flags = {"dict_size": len(dictionary), "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    p = zstd.ZstdCompressionParameters.from_level(LEVEL, **flags)
    log = len(dictionary).bit_length() - 1
    tables = {"hash_log": max(p.hash_log, log), "chain_log": max(p.chain_log, log)}
    if len(dictionary) >= TAGGED:
        tables["strategy"] = zstd.STRATEGY_LAZY
    p = zstd.ZstdCompressionParameters.from_level(LEVEL, **flags, **tables)
    d.precompute_compress(compression_params=p)
    return zstd.ZstdCompressor(dict_data=d, compression_params=p)


@dataclass(frozen=True)
class Model:
    """Two dictionaries' contents and the score from which a document is a case."""

    ordinary: bytes
    abusive: bytes
    threshold: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.ordinary, self.abusive = _compressor(model.ordinary), _compressor(model.abusive)

    def window(self, w: bytes) -> float:
        return (len(self.ordinary.compress(w)) - len(self.abusive.compress(w))) / len(w)

    def document(self, ws: list[bytes]) -> float:
        return max(map(self.window, ws), default=-1.0)


def _rate(c: zstd.ZstdCompressor, w: bytes) -> float:
    return len(c.compress(w)) / len(w)


def _dictionaries(docs: list[list[bytes]], bad: np.ndarray, fold_of: np.ndarray) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the abusive dictionary."""
    ordinary = [(i, w) for i in np.flatnonzero(~bad) for w in docs[i]]
    # How badly ordinary windows are written by a dictionary without their document.
    halves = [[w for i, w in ordinary if fold_of[i] % 2 == h] for h in (0, 1)]
    rates = [_rate(c, w) for h in (0, 1) if halves[h] and halves[1 - h] for c in [_compressor(b"\n".join(dict.fromkeys(halves[1 - h])))] for w in halves[h]]
    limit = float(np.quantile(rates, NOVEL)) if rates else 0.0
    content = b"\n".join(dict.fromkeys(w for _, w in ordinary))
    c = _compressor(content)
    abusive = dict.fromkeys(w for i in np.flatnonzero(bad) for w in docs[i] if _rate(c, w) > limit)
    return content, b"\n".join(abusive)


def _threshold(scores: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the fewest errors."""
    values = np.unique(scores)
    if len(values) < 2:
        return float(values[0]) + 1.0
    cuts = (values[1:] + values[:-1]) / 2
    errors = np.array([np.count_nonzero((scores >= t) != bad) for t in cuts])
    best = np.flatnonzero(errors == errors.min())
    return float(cuts[best[np.argmax((values[1:] - values[:-1])[best])]])


def fit(texts: list[str], bad: list[bool]) -> Model | None:
    """A model of labelled texts; None unless both kinds have enough to be held out."""
    docs = [windows(t) for t in texts]
    y = np.array(bad, dtype=bool)
    if min(np.count_nonzero(y), np.count_nonzero(~y)) < FOLDS * 2:
        return None
    order = np.zeros(len(y), dtype=int)
    for kind in (True, False):
        at = np.flatnonzero(y == kind)
        order[at] = np.arange(len(at))
    fold_of = order % (FOLDS * 2)

    def held_out(use: np.ndarray) -> np.ndarray:
        scores = np.full(len(y), -1.0)
        for f in range(FOLDS):
            out = fold_of % FOLDS == f
            kept = np.flatnonzero(use & ~out)
            a, b = _dictionaries([docs[i] for i in kept], y[kept], fold_of[kept] // FOLDS)
            s = Scorer(Model(a, b, 0.0))
            for i in np.flatnonzero(out):
                scores[i] = s.document(docs[i])
        return scores

    use = np.ones(len(y), dtype=bool)
    scores = held_out(use)
    # Mislabelled either way: out of both dictionaries.
    use = (scores >= _threshold(scores, y)) == y
    if min(np.count_nonzero(y & use), np.count_nonzero(~y & use)) < FOLDS * 2:
        use[:] = True
    scores = held_out(use)
    kept = np.flatnonzero(use)
    a, b = _dictionaries([docs[i] for i in kept], y[kept], fold_of[kept] // FOLDS)
    return Model(a, b, _threshold(scores, y))


def labelled_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[bool]]:
    """Texts and majority labels of at most ``FIT_DOCUMENTS`` documents of each kind; documents with a tied vote are left out."""
    votes = labels.where("doc_id IS NOT NULL AND abusive IN (0, 1)").groupBy("doc_id").agg(F.avg("abusive").alias("mean")).where("mean <> 0.5")
    rows = documents.where((F.trim("text") != "") & (F.length("text") <= FIT_CHARS)).select("doc_id", "text").join(votes, "doc_id")
    out: list = []
    for kind in ("mean > 0.5", "mean < 0.5"):
        out += rows.where(kind).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(FIT_DOCUMENTS).collect()
    return [r.text for r in out], [r.mean > 0.5 for r in out]


def abuse_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, source, score, abusive``: every document's score and whether it reaches the threshold.

    Whole texts are scored. A null or blank text has no score and is no case; so
    is every text if the labels do not allow a fit. Repeated rows come out as
    often as they go in; other columns are not read.
    """
    spark = documents.sparkSession
    model = fit(*labelled_sample(documents, labels))
    rows = documents.select("doc_id", "source", "text")
    if model is None:
        return rows.select("doc_id", "source", F.lit(None).cast("double").alias("score"), F.lit(False).alias("abusive"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = shared.value.scorer()
        for b in batches:
            scores = [s.document(ws) if isinstance(t, str) and (ws := windows(t)) else None for t in b["text"]]
            yield b[["doc_id", "source"]].assign(score=pd.array(scores, dtype="Float64"))

    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.mapInPandas(run, f"doc_id {kind}, source string, score double")
    return scored.withColumn("abusive", F.coalesce(F.col("score") >= model.threshold, F.lit(False)))


def abuse_rates(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``source, documents, abusive, rate``: each source's share of abusive documents, of those that have a text."""
    scored = abuse_scores(documents, labels).where("score IS NOT NULL")
    per = scored.groupBy("source").agg(F.count("*").alias("documents"), F.count_if("abusive").alias("abusive"))
    return per.withColumn("rate", F.col("abusive") / F.col("documents"))
