"""Passages of evaluation items inside a corpus, by winnowed fingerprints.

Texts are folded to their letters and digits. Of every window of ``WINDOW``
consecutive k-grams the smallest hash is kept, so any shared span of at least
``K + WINDOW - 1`` characters shares a fingerprint, wherever it starts. A k-gram
that many items have (stock lead-ins, templates) is no item's own wording: it
neither makes a candidate nor counts. Fingerprints of documents and items are
joined; each pair found is then extended over all their common k-grams, and the
share of the item's own wording that the document carries decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.folding import letters_and_digits
from quillspark.runtime import scratch, write_table

#: Characters of a k-gram (a power of two), and k-grams of a window.
K = 16
WINDOW = 9
#: A k-gram in more than this share of the distinct items, and in more than so many, is nobody's own wording.
COMMON_SHARE = 0.02
COMMON_ITEMS = 3
#: Share of an item's own wording that makes a document a case ("about half or more").
MIN_SHARE = 0.33

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def gram_hashes(folded: str) -> np.ndarray:
    """Hashes of all k-grams; one of a shorter text as a whole, none of an empty one."""
    codes = np.frombuffer(folded.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, dtype=np.int64)
    k = min(K, len(codes))
    n = len(codes) - k + 1
    with np.errstate(over="ignore"):
        if k == K:  # of two halves, of two halves each
            h, power, size = codes, _BASE, 1
            while size < K:
                h = h[:-size] * power + h[size:]
                power, size = power * power, 2 * size
        else:
            h = np.zeros(n, dtype=np.uint64)
            for i in range(k):
                h = h * _BASE + codes[i : i + n]
        h ^= h >> np.uint64(33)
        h *= _MIX
        h ^= h >> np.uint64(33)
    return h.view(np.int64)


def fingerprints(folded: str) -> np.ndarray:
    """The distinct smallest hashes of all windows."""
    h = gram_hashes(folded)
    if len(h) <= WINDOW:
        return np.unique(h)[:1]
    least, size = h, 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        least, size = np.minimum(least[:-step], least[step:]), size + step
    return np.unique(least[np.append(True, least[1:] != least[:-1])])


def _prints(texts: DataFrame, key: str, text: str, all_grams: bool) -> DataFrame:
    """``key, h``: fingerprints, or all k-grams, of each text, distinct within a text."""
    kind = dict(texts.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), 64):
                part = b.iloc[i : i + 64]
                prints = [np.unique(gram_hashes(s)) if all_grams else fingerprints(s) for s in map(letters_and_digits, part["text"])]
                yield pd.DataFrame({"key": np.repeat(part["key"].to_numpy(), [len(p) for p in prints]), "h": np.concatenate(prints) if prints else []})

    rows = texts.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(run, f"key {kind}, h bigint").withColumnRenamed("key", key)


def _carried(min_share: float) -> Callable[..., Column]:
    """Share of each item's own characters that lie in k-grams it has in common with the document; 0 if it is below ``min_share``."""

    @F.pandas_udf(T.DoubleType())
    def carried(document: pd.Series, item: pd.Series, common: pd.Series) -> pd.Series:
        last, held, known = None, np.empty(0, dtype=np.int64), {}
        out = []
        for d, i, c in zip(document, item, common):
            if d != last:  # pairs come by document
                last, held = d, np.sort(gram_hashes(letters_and_digits(d)))
            if i not in known:
                folded = letters_and_digits(i)
                grams, width = gram_hashes(folded), min(K, len(folded))
                own = ~np.isin(grams, c)
                known[i] = grams, own, width, max(1, _covered(own, width))
            grams, own, width, most = known[i]
            both = own & _in_sorted(grams, held)
            # Grams that do not overlap cover the most.
            enough = np.count_nonzero(both) * width >= min_share * most
            out.append(_covered(both, width) / most if enough else 0.0)
        return pd.Series(out, dtype="float64")

    return carried


def _in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values if len(among) else np.zeros(len(values), dtype=bool)


def _covered(starts: np.ndarray, width: int) -> int:
    edges = np.zeros(len(starts) + width, dtype=np.int64)
    edges[: len(starts)] += starts
    edges[width:] -= starts
    return int(np.count_nonzero(np.cumsum(edges) > 0))


def leaks(documents: DataFrame, items: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """``doc_id, item_id, share``: documents that carry at least ``min_share`` of an item's own wording.

    Rows with a null id or text give nothing, and so do texts without letters or
    digits. Items of one wording under several ids are all reported; a repeated
    row is reported once. An item none of whose wording is its own is never
    found. Other columns are not read.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    its = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    its = its.withColumn("wording", F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", "")))

    # How many wordings have a k-gram; the items' own are those that few have.
    grams = _prints(its.groupBy("wording").agg(F.min("text").alias("text")), "wording", "text", True)
    total = grams.select(F.countDistinct("wording").alias("n"))
    common = grams.groupBy("h").agg(F.count("*").alias("df")).crossJoin(F.broadcast(total)).where((F.col("df") > COMMON_ITEMS) & (F.col("df") > F.col("n") * COMMON_SHARE))
    common = write_table(common.select("h"), scratch(spark, "common-grams"))
    own = _prints(its, "item_id", "text", False).join(common, "h", "left_anti")

    # Per item its common k-grams: they are bounded by its own length.
    marked = grams.join(common.withColumn("is_common", F.lit(True)), "h", "left")
    shared = marked.groupBy("wording").agg(F.collect_list(F.when(F.col("is_common"), F.col("h"))).alias("common"), F.count_if(F.col("is_common").isNull()).alias("own_grams"))
    its = its.join(shared, "wording").select("item_id", F.col("text").alias("item_text"), "common", "own_grams")

    # A shared span of L characters has a fingerprint per K + 2 * WINDOW - 1 of them at least. Half as many are
    # asked of a pair, as some may be common ones; extension then counts exactly.
    least = F.col("own_grams") * min_share / (2 * (K + 2 * WINDOW - 1))
    pairs = _prints(docs, "doc_id", "text", False).join(own, "h").groupBy("doc_id", "item_id").agg(F.count("*").alias("hits"))
    pairs = pairs.join(its.select("item_id", "own_grams"), "item_id").where(F.col("hits") >= least).select("doc_id", "item_id")
    near = pairs.join(its.drop("own_grams"), "item_id").join(docs.where("text IS NOT NULL"), "doc_id").sortWithinPartitions("doc_id")
    found = near.select("doc_id", "item_id", _carried(min_share)("text", "item_text", "common").alias("share")).where(F.col("share") >= min_share)
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"))


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``benchmark, items, leaked_items, leaked_documents``: how far each benchmark leaked."""
    found = leaks(documents, items).join(items.select("item_id", "benchmark").distinct(), "item_id")
    counts = found.groupBy("benchmark").agg(F.countDistinct("item_id").alias("leaked_items"), F.countDistinct("doc_id").alias("leaked_documents"))
    per = items.groupBy("benchmark").agg(F.countDistinct("item_id").alias("items"))
    left = per.join(counts, per["benchmark"].eqNullSafe(counts["benchmark"]), "left")
    return left.select(per["benchmark"], "items", F.coalesce("leaked_items", F.lit(0)).alias("leaked_items"), F.coalesce("leaked_documents", F.lit(0)).alias("leaked_documents"))
