"""Packing texts into containers of a fixed number of tokens.

The plan is made over counts of lengths, not over texts: there are at most
``capacity`` different lengths, so the histogram has a proven bound whatever the
corpus, and best fit over it runs on the driver in time that does not depend on
the number of texts. Texts then take the planned slots by joining on their rank
within their length.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.runtime import scratch, write_table

#: Tokens a container holds, and the tokenizer file that counts them.
CAPACITY = 2_048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Ranks within one length are drawn up in so many independent parts.
RANK_PARTS = 256
#: Texts encoded in one call.
TEXTS_AT_ONCE = 64
#: Words whose numbers of tokens a task remembers; then it begins anew. Longer words are not remembered.
WORDS_KNOWN, LONG_WORD = 200_000, 64

# A byte-level tokenizer's words: no token crosses their borders.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
# Other characters may be letters in one version of Unicode only.
_UNSURE = re.compile("[^\0-\u052F\u2000-\u205E\u20A0-\u20B8\u2100-\u218A\u2190-\u23FA\u2460-\u2B4C\u3000-\u303F\u3041-\u3096\u3099-\u30FF\u4E00-\u9FCC\uAC00-\uD7A3\uFEFF\uFF01-\uFF5E\uFFFD\U0001F300-\U0001F64F]")


def counter(tokenizer: str) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of texts.

    Where the file's tokenizer splits texts into words first, and encodes each by
    itself, a word that was met before is not encoded again. Texts with characters
    that are seldom met, and other tokenizers, are encoded whole.
    """
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True

    def whole(texts: list[str]) -> list[int]:
        # Encodings are some twenty times their text: few at once.
        parts = (texts[i : i + TEXTS_AT_ONCE] for i in range(0, len(texts), TEXTS_AT_ONCE))
        return [len(e) for p in parts for e in t.encode_batch_fast(p, add_special_tokens=False)]

    spec = json.loads(Path(tokenizer).read_text())
    split = spec.get("pre_tokenizer") or {}
    by_words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    by_words = by_words and spec.get("normalizer") is None and spec["model"].get("type") == "BPE" and all(a.get("special") for a in spec.get("added_tokens") or []) and not spec.get("truncation") and not spec.get("padding")
    try:
        import regex
    except ImportError:
        return whole
    if not by_words:
        return whole
    words = regex.compile(_WORD).findall

    class Known(dict):
        def __missing__(self, word: str) -> int:
            n = len(t.encode(word, add_special_tokens=False))
            if len(word) <= LONG_WORD:
                self[word] = n
            return n

    known = Known()

    def count(texts: list[str]) -> list[int]:
        out = []
        for x in texts:
            if not x.isascii() and _UNSURE.search(x):
                out += whole([x])
                continue
            out.append(sum(map(known.__getitem__, words(x))))
            if len(known) > WORDS_KNOWN:
                known.clear()
        return out

    return count


def token_counts(documents: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, tokens`` of every text that is not blank, by a public tokenizer's ``tokenizers`` JSON file.

    Special tokens written in a text are ordinary text. Null and blank texts give no row.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokens = counter(tokenizer)
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "tokens": tokens(b["text"].tolist())})

    have = documents.where(F.col(text).rlike("[^\\s\\p{Z}\\p{C}]")).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(have.dtypes)["key"]
    return have.mapInPandas(count, f"key {kind}, tokens bigint").withColumnRenamed("key", key)


def plan_containers(histogram: list[tuple[int, int]], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit-decreasing over ``(length, count)``: ``(copies, [(length, items), …])`` per kind of container.

    Lengths are at most ``capacity``. Each step fills one container, longest
    length first, closing it with one or two lengths that fill it to the last
    token where there are any, and repeats it as often as the counts allow.
    A step uses up at least one length's count, so there are far fewer steps
    than texts.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram:
        left[length] += n
    plan: list[tuple[int, list[tuple[int, int]]]] = []
    top = capacity
    while True:
        while top > 0 and not left[top]:
            top -= 1
        if top == 0:
            return plan
        free = left.copy()
        pattern: dict[int, int] = {}
        room = capacity
        sizes: tuple[int, ...] = (top,)
        while sizes:
            for size in sizes:
                free[size] -= 1
                pattern[size] = pattern.get(size, 0) + 1
                room -= size
            sizes = _next_sizes(free, room)
        copies = min(int(left[s]) // k for s, k in pattern.items())
        assert copies >= 1, "a pattern holds more than there is"
        for s, k in pattern.items():
            left[s] -= copies * k
        plan.append((copies, sorted(pattern.items(), reverse=True)))


def _next_sizes(free: np.ndarray, room: int) -> tuple[int, ...]:
    """What goes into the room next: lengths that fill it exactly, else the longest that fits, else nothing."""
    if room <= 0:
        return ()
    if free[room]:
        return (room,)
    fits = np.flatnonzero(free[1:room])
    if not len(fits):
        return ()
    low = np.arange(1, room // 2 + 1)
    both = (free[low] > 0) & (free[room - low] > 0) & ((low * 2 != room) | (free[low] > 1))
    hit = np.flatnonzero(both)
    # The most uneven pair: it uses up the longest length.
    return (int(room - low[hit[0]]), int(low[hit[0]])) if len(hit) else (int(fits[-1]) + 1,)


def pack(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "tokens") -> DataFrame:
    """``key, size, container_id, piece, piece_tokens``: the container of every item.

    An item longer than the capacity is split: its full pieces fill containers of
    their own (``piece`` 0, 1, …) and its rest is packed like any other item; no
    other item is split. Items of null, zero or negative size are left out. Equal
    keys are separate items. Container ids are dense from 0 per run. An empty
    table gives no rows.
    """
    spark = sizes.sparkSession
    rows = sizes.where(F.col(size) > 0).select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("n"))
    # Read several times: counting tokens is dear, so it is done once.
    rows = write_table(rows, scratch(spark, "sizes"))
    full = F.floor(F.col("n") / capacity)
    rest = rows.withColumn("full", full).withColumn("rest", F.col("n") - F.col("full") * capacity)

    # Ranks within a length: parts are counted first, so no length is gathered in one task.
    part = F.pmod(F.xxhash64("key"), F.lit(RANK_PARTS))
    items = rest.where("rest > 0").withColumn("part", part)
    counts = items.groupBy("rest", "part").agg(F.count("*").alias("items"))
    # capacity x RANK_PARTS rows at most.
    starts = counts.withColumn("start", F.sum("items").over(W.partitionBy("rest").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    histogram = [(int(r[0]), int(r[1])) for r in counts.groupBy("rest").agg(F.sum("items")).collect()]
    plan = plan_containers(histogram, capacity)

    # The plan as ranges of ranks: rank r of length l takes container first + (r - from) // per.
    slots, used, first = [], {}, 0
    for copies, pattern in plan:
        for length, per in pattern:
            begin = used.get(length, 0)
            slots.append((length, begin, begin + copies * per, per, first))
            used[length] = begin + copies * per
        first += copies
    slot_rows = spark.createDataFrame(slots, "length bigint, lo bigint, hi bigint, per bigint, first bigint") if slots else spark.createDataFrame([], "length bigint, lo bigint, hi bigint, per bigint, first bigint")
    # One row per length with its ranges in order; at most capacity rows.
    table = slot_rows.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "per", "first"))).alias("ranges"))
    ranked = items.join(starts.select("rest", "part", F.coalesce("start", F.lit(0)).alias("start")), ["rest", "part"])
    w = W.partitionBy("rest", "part").orderBy("key", "n")
    ranked = ranked.withColumn("rank", F.col("start") + F.row_number().over(w) - 1)
    placed = ranked.join(table, ranked["rest"] == table["length"])
    hit = F.filter("ranges", lambda r: (r["lo"] <= F.col("rank")) & (F.col("rank") < r["hi"]))[0]
    placed = placed.withColumn("r", hit).select("key", "n", (F.col("r.first") + F.floor((F.col("rank") - F.col("r.lo")) / F.col("r.per"))).cast("bigint").alias("container_id"), F.col("full").cast("int").alias("piece"), F.col("rest").alias("piece_tokens"))

    # Full pieces: containers after the planned ones, numbered by key's part and rank.
    long = rest.where("full > 0").withColumn("part", part)
    sums = long.groupBy("part").agg(F.sum("full").alias("s"))
    offsets = sums.withColumn("base", F.coalesce(F.sum("s").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = F.coalesce(F.sum("full").over(W.partitionBy("part").orderBy("key", "n").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    pieces = long.join(offsets.select("part", "base"), "part").withColumn("base", F.col("base") + before + first)
    pieces = pieces.select("key", "n", F.col("base"), F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1)).alias("piece"))
    pieces = pieces.select("key", "n", (F.col("base") + F.col("piece")).cast("bigint").alias("container_id"), "piece", F.lit(capacity).cast("bigint").alias("piece_tokens"))
    return placed.unionByName(pieces).withColumnsRenamed({"key": key, "n": size})


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """``containers, fewest, tokens, fill``: the containers used, the fewest that could hold the tokens, and the share of space used."""
    per = packed.groupBy("container_id").agg(F.sum("piece_tokens").alias("tokens"))
    total = per.agg(F.count("*").alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return total.select("containers", F.ceil(F.col("tokens") / capacity).alias("fewest"), "tokens", (F.col("tokens") / (F.col("containers") * capacity)).alias("fill"))
