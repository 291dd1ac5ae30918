"""Scores of pages, and the scorecard of models by dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text_quality import citation_groups, cjk_present, dup_pct, hyphen_artifacts

# Which way a dimension is better.
HIGHER = ("teds", "citation_groups")
LOWER = ("dup_pct", "hyphen_artifacts", "text_edit_distance", "latency")
GAP = "—"


def score_pages(pages: DataFrame, text: str = "content") -> DataFrame:
    """``pages`` with ``dup_pct, hyphen_artifacts, citation_groups, cjk_present``; a null text scores null."""
    t = F.col(text)
    return pages.withColumns({"dup_pct": F.when(t.isNotNull(), dup_pct(t)), "hyphen_artifacts": hyphen_artifacts(t), "citation_groups": citation_groups(t), "cjk_present": cjk_present(t)})


def long_scores(scores: DataFrame, dims: dict[str, str]) -> DataFrame:
    """``model, dim, kind, num, txt``: one row per measurement; ``dims`` maps a column to its kind (int, float or text)."""
    each = [
        F.struct(F.lit(d).alias("dim"), F.lit(k).alias("kind"), (F.col(d).cast("double") if k != "text" else F.lit(None).cast("double")).alias("num"), (F.initcap(F.col(d).cast("string")) if k == "text" else F.lit(None).cast("string")).alias("txt"))
        for d, k in dims.items()
    ]
    return scores.select("model", F.inline(F.array(*each)))


def aggregate_scores(long: DataFrame) -> DataFrame:
    """``model, dim, num, txt``: median of whole numbers, mean of others, else the most frequent text (the lowest of a tie).

    The kind is that of the values: nulls and numbers that are not finite do not count.
    """
    fine = F.col("num").isNotNull() & ~F.isnan("num") & (F.abs("num") != float("inf"))
    num, txt = F.when(fine, F.col("num")), F.col("txt")
    per = long.groupBy("model", "dim").agg(
        F.count(num).alias("n"), F.count(txt).alias("t"), F.count_if(fine & (F.col("kind") == "int")).alias("whole"),
        F.median(num).alias("median"), F.avg(num).alias("mean"), F.mode(txt, True).alias("top"),
    )
    value = F.when((F.col("t") == 0) & (F.col("n") > 0), F.when(F.col("whole") == F.col("n"), F.col("median")).otherwise(F.col("mean")))
    return per.select("model", "dim", value.alias("num"), F.when((F.col("n") == 0) & (F.col("t") > 0), F.col("top")).alias("txt"))


def leaders(cells: DataFrame) -> DataFrame:
    """``dim, model``: the one model that is best in a dimension; none on a tie."""
    sign = F.when(F.col("dim").isin(*HIGHER), 1.0).when(F.col("dim").isin(*LOWER), -1.0)
    c = cells.where("num IS NOT NULL").withColumn("good", F.col("num") * sign).where("good IS NOT NULL")
    best = c.groupBy("dim").agg(F.max("good").alias("good"))
    return c.join(best, ["dim", "good"]).groupBy("dim").agg(F.count("*").alias("n"), F.min("model").alias("model")).where("n = 1").select("dim", "model")


def verdicts(cells: DataFrame) -> DataFrame:
    """``model, leads``: the dimensions a model leads, in order, or ``none``."""
    led = leaders(cells).groupBy("model").agg(F.array_join(F.array_sort(F.collect_list("dim")), ", ").alias("leads"))
    return cells.select("model").distinct().join(led, "model", "left").select("model", F.coalesce("leads", F.lit("none")).alias("leads"))


def pivot_scores(cells: DataFrame, dims: list[str]) -> DataFrame:
    """One row per model, one column per dimension; null where nothing was measured."""
    cell = F.coalesce(F.col("num").cast("string"), "txt")
    return cells.groupBy("model").pivot("dim", sorted(dims)).agg(F.first(cell))


def composite_accuracy(teds: Column, distance: Column) -> Column:
    return (teds + (1 - distance)) / 2


def render_markdown(cells: DataFrame) -> str:
    """The scorecard as a table of text: models by dimensions, both sorted. Cells are one per model and dimension."""
    got = {(r.model, r.dim): format(round(r.num, 4), "g") if r.num is not None else r.txt or GAP for r in cells.collect()}
    models, dims = sorted({m for m, _ in got}), sorted({d for _, d in got})
    rows = [["model", *dims], ["---"] * (len(dims) + 1), *([m, *(got.get((m, d), GAP) for d in dims)] for m in models)]
    return "\n".join("| " + " | ".join(r) + " |" for r in rows) + "\n"
