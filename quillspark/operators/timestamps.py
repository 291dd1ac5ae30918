"""Mixed date and time writings to one unambiguous form."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.dates import clock_reading, parse_written
from quillspark.operators.nested import ChildPath, flatten_payloads

#: Zones tried for a source that states none, in order of preference on a tie.
CANDIDATE_ZONES = (
    "UTC", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Sao_Paulo", "Europe/London",
    "Europe/Berlin", "Europe/Helsinki", "Europe/Moscow", "Asia/Kolkata", "Asia/Shanghai", "Asia/Tokyo", "Australia/Sydney",
)

#: Readings further than this from their ingestion, in seconds, are no evidence of a zone's offset.
NEAR = 2 * 86_400
#: Seconds that a reading may lie after its ingestion.
SKEW = 300
#: Seconds by which a zone must fit better than the first one.
MIN_GAIN = 43_200

DATED = {
    "openalex": ChildPath("openalex", "results", None, ("publication_date",)),
    "s2": ChildPath("s2", "data", None, ("publicationDate",)),
    "scholar-author": ChildPath("scholar-author", "articles", None, ("year",)),
}

_PARSED = T.StructType([T.StructField("grain", T.StringType()), T.StructField("norm", T.StringType())])


@F.pandas_udf(_PARSED)
def _parse(value: pd.Series, zone: pd.Series, month_first: pd.Series) -> pd.DataFrame:
    seen: dict = {}
    out = []
    for key in zip(value, zone, month_first):
        if key not in seen:
            seen[key] = parse_written(key[0], key[1] if isinstance(key[1], str) else None, bool(key[2])) or (None, None)
        out.append(seen[key])
    return pd.DataFrame(out, columns=["grain", "norm"])


def estimate_zones(readings: DataFrame, zones: tuple[str, ...] = CANDIDATE_ZONES) -> DataFrame:
    """``source, home_tz``: the offset history that fits a source's own readings best.

    ``readings`` has ``source, value, ingested_at`` and may have ``month_first``. A
    reading costs a zone a day if that zone's clock never showed it (a
    daylight-saving gap) or if it would lie after the row's ingestion, and else
    its lag behind the ingestion, up to a day: too far east costs as well as too
    far west. Readings more than ``NEAR`` from ingestion say nothing of the zone
    but for gaps. Costs are summed per batch before the shuffle, so a source with
    a third of all rows costs no more than another. The first zone keeps a source
    unless another costs at least ``MIN_GAIN`` less; other ties go to the earlier
    zone. Sources without any reading get no row.
    """
    day = 86_400

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [(i, ZoneInfo(z)) for i, z in enumerate(zones)]
        for b in batches:
            tally: dict = {}
            for source, value, at, month_first in zip(b["source"], b["value"], b["ingested_at"], b["month_first"]):
                local = clock_reading(value, bool(month_first))
                if local is None:
                    continue
                near = not pd.isna(at) and abs(local.replace(tzinfo=timezone.utc).timestamp() - at) <= NEAR
                for i, z in known:
                    there = local.replace(tzinfo=z).astimezone(timezone.utc)
                    gap = there.astimezone(z).replace(tzinfo=None) != local
                    lag = at - there.timestamp() if near else 0
                    # A clock that is a little fast is not late.
                    cost = day * gap + (day if lag < -SKEW else min(abs(lag), day))
                    tally[source, i] = tally.get((source, i), 0) + int(cost)
            if tally:
                yield pd.DataFrame([(s, i, v) for (s, i), v in tally.items()], columns=["source", "rank", "cost"])

    rows = readings.where(F.col("value").isNotNull() & F.col("source").isNotNull())
    order = F.coalesce("month_first", F.lit(False)) if "month_first" in readings.columns else F.lit(False)
    rows = rows.select("source", "value", F.col("ingested_at").cast("double").alias("ingested_at"), order.alias("month_first"))
    tallied = rows.mapInPandas(count, "source string, rank int, cost bigint").groupBy("source", "rank").agg(F.sum("cost").alias("cost"))
    first = F.when(F.col("rank") == 0, F.lit(MIN_GAIN)).otherwise(0)
    best = tallied.groupBy("source").agg(F.min_by("rank", F.struct(F.col("cost") - first, "rank")).alias("rank"))
    names = F.array(*[F.lit(z) for z in zones])
    return best.select("source", F.element_at(names, F.col("rank") + 1).alias("home_tz"))


def normalise_written(values: DataFrame, feeds: DataFrame) -> DataFrame:
    """``values`` with ``grain`` and ``norm``; rows that name no possible time are left out.

    ``values`` has ``source, value, ingested_at`` and any other columns; ``feeds``
    has ``source, home_tz, date_order``. A source's stated zone is used where
    feeds gives one; for sources without one it is estimated from their own
    readings (``estimate_zones``). Slash dates of a source whose order is unknown
    are read day first. Null and blank values and a null source's clock readings
    without a zone give no row. A source listed twice in feeds takes its smallest
    zone and order. A reading in a repeated hour takes the earlier offset.
    """
    f = feeds.where(F.col("source").isNotNull()).groupBy("source").agg(F.min("home_tz").alias("home_tz"), F.min("date_order").alias("date_order"))
    unknown = values.select("source").where(F.col("source").isNotNull()).join(f.where(F.col("home_tz").isNotNull()), "source", "left_anti")
    if not unknown.isEmpty():
        missing = values.join(f.where(F.col("home_tz").isNotNull()), "source", "left_anti")
        orders = f.select("source", (F.lower("date_order") == "mdy").alias("month_first"))
        guess = estimate_zones(missing.join(orders, "source", "left")).withColumnRenamed("home_tz", "guess_tz")
        f = f.join(guess, "source", "full_outer").select("source", F.coalesce("home_tz", "guess_tz").alias("home_tz"), "date_order")
    v = values.where(F.col("value").isNotNull())
    zone = f.select(F.col("source").alias("__source"), F.col("home_tz").alias("__tz"), (F.lower("date_order") == "mdy").alias("__mdy"))
    joined = v.join(zone, v["source"].eqNullSafe(zone["__source"]), "left")
    parsed = joined.withColumn("__p", _parse("value", "__tz", F.coalesce("__mdy", F.lit(False))))
    return parsed.where(F.col("__p.norm").isNotNull()).select(*[v[c] for c in v.columns], F.col("__p.grain").alias("grain"), F.col("__p.norm").alias("norm"))


def written_dates(candidates: DataFrame, payloads: DataFrame) -> DataFrame:
    """``origin, row_id, item_pos, source, value, ingested_at`` of every written date."""
    a = candidates.select(
        F.lit("candidates").alias("origin"), F.col("cand_id").cast("bigint").alias("row_id"), F.lit(0).alias("item_pos"),
        "source", F.col("published").alias("value"), F.col("fetched_at").cast("timestamp").alias("ingested_at"),
    )
    # One pass: an item's container says which source's dates it holds.
    dated = flatten_payloads(payloads.where(F.col("source").isin(*DATED)), tuple(DATED.values()), text_only=False, keep=("fetched_at",))
    b = dated.select(
        F.lit("payloads").alias("origin"), F.col("payload_id").alias("row_id"), "item_pos",
        F.col("field").alias("source"), "value", F.col("fetched_at").cast("timestamp").alias("ingested_at"),
    )
    return a.unionByName(b)
