"""Operator results and audit rows.

The relational operators and tolerant scans return an ``OpResult``: the rows they
kept and one audit row for each row they dropped or could not process.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_SCHEMA = "ord bigint, stage string, event string, url string, reason string, attrs map<string,string>"


@dataclass(frozen=True)
class OpResult:
    kept: DataFrame
    audit: DataFrame


def audit_rows(
    df: DataFrame,
    stage: str,
    reason: Column | str | None,
    event: str | None = None,
    ord: Column | None = None,
    url: Column | None = None,
    **attrs: Column,
) -> DataFrame:
    """Rows of ``df`` as audit rows of one stage; ``attrs`` become a string map."""
    null = F.lit(None).cast("string")
    pairs = [x for k, v in attrs.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        (ord if ord is not None else F.lit(None)).cast("bigint").alias("ord"),
        F.lit(stage).alias("stage"),
        (F.lit(event) if event else null).alias("event"),
        (url if url is not None else null).cast("string").alias("url"),
        (F.lit(reason) if isinstance(reason, str) else reason if reason is not None else null).alias("reason"),
        (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<string,string>").alias("attrs"),
    )


def union_audits(*audits: DataFrame) -> DataFrame:
    out = audits[0]
    for a in audits[1:]:
        out = out.unionByName(a)
    return out


def append_audit(audit: DataFrame, path: str, fmt: str = "json") -> None:
    """Append audit rows to a log directory (one write for all stages of a job)."""
    audit.write.mode("append").format(fmt).save(path)
