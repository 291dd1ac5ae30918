"""Queries of the core data-preparation operators (nested answers, written dates)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.functions.payload import CONTAINERS
from quillspark.operators.nested import ChildPath, flatten_payloads, payload_items
from quillspark.operators.timestamps import normalise_written, written_dates
from quillspark.plans.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten_payloads(table(spark, sf_dir, "payloads"))
    return rows.select("payload_id", "item_pos", "field", "child_pos")


def p2_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child table with its values; it joins the items on ``payload_id, item_pos``."""
    return flatten_payloads(table(spark, sf_dir, "payloads"))


def p2_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item table, long form: the titles of the items that have one."""
    titles = tuple(ChildPath("title", c, None, ("title",)) for c in CONTAINERS)
    return payload_items(table(spark, sf_dir, "payloads"), {"title": titles})


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = written_dates(table(spark, sf_dir, "candidates"), table(spark, sf_dir, "payloads"))
    rows = normalise_written(values, table(spark, sf_dir, "feeds"))
    return rows.select("origin", "row_id", "item_pos", "grain", "norm")


QUERIES = {"p2_found": p2_found, "p2_children": p2_children, "p2_items": p2_items, "p3_found": p3_found}
ORACLES: dict[str, str] = {}
