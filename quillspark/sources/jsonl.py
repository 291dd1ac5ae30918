"""Tolerant scans of line files: every line has its place, and what cannot be read is audited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.audit import OpResult, audit_rows

#: Characters of a line that an audit row quotes.
QUOTED = 500


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line``: the lines of each file, counted from 1, blank ones too."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r?\n").alias("lines"))
    return files.select("file", F.posexplode("lines").alias("pos", "line")).select("file", (F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def json_objects(lines: DataFrame, stage: str, audit: bool = True) -> OpResult:
    """``lines`` that hold a JSON object, with ``doc`` as a variant; others are audited by line number.

    Blank lines are skipped; ``audit=False`` skips malformed lines silently, too.
    """
    trimmed = F.regexp_replace("line", r"(?U)^\s+|\s+$", "")
    rows = lines.where(trimmed != "").withColumn("doc", F.try_parse_json(trimmed))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT")), F.lit(False))
    kept = rows.where(is_object)
    lost = rows.where(~is_object)
    if not audit:
        lost = lost.where("false")
    why = F.concat(F.when(F.col("doc").isNull(), "unparseable").otherwise("non-object"), F.lit(" candidate line "), F.col("line_no"))
    return OpResult(kept, audit_rows(lost, stage, why, ord=F.col("line_no"), raw=F.left(F.col("line"), F.lit(QUOTED))))


def string_field(doc: Column, name: str) -> Column:
    """A field of a variant if it is a string, else null."""
    return F.when(F.schema_of_variant(F.try_variant_get(doc, f"$.{name}", "variant")) == "STRING", F.try_variant_get(doc, f"$.{name}", "string"))


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """``ord, input``: the trimmed lines that are not blank."""
    rows = numbered_lines(spark, path).select(F.col("line_no").alias("ord"), F.regexp_replace("line", r"(?U)^\s+|\s+$", "").alias("input"))
    return rows.where("input <> ''")
