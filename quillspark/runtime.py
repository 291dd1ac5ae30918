"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only where that is unset in local mode (tests) a temporary folder is used; on a cluster it is an error.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quillspark-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table written by one run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, **opts: str) -> DataFrame:
    df.write.options(**opts).mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
