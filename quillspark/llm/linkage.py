"""Incremental linkage of arriving records against persisted sorted runs.

State, in the cluster's shared folder, named by a manifest that each delivery
replaces as its last step, so a later session can go on with it
(``SortedRuns(spark, path)``):

* ``runs``: one row per node ever seen, ``(block, spelling, root)``, partitioned by
  key range and sorted by ``(block, spelling)`` within. A delivery appends one sorted
  run; every ``COMPACT_EVERY`` deliveries the runs are merged into one. Ranges are
  of the block's hash: a venue's neighbouring identifiers are spread, so no range
  is hot.
* ``moves``: roots that a later record joined to a smaller one.

A delivery is one batch, or batches that already wait. It reads no earlier
record and only the key ranges it touches: its distinct nodes meet each other and
the runs by block, where every two spellings are compared, so that results do not
depend on how rows fall into batches. What it finds are edges (node to known
root, node to node) with the moment they came to exist. Labels of nodes over time
are then relaxed to a fixpoint, one job a round, only over nodes that have an
edge: ``(label, since)`` pairs, of which only those that lower the label are kept.
A record's first record is its nodes' smallest label at its own arrival.

A hot identity is one node: its copies are folded by ``groupBy`` with partial
aggregation before anything else happens, so nothing is ever collected per group.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.identity import MAX_SPELLING, node_rows, record_identities
from quillspark.runtime import scratch, write_table

#: Deliveries after which runs are merged, and batches that make one delivery if they wait together.
COMPACT_EVERY = 8
#: Key ranges of the runs; a delivery that touches few of them reads only those.
RANGES = 16

_TIES = """
SELECT concat_ws('|', d_block, d_spelling) AS a, concat(s_block, '|') AS b, min(cand_id) AS at
FROM {keyed} WHERE d_block IS NOT NULL AND s_block IS NOT NULL GROUP BY 1, 2
"""

# Nodes are named after the joins: their names would be shuffled beside what they are made of.
_WITHIN = """
SELECT concat_ws('|', n.block, n.spelling) AS a, concat_ws('|', p.block, p.spelling) AS b, greatest(n.born, p.born) AS at
FROM {nodes} n JOIN {nodes} p ON n.block = p.block AND n.spelling > p.spelling AND levenshtein(n.spelling, p.spelling, {near}) >= 0
WHERE startswith(n.block, 'd:')
"""

_HITS = """
SELECT concat_ws('|', n.block, n.spelling) AS node, n.born, r.spelling = n.spelling AS known, r.root
FROM {runs} r JOIN {nodes} n ON r.range = n.range AND r.block = n.block AND levenshtein(n.spelling, r.spelling, {near}) >= 0
"""

# Both ways, with the first label of the far end: most offers to a hot node end there.
_EDGES = """
WITH both AS (SELECT inline(array(struct(a, b, at), struct(b AS a, a AS b, at))) FROM {within})
SELECT a, b, at, born AS b_label, born AS b_since FROM both JOIN {nodes} ON b = node
"""
_ROOT_EDGES = """
SELECT node AS a, concat('r:', root) AS b, born AS at, root AS b_label, -1L AS b_since FROM {hits}
UNION ALL
SELECT concat('r:', root), node, born, born, born FROM {hits}
"""

# One round: new pairs cross the edges of their node. Of each node's pairs those that lower its label over time are kept.
_ROUND = """
SELECT node, label, since, fresh FROM (
  SELECT *, min(label) OVER (PARTITION BY node ORDER BY since, label, fresh ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low
  FROM (
    SELECT node, label, since, 0 AS fresh FROM {pairs}
    UNION ALL
    SELECT node, label, min(since), 1 FROM (
      SELECT b AS node, label, greatest(since, at) AS since FROM {pairs} JOIN {edges} ON node = a
      WHERE fresh = 1 AND (label < b_label OR greatest(since, at) < b_since)
    ) GROUP BY node, label
  )
) WHERE low IS NULL OR label < low
"""


class SortedRuns:
    """The persisted linkage state of one collection."""

    def __init__(self, spark: SparkSession, path: str | None = None, ranges: int = RANGES):
        self.spark = spark
        self.dir = path or scratch(spark, "linkage")
        self.state = {"seq": 0, "ranges": ranges, "runs": [], "moves": [], "found": []}
        if path:
            last = spark.read.schema("seq bigint, state string").json(f"{path}/manifest").orderBy(F.desc("seq")).limit(1).collect()
            self.state = json.loads(last[0].state)

    def _path(self, what: str) -> str:
        return f"{self.dir}/{what}-{self.state['seq']}"

    def _write(self, df: DataFrame, what: str) -> DataFrame:
        return write_table(df, self._path(what))

    def _commit(self) -> None:
        """What a delivery wrote counts from here on."""
        self.state["seq"] += 1
        row = [(self.state["seq"], json.dumps(self.state))]
        self.spark.createDataFrame(row, "seq bigint, state string").coalesce(1).write.mode("append").json(f"{self.dir}/manifest")

    def _moved(self) -> DataFrame | None:
        if not self.state["moves"]:
            return None
        return self.spark.read.schema("root bigint, target bigint").parquet(*self.state["moves"]).groupBy("root").agg(F.min("target").alias("target"))

    def _range(self) -> F.Column:
        return F.pmod(F.xxhash64("block"), F.lit(self.state["ranges"])).cast("int")

    def runs(self, touched: list[int] | None = None) -> DataFrame:
        """All nodes, or those of some key ranges, with the roots they have now."""
        schema = "block string, spelling string, root bigint, range int"
        if not self.state["runs"]:
            return self.spark.createDataFrame([], schema)
        runs = None
        for path in self.state["runs"]:
            r = self.spark.read.schema(schema).parquet(path)
            runs = r if runs is None else runs.unionByName(r)
        if touched is not None:
            runs = runs.where(F.col("range").isin(touched))
        moved = self._moved()
        if moved is None:
            return runs
        return runs.join(moved, "root", "left").select("block", "spelling", F.coalesce("target", "root").alias("root"), "range")

    def _write_run(self, rows: DataFrame, what: str) -> str:
        path = self._path(what)
        rows = rows.withColumn("range", self._range()).select("block", "spelling", "root", "range")
        # One task writes whole ranges, each sorted.
        rows.repartition("range").sortWithinPartitions("range", "block", "spelling").write.partitionBy("range").mode("overwrite").parquet(path)
        return path

    def compact(self) -> None:
        """Merge all runs into one with current roots, and forget the moves."""
        self.state["runs"], self.state["moves"] = [self._write_run(self.runs().select("block", "spelling", "root"), "merged")], []
        self._commit()

    def ingest(self, records: DataFrame) -> DataFrame:
        """Check one delivery against the runs and add it to them; the repeats in it are returned, and kept for ``found``."""
        spark, first = self.spark, not self.state["runs"]
        keyed = self._write(record_identities(records), "keyed")
        nodes = node_rows(keyed).groupBy("block", "spelling").agg(F.min("cand_id").alias("born"))
        nodes = self._write(nodes.select(F.concat_ws("|", "block", "spelling").alias("node"), "block", "spelling", "born", self._range().alias("range")), "nodes")
        within = spark.sql(_TIES, keyed=keyed).unionByName(spark.sql(_WITHIN, nodes=nodes, near=MAX_SPELLING))
        edges = spark.sql(_EDGES, within=within, nodes=nodes)
        start = None
        if not first:
            # At most as many numbers as there are ranges.
            touched = sorted(r[0] for r in nodes.select("range").distinct().collect())
            hits = self._write(spark.sql(_HITS, runs=self.runs(touched), nodes=nodes, near=MAX_SPELLING), "hits")
            edges = edges.unionByName(spark.sql(_ROOT_EDGES, hits=hits))
            start = hits.selectExpr("concat('r:', root) AS node", "root AS label", "-1L AS since").distinct()
        edges = self._write(edges, "edges")

        linked = edges.selectExpr("a AS node").distinct()
        own = nodes.join(linked, "node").selectExpr("node", "born AS label", "born AS since")
        pairs, moves = self._fixpoint(own if start is None else own.unionByName(start), edges)
        alone = nodes.join(linked, "node", "left_anti").selectExpr("node", "born AS label", "born AS since")
        labels = alone.unionByName(pairs.select("node", "label", "since"))

        # The delivery's run and the moves of roots that it joined.
        new = labels.where("NOT startswith(node, 'r:')").groupBy("node").agg(F.min("label").alias("root"))
        if not first:
            new = new.join(hits.where("known").select("node").distinct(), "node", "left_anti")
        # A spelling is letters only, a block may have any sign.
        run = self._write_run(new.selectExpr("substring_index(node, '|', -1) AS spelling", "root", "node").selectExpr("left(node, length(node) - length(spelling) - 1) AS block", "spelling", "root"), "run")
        # Copies of a hot node meet its few pairs; nothing is gathered per group.
        at = node_rows(keyed).select("cand_id", "node").join(labels, "node").where("since <= cand_id")
        found = at.groupBy("cand_id").agg(F.min("label").alias("first_cand_id")).where("first_cand_id < cand_id")
        found = self._write(found.select("first_cand_id", "cand_id"), "found")
        self.state["found"].append(self._path("found"))
        if moves:
            roots = pairs.where("startswith(node, 'r:')").selectExpr("cast(substring(node, 3) AS bigint) AS root", "label").groupBy("root").agg(F.min("label").alias("target")).where("target < root")
            if (moved := self._moved()) is not None:
                onward = moved.selectExpr("root AS source", "target AS root").join(roots, "root").selectExpr("source AS root", "target")
                roots = roots.unionByName(onward)
            self._write(roots, "moves")
            self.state["moves"].append(self._path("moves"))
        self.state["runs"].append(run)
        self._commit()
        if len(self.state["runs"]) > COMPACT_EVERY:
            self.compact()
        return found

    def _fixpoint(self, start: DataFrame, edges: DataFrame) -> tuple[DataFrame, bool]:
        """Relax until a round brings nothing: the pairs, and whether a known root moved."""
        pairs, i = start.withColumn("fresh", F.lit(1)), 0
        while True:
            seen = Observation()
            moved = F.expr("count_if(startswith(node, 'r:') AND label < try_cast(substring(node, 3) AS bigint))")
            step = self.spark.sql(_ROUND, pairs=pairs, edges=edges).observe(seen, F.sum("fresh").alias("fresh"), moved.alias("moved"))
            pairs = self._write(step, f"labels{i}")
            if not seen.get["fresh"]:
                return pairs, bool(seen.get["moved"])
            i += 1

    def found(self) -> DataFrame:
        """``first_cand_id, cand_id`` of all repeats so far."""
        return self.spark.read.schema("first_cand_id bigint, cand_id bigint").parquet(*self.state["found"])


def repeats_on_arrival(candidates: DataFrame) -> DataFrame:
    """``first_cand_id, cand_id``: rows that repeat an earlier row when they arrive.

    Rows arrive by ``(batch_id, cand_id)``, with ``cand_id`` growing in that order.
    The first batch is the history; those after it wait, and are delivered by up to
    ``COMPACT_EVERY``, each delivery against the runs of the earlier ones. Rows
    without any usable identity, or with a null ``cand_id``, are never repeats; a
    null ``batch_id`` arrives with the first batch. An empty table gives no rows.
    Other columns are not read.
    """
    spark = candidates.sparkSession
    rows = candidates.select("cand_id", F.coalesce("batch_id", F.lit(0)).alias("batch_id"), "doi", "source", "source_id")
    batches = sorted(r[0] for r in rows.select("batch_id").distinct().collect())
    if not batches:
        return spark.createDataFrame([], "first_cand_id bigint, cand_id bigint")
    state = SortedRuns(spark)
    for some in [batches[:1], *(batches[i : i + COMPACT_EVERY] for i in range(1, len(batches), COMPACT_EVERY))]:
        state.ingest(rows.where(F.col("batch_id").isin(some)))
    return state.found()


def final_groups(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cand_id, first_cand_id`` of every row with an identity, once all rows are in, and the rows' ``record_identities``."""
    state = SortedRuns(candidates.sparkSession)
    state.ingest(candidates.select("cand_id", "doi", "source", "source_id"))
    keyed = candidates.sparkSession.read.parquet(f"{state.dir}/keyed-0")
    rows = node_rows(keyed).select("cand_id", "block", "spelling")
    return rows.join(state.runs(), ["block", "spelling"]).groupBy("cand_id").agg(F.min("root").alias("first_cand_id")), keyed
