"""Deeply nested answers to flat, linked tables, on Arrow buffers.

A stored answer is decoded once (its container may be wrapped, and a container
that should be an array may be one object). What follows is columnar: the decoded
lists become Arrow list arrays, parents are found from list offsets
(``list_parent_indices``), positions by subtracting the parent's offset, and the
keys are propagated with one vectorised ``take`` per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.payload import decode_body


@dataclass(frozen=True)
class ChildPath:
    """``container[].child[].leaf…`` of an answer; ``field`` names its rows.

    With ``child`` None the leaf hangs on the item itself.
    """

    field: str
    container: str
    child: str | None
    leaf: tuple[str, ...]


AUTHOR = ChildPath("author", "results", "authorships", ("author", "display_name"))
RESOURCE = ChildPath("resource", "organic_results", "resources", ("link",))
DOI = ChildPath("doi", "data", "externalIds", ("DOI",))

_ROW_BYTES = "payload_key bigint, item_pos int, field string, child_pos int, value string"
_CHILD_TYPE = pa.schema([("payload_key", pa.int64()), ("item_pos", pa.int32()), ("field", pa.string()), ("child_pos", pa.int32()), ("value", pa.string())])


def _as_list(x: object) -> list:
    return x if isinstance(x, list) else [x] if isinstance(x, dict) else []


def _leaf(x: object, path: tuple[str, ...], text_only: bool) -> str | None:
    for step in path:
        if not isinstance(x, dict):
            return None
        x = x.get(step)
    if isinstance(x, str):
        return x
    if text_only or isinstance(x, (dict, list, bool)) or x is None:
        return None
    return str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)


def _explode(keys: dict[str, pa.Array], lists: pa.Array, pos: str) -> tuple[dict[str, pa.Array], pa.Array]:
    """One level down: values of ``lists`` with their parents' keys and positions."""
    parent = pc.list_parent_indices(lists)
    values = pc.list_flatten(lists)
    starts = np.asarray(lists.offsets)[:-1]
    at = np.arange(len(values), dtype=np.int64) + int(starts[0] if len(starts) else 0) - starts[np.asarray(parent, dtype=np.int64)]
    down = {k: v.take(parent) for k, v in keys.items()}
    down[pos] = pa.array(at.astype(np.int32))
    return down, values


def flatten_batch(keys: pa.Array, decoded: list[dict | None], path: ChildPath, text_only: bool = True, kept: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    """Child rows of one batch of decoded answers; ``kept`` columns follow their answer down."""
    items = [_as_list(d.get(path.container)) if d else [] for d in decoded]
    if path.child is None:
        nested = [[[_leaf(i, path.leaf, text_only)] for i in row] for row in items]
    else:
        nested = [[[_leaf(c, path.leaf, text_only) for c in _as_list(i.get(path.child))] if isinstance(i, dict) else [] for i in row] for row in items]
    cols, level = _explode({"payload_key": keys} | (kept or {}), pa.array(nested, pa.list_(pa.list_(pa.string()))), "item_pos")
    cols, values = _explode(cols, level, "child_pos")
    keep = pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(values)), 0)
    schema = pa.schema([*_CHILD_TYPE, *[pa.field(k, v.type) for k, v in (kept or {}).items()]])
    out = pa.RecordBatch.from_arrays([cols["payload_key"], cols["item_pos"], pa.array([path.field] * len(values), pa.string()), cols["child_pos"], values, *[cols[k] for k in kept or {}]], schema=schema)
    return out.filter(pc.fill_null(keep, False))


def flatten_payloads(payloads: DataFrame, paths: tuple[ChildPath, ...] = (AUTHOR, RESOURCE, DOI), key: str = "payload_id", body: str = "body", text_only: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, item_pos, field, child_pos, value`` and the columns to ``keep``: one row per non-blank value.

    Positions are 0-based places in the arrays as they stand, null members
    counted; a container that is one object has position 0. Rows whose key is
    null are kept with a null key. Null, blank, cut or container-less bodies and
    answers without items give no rows; an answer stored twice gives its rows
    under each key; columns that are not kept are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            decoded = [decode_body(x) for x in b.column(1).to_pylist()]
            for p in paths:
                out = flatten_batch(b.column(0), decoded, p, text_only, {k: b.column(2 + i) for i, k in enumerate(keep)})
                if out.num_rows:
                    yield out

    # A decoded answer is some ten times its text: batches stay small enough for a worker.
    src = payloads.select(F.col(key).cast("bigint").alias("payload_key"), F.col(body).cast("string").alias("body"), *keep)
    types = {f.name: f.dataType.simpleString() for f in src.schema}
    return src.mapInArrow(run, ", ".join([_ROW_BYTES, *[f"{k} {types[k]}" for k in keep]])).withColumnRenamed("payload_key", key)


def payload_items(payloads: DataFrame, scalars: dict[str, tuple[ChildPath, ...]], key: str = "payload_id", body: str = "body") -> DataFrame:
    """The item table: one row per item and scalar column that has a value, long form.

    ``scalars`` maps a column name to the paths that may hold it. Numbers are
    written as text, whole floats without a fraction.
    """
    paths = tuple(ChildPath(name, p.container, None, p.leaf) for name, ps in scalars.items() for p in ps)
    return flatten_payloads(payloads, paths, key, body, text_only=False).drop("child_pos")
