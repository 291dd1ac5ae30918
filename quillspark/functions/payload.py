"""Decoding of stored API answers: wrappings, marks and cut bodies."""

from __future__ import annotations

import json

CONTAINERS = ("results", "data", "organic_results", "articles")
_DEPTH = 6


def decode_body(body: str | None) -> dict | None:
    """The answer's outermost object that has an item container, or None.

    A byte-order mark, an answer stored as a JSON string and wrapping objects or
    arrays are taken off. ``NaN`` is accepted. A body cut short decodes to None.
    """
    if body is None:
        return None
    value: object = body
    for _ in range(_DEPTH):
        if not isinstance(value, str):
            break
        try:
            value = json.loads(value.strip().lstrip("﻿"), strict=False)
        except (ValueError, RecursionError):
            return None
    return _find(value, _DEPTH)


def _find(value: object, depth: int) -> dict | None:
    if depth == 0:
        return None
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except (ValueError, RecursionError):
            return None
    if isinstance(value, dict):
        if any(c in value for c in CONTAINERS):
            return value
        inner = value.values()
    elif isinstance(value, list):
        inner = value
    else:
        return None
    for v in inner:
        if isinstance(v, (dict, list)) or isinstance(v, str) and v[:1] in "{[":
            if (found := _find(v, depth - 1)) is not None:
                return found
    return None
