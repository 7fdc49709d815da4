"""Row, response and query identities."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\u001f"
NULL_TOKEN = "\u0000"


def canonical_map(m: Column) -> Column:
    """A map as key-sorted JSON text: comparable, hashable, fit for set operations."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def hash_row(*columns: Column) -> Column:
    """SHA-256 of normalised values; a null is a token, so columns cannot shift."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def hash_response(body: Column) -> Column:
    return F.sha2(body, 256)


def canonical_json(payload: Mapping) -> str:
    """Key-sorted compact ASCII JSON, the text a query identity is taken from."""
    return json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def hash_query(payload: Mapping) -> str:
    """16 hex digits naming a query, independent of key order."""
    return hashlib.sha256(canonical_json(payload).encode("utf-8")).hexdigest()[:16]


def hash_query_rows(columns: Iterable[Column]) -> Column:
    """The same identity for queries held as rows: sorted-key struct to JSON."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 16)
