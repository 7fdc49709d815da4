"""JSON and object literals embedded in page bodies."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's code with the job: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def json_between(body: Column, pattern: str) -> Column:
    """A payload whose end is marked by text (a tag, ``;``): plain regex, JVM-side."""
    return F.nullif(F.regexp_extract(body, pattern, 1), F.lit(""))


def after(body: Column, anchor: str) -> Column:
    """What follows the regex ``anchor``; null without it. JVM-side.

    ``from_json`` reads the first JSON value of a text and ignores the rest, so a
    typed read of an embedded payload needs no more than this.
    """
    return F.nullif(F.regexp_extract(body, f"(?s){anchor}(.*)", 1), F.lit(""))


def x_embedded_json(body: Column, anchor: str) -> Column:
    """The first JSON value after the regex ``anchor``, as its verbatim text.

    For payloads that only their own structure ends. Null when the anchor is
    missing or what follows is not JSON.
    """
    found = re.compile(anchor)

    @F.pandas_udf("string")
    def extract(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in bodies:
            yield texts.map(one)

    def one(text: str | None) -> str | None:
        at = found.search(text) if isinstance(text, str) else None
        if at is None:
            return None
        start = re.compile(r"\s*").match(text, at.end()).end()
        try:
            return text[start : json.JSONDecoder().raw_decode(text, start)[1]]
        except json.JSONDecodeError:
            return None

    return extract(body)


def x_js_literal(literal: Column) -> Column:
    """A JavaScript object literal to JSON by quoting its bare keys.

    Purely textual, so text that looks like a key inside a string is quoted too.
    """
    return F.regexp_replace(literal, r"([{,])([A-Za-z_][A-Za-z0-9_]*):", '$1"$2":')


def x_object_literal(body: Column, anchor: str) -> Column:
    """The balanced ``{…}`` after ``anchor``; quotes and escapes are honoured.

    One regex finds the brackets and the strings, so the balance is decided on
    tokens and never on characters inside a string.
    """
    token = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.S)
    found = re.compile(anchor)

    @F.pandas_udf("string")
    def extract(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in bodies:
            yield texts.map(one)

    def one(text: str | None) -> str | None:
        at = found.search(text) if isinstance(text, str) else None
        if at is None:
            return None
        start = depth = None
        for t in token.finditer(text, at.end()):
            mark = t.group()
            if mark == "{":
                start, depth = (t.start(), 1) if start is None else (start, depth + 1)
            elif mark == "}" and start is not None:
                depth -= 1
                if depth == 0:
                    return text[start : t.end()]
        return None

    return extract(body)


def json_skeleton(payload: Column) -> Column:
    """Fingerprint text of a JSON object: its top-level keys in source order."""
    return F.sha2(F.array_join(F.json_object_keys(payload), "\n"), 256)
