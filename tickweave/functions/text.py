"""Symbols, slugs, labels, URLs and redaction as Catalyst expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chart timeframe names and their codes.
CHART_TIMEFRAMES = {
    "1d": "d",
    "5d": "w",
    "1m": "m1",
    "3m": "m3",
    "6m": "m6",
    "1y": "y",
    "2y": "y2",
    "3y": "y3",
    "5y": "y5",
    "10y": "y10",
}
# forex/crypto chart timeframes and their codes.
MARKET_TIMEFRAMES = {"5m": "m5", "1h": "h1", "d": "d", "w": "w", "m": "mo"}

SLUG = r"\A[a-z0-9]+(?:-[a-z0-9]+)*\z"
SLUG_MAX = {"publisher": 64, "fund": 128, "manager": 128, "release": 128}
TICKER = r"\A[A-Z][A-Z0-9.\-]{0,9}\z"
SYMBOL = r"\A[A-Z0-9]+(?:[-./][A-Z0-9]+)*\z"

# ---------------------------------------------------------------- labels


def label_to_field(label: str) -> str:
    """Header label to a snake_case column name: ``P/E`` to ``p_per_e``."""
    words = {"/": " per ", "%": " percent", "+": " plus ", "-": " ", ".": "", "(": " ", ")": " "}
    spelled = label.translate(str.maketrans(words)).lower()
    return re.sub(r"[\s_]+", "_", spelled.strip()).strip("_") or "column"


def label_to_field_column(c: Column) -> Column:
    """The same rule over a column of labels."""
    for mark, word in (("/", " per "), ("%", " percent"), ("+", " plus "), (".", "")):
        c = F.replace(c, F.lit(mark), F.lit(word))
    c = F.lower(F.translate(c, "-()", "   "))
    c = F.btrim(F.regexp_replace(c, r"[\s_]+", "_"), F.lit("_"))
    return F.when(c == "", F.lit("column")).otherwise(c)


# ---------------------------------------------------------------- symbols


def strip_space(c: Column) -> Column:
    return F.regexp_replace(c, r"\A\s+|\s+\z", "")


def sym_canonical(c: Column) -> Column:
    """Trimmed, upper-cased, class shares with a dash; other notation is null."""
    text = F.upper(strip_space(c))
    return F.when(text.rlike(SYMBOL), F.translate(text, "./", "--"))


def sym_ticker_grammar(c: Column) -> Column:
    return F.coalesce(F.upper(c).rlike(TICKER), F.lit(False))


def sym_from_url(c: Column, host: str) -> Column:
    """The symbol of a canonical ``https://<host>/stock?t=…[&ty=oc]`` URL, else null.

    The raw ``t`` value is checked before any percent-decoding; ports, user
    information, fragments, other or repeated parameters are all rejected.
    """
    shape = rf"\A(?i:https://{re.escape(host)})/stock\?([^#]*)#?\z"
    fields = F.split(F.regexp_extract(c, shape, 1), "&")

    def key(x: Column) -> Column:
        return F.try_url_decode(F.substring_index(x, "=", 1))

    def of(name: str) -> Column:
        return F.filter(fields, lambda x: key(x) == name)

    raw = F.filter(fields, lambda x: F.substring_index(x, "=", 1) == "t")
    option = F.transform(of("ty"), lambda x: F.try_url_decode(F.substring(x, F.instr(x, "=") + 1, F.length(x))))
    good = (
        c.rlike(shape)
        & F.forall(fields, lambda x: x.contains("=") & key(x).isin("t", "ty"))
        & (F.size(raw) == 1)
        & (F.size(of("t")) == 1)
        & F.get(raw, F.lit(0)).rlike(r"\At=[A-Za-z0-9-]+\z")
        & ((F.size(option) == 0) | (option == F.array(F.lit("oc"))))
    )
    return F.when(good, F.upper(F.substring(F.get(raw, F.lit(0)), F.lit(3), F.length(c))))


def slug_check(c: Column, kind: str = "publisher") -> Column:
    return F.coalesce(c.rlike(SLUG) & (F.length(c) <= SLUG_MAX[kind]), F.lit(False))


# ---------------------------------------------------------------- displays


def split_paired(c: Column) -> Column:
    """``0.88 (0.28%)`` to ``struct<value, percent>``; no pair leaves percent empty."""
    pattern = r"(?s)\A(.*?)\(([-+]?[0-9.]+%)\)"
    percent = F.regexp_extract(c, pattern, 2)
    before = strip_space(F.regexp_extract(c, pattern, 1))
    return F.struct(
        F.when(percent != "", before).otherwise(c).alias("value"),
        percent.alias("percent"),
    )


def strip_aum(c: Column) -> Column:
    return F.nullif(strip_space(F.regexp_replace(c, r"\AAUM:", "")), F.lit(""))


def strip_dollar(c: Column) -> Column:
    return F.nullif(F.ltrim(c, F.lit("$")), F.lit(""))


def strip_parens(c: Column) -> Column:
    return F.btrim(c, F.lit("()"))


def csv_index(c: Column) -> Column:
    """An index-membership display to its names."""
    return F.filter(F.split(c, r"\s*,\s*"), lambda x: x != "")


# ---------------------------------------------------------------- URLs


def url_absolute(href: Column, origin: str, folder: str = "/") -> Column:
    """``href`` resolved against a page in ``folder`` of ``origin``."""
    return (
        F.when(href.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(origin.split("//")[0]), href))
        .when(href.startswith("/"), F.concat(F.lit(origin), href))
        .otherwise(F.concat(F.lit(origin + folder), href))
    )


def timeframe_code(c: Column, table: dict[str, str] = CHART_TIMEFRAMES) -> Column:
    """A timeframe name or code to its code; a bad one is null."""
    names = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    code = F.coalesce(F.try_element_at(names, c), c)
    return F.when(code.rlike(r"\A[a-z0-9]{1,3}\z"), code)


def url_chart(symbol: Column, timeframe: Column, origin: str, legacy: bool = False) -> Column:
    path = "/chart.ashx" if legacy else "/chart"
    return F.concat(
        F.lit(f"{origin}{path}?t="), sym_canonical(symbol), F.lit("&p="), timeframe_code(timeframe)
    )


def url_spectrum(dimension: Column, origin: str, rev: Column | None = None) -> Column:
    code = F.lower(strip_space(dimension))
    url = F.when(
        code.rlike(r"\A[a-z]+\z"),
        F.concat(F.lit(f"{origin}/grp_image?spectrum_"), code, F.lit(".png")),
    )
    if rev is None:
        return url
    good = F.when(rev.rlike(r"\A[0-9]{1,32}\z"), F.concat(F.lit("&rev="), rev))
    return F.concat(url, F.when(rev.isNull(), F.lit("")).otherwise(good))


def media_type(url: Column) -> Column:
    return F.when(F.lower(url).contains(".png"), F.lit("image/png")).otherwise(F.lit("image"))


# ---------------------------------------------------------------- redaction

# Policy. A *label* is a name that holds one of the stems below, in any case, with an
# optional closing quote. What follows a colon is secret to the end of the line (header
# and JSON values may hold anything), what follows an equals sign up to the next ``&``.
# A URL loses what stands before its ``@``, and all of it behind a word that says that
# it is a route. Maps use the same stems for their keys.
REDACTED = "[REDACTED]"
BODY_REDACTED = "[BODY REDACTED]"
SECRET_STEMS = (
    r"auth\b", "authori[sz]ation", "token", "secret", "passw", "passphrase", "pwd", "credential",
    "cookie", "session", "api[-_.]?key", "private[-_.]?key", "prox(?:y|ies)",
)
BODY_STEMS = ("body", "payload", "content", "html")

_LABELLED = (
    rf"(?i)((?:{'|'.join((*SECRET_STEMS, *BODY_STEMS))})[\w.-]*[\"']?[ \t]*)"
    r"(?:(:[ \t]*)\S[^\n]*|(=[ \t]*)[^&\s][^&\n]*)"
)
_USER_INFO = r"(://)[^\s/@]+@"
_ROUTED = r"(?i)((?:prox(?:y|ies)|route)\b[^\n]{0,20}?)\b[a-z][a-z0-9+.-]*://[^\s\"'<>]+"


def redact_text(c: Column) -> Column:
    """Labelled values, URL credentials and routes of a whole text, masked."""
    marked = F.when(c.contains(":") | c.contains("="), F.regexp_replace(c, _LABELLED, "$1$2$3[REDACTED]")).otherwise(c)
    bare = F.regexp_replace(F.regexp_replace(marked, _ROUTED, "$1[REDACTED]"), _USER_INFO, "$1[REDACTED]@")
    return F.when(marked.contains("://"), bare).otherwise(marked)


def _holds(key: Column, stems: tuple[str, ...]) -> Column:
    # The end of a word inside camelCase is an end of a word here, too.
    words = F.regexp_replace(key, r"([a-z0-9])([A-Z])", "$1-$2")
    return words.rlike(rf"(?i)(?:{'|'.join(stems)})")


def redact_map(m: Column) -> Column:
    """A ``map<string,string>`` with secret and body keys masked wholesale."""
    return redact_value(m, T.MapType(T.StringType(), T.StringType()))


def redact_value(c: Column, kind: T.DataType, name: Column | None = None) -> Column:
    """A value of any nested type with the policy applied at every depth.

    ``name`` is the key or field it stands under. Under a secret name a string is
    masked and anything else is null; below other names strings are redacted as text.
    """
    if isinstance(kind, T.StringType):
        inner = redact_text(c)
        mask, body = F.lit(REDACTED), F.lit(BODY_REDACTED)
    else:
        mask = body = F.lit(None).cast(kind)
        if isinstance(kind, T.MapType):
            inner = F.transform_values(c, lambda k, v: redact_value(v, kind.valueType, k))
        elif isinstance(kind, T.ArrayType):
            inner = F.transform(c, lambda v: redact_value(v, kind.elementType))
        elif isinstance(kind, T.StructType):
            fields = [redact_value(c[f.name], f.dataType, F.lit(f.name)).alias(f.name) for f in kind.fields]
            inner = F.when(c.isNotNull(), F.struct(*fields))
        else:
            inner = c
    if name is None:
        return inner
    return F.when(_holds(name, SECRET_STEMS), mask).when(_holds(name, BODY_STEMS), body).otherwise(inner)


def format_context(m: Column) -> Column:
    """A redacted map as one ``key=value`` line, keys sorted."""
    entries = F.array_sort(F.map_entries(redact_map(m)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None")))),
        " ",
    )


def scrub_unsafe(c: Column) -> Column:
    """A string with markup or shell characters is replaced as a whole."""
    return F.when(c.rlike(r"[<>\";'`{}\\]"), F.lit("[redacted]")).otherwise(c)
