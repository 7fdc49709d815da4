"""Truth tables, and seeded random displays against a plain-Python restatement."""

import datetime as dt
import math
import random
import re
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tickweave.functions import numeric as N
from tickweave.functions import temporal as M
from tickweave.functions import text as X

EASTERN = ZoneInfo("America/New_York")
ANCHOR = dt.date(2026, 8, 27)


@pytest.mark.parametrize(
    ("build", "table"),
    [
        (N.norm_compact, {"2.5B": 2.5e9, "1.2M": 1.2e6, "890.5B": 890.5e9, "0.2%": 0.2, "-1,5k": -15e3, "1e400": None, "nan": None, "x": None}),
        (N.norm_percent, {"3.25%": 0.0325, "-1.5%": -0.015, "0.75%": 0.0075, "inf%": None, "1,000 % ": 10.0}),
        (N.norm_count, {"3": 3, "12,500": 12500, "9007199254740993": 9007199254740993, "1.5K": 1500, "1.2345K": None,
                        "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -(2**63),
                        "0." + "0" * 40 + "T": 0, "1." + "0" * 40: 1, "+7": 7}),
        (N.norm_number, {"-2,315.04": -2315.04, "1d": None, "0x10": None, "1_000": None}),
        (N.norm_int, {"1,234": 1234, "1.0": None, "-5": -5}),
        (N.norm_ragged, {"": None, "-": None, "5%": 0.05, "1.5B": 1.5e9, "+1.5B": None, "--5B": None, "7": 7.0, "Aug 5": None}),
        (N.norm_market_pct, {"-0.5%": -0.005, "12.5": 12.5, "-": None}),
        (M.norm_date_iso, {"2026-08-15": dt.date(2026, 8, 15), "2026-8-15": None, "2026-02-30": None}),
        (M.norm_date_us, {"9/30/2025": dt.date(2025, 9, 30), "": None, "13/1/2025": None}),
        (M.norm_date_mon, {"Aug 5, 2026": dt.date(2026, 8, 5), "5 Aug 2026": None}),
        (M.norm_date_rating, {"Aug-17-26": dt.date(2026, 8, 17), "Aug-17-2026": None}),
        (M.norm_date_insider, {"Aug 27 '26": dt.date(2026, 8, 27), "Foo 27 '26": None}),
        (M.norm_session, {"Nov 12 BMO": "BMO", "Aug 26/a": "AMC", "Aug 26/b": "BMO", "Aug 26": None, "BMO": None}),
        (M.norm_ts_news_kind, {"05:25AM": "anchored", "46 min": "relative", "2 hrs": "relative", "Aug-27": "date_only", "Xyz-27": None, "Aug-40": None}),
        (X.sym_canonical, {" brk.b ": "BRK-B", "BRK/B": "BRK-B", "A B": None, "": None, "A..B": None}),
        (X.strip_aum, {"AUM: 890B": "890B", "AUM:": None}),
        (X.scrub_unsafe, {"plain": "plain", "a<b": "[redacted]", "x;y": "[redacted]"}),
        (N.norm_sentinel, {"—": None, "NA": None, " - ": " - ", "0": "0"}),
    ],
)
def test_truth_table(one, build, table):
    assert one(build, list(table)) == list(table.values())


def test_key_symbol_na_is_data(one):
    assert one(lambda c: N.norm_sentinel(c, key_symbol=True), ["NA", "-"]) == ["NA", None]


def test_null_display_is_never_an_error(one):
    for build in (N.norm_compact, N.norm_count, N.norm_percent, N.norm_ragged, M.norm_date_mon, X.sym_canonical):
        assert one(build, [None]) == [None]


def test_earnings_year_guess(one):
    shown = ["Jan 3", "Nov 12, 2020", "Feb 29", "Mar 1", "Dec 31 AMC", "Smarch 3"]
    want = [dt.date(2027, 1, 3), dt.date(2020, 11, 12), None, dt.date(2026, 3, 1), dt.date(2026, 12, 31), None]
    assert one(lambda c: M.norm_date_earnings(c, F.col("a")), shown, a=F.lit(ANCHOR)) == want


def restated_instant(naive):
    """PEP 495: a wall time with two different offsets has no single instant."""
    early, late = (naive.replace(tzinfo=EASTERN, fold=f).utcoffset() for f in (0, 1))
    if early != late:
        return None, "ambiguous"
    return naive.replace(tzinfo=EASTERN).astimezone(dt.UTC).replace(tzinfo=None), "exact"


def test_eastern_instants(one):
    rng = random.Random(7)
    moments = [dt.datetime(1990, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 365 * 45)) for _ in range(600)]
    for year in range(2000, 2030):  # every change day, around the change
        for month, day0 in ((3, 8), (4, 1), (10, 25), (11, 1)):
            first = dt.date(year, month, day0)
            sunday = first + dt.timedelta((6 - first.weekday()) % 7)
            moments += [dt.datetime.combine(sunday, dt.time(h, m)) for h in range(4) for m in (0, 30, 59)]
    shown = [m.strftime("%Y-%m-%d %H:%M") for m in moments]
    got = one(lambda c: M.norm_ts_eastern(c, F.col("a")), shown, a=F.lit(ANCHOR))
    assert [(g.instant, g.status) for g in got] == [restated_instant(m) for m in moments]


def test_time_only_displays_are_anchored(one):
    got = one(lambda c: M.norm_ts_eastern(c, F.col("a")), ["09:30", "13:30", "25:00", "46 min"], a=F.lit(ANCHOR))
    assert [tuple(g) for g in got] == [
        (dt.datetime(2026, 8, 27, 13, 30), "anchored"),
        (dt.datetime(2026, 8, 27, 17, 30), "anchored"),
        (None, None),
        (None, None),
    ]


def random_display(rng):
    digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 22)))
    text = rng.choice(["", "+", "-", "--"]) + digits
    if rng.random() < 0.5:
        text += "." + "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 12)))
    if rng.random() < 0.2 and len(text) > 3:
        text = text[:2] + "," + text[2:]
    return text + rng.choice(["", "", "K", "M", "b", "T", "%", "x"])


def restated_compact(shown):
    text = re.sub(r"%\s*$", "", shown.replace(",", ""))
    try:
        if re.fullmatch(r"(?i)[+-]?\d+(\.\d+)?[KMBT]", text):
            value = float(f"{text[:-1]}e{dict(K=3, M=6, B=9, T=12)[text[-1].upper()]}")
        else:
            value = float(text)
    except ValueError:
        return None
    return value if math.isfinite(value) else None


def restated_count(shown):
    m = re.fullmatch(r"(?i)([+-]?\d+(?:\.\d+)?)([KMBT]?)", shown.replace(",", ""))
    if not m:
        return None
    value = Decimal(m[1]).scaleb({"": 0, "K": 3, "M": 6, "B": 9, "T": 12}[m[2].upper()])
    if value != int(value) or not -(2**63) <= int(value) < 2**63:
        return None
    return int(value)


def test_random_displays(one):
    rng = random.Random(42)
    shown = [random_display(rng) for _ in range(4000)]
    assert one(N.norm_compact, shown) == [restated_compact(s) for s in shown]
    import decimal

    with decimal.localcontext(prec=80):
        assert one(N.norm_count, shown) == [restated_count(s) for s in shown]


def test_formatters_round_like_c(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(0, 2e7), rng.randint(0, 4)) for _ in range(1500)] + [1005.0, 1125.0, 100.05, 0.0, 0.125, 999.995]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def millions(v):
        for floor, scale, unit in ((1e6, 1e6, "T"), (1e3, 1e3, "B"), (1, 1, "M")):
            if v >= floor:
                return f"{v / scale:.2f}{unit}"
        return f"{v * 1000:.2f}K" if v >= 0.001 else f"{v:g}"

    rows = df.select("v", N.fmt_compact_millions(F.col("v")).alias("m"), N.fmt_percent_points(F.col("v") / 1000).alias("p")).collect()
    for r in rows:
        assert r.m == millions(r.v)
        if r.v / 1000 >= 1 or r.v == 0:
            assert r.p == f"{r.v / 1000:.4g}%"


HOST = "market.example"


def test_symbol_urls(one):
    good = {f"https://{HOST}/stock?t=abc": "ABC", f"https://{HOST}/stock?ty=oc&t=BRK-B": "BRK-B", f"https://{HOST}/stock?t=NA": "NA"}
    bad = [
        f"http://{HOST}/stock?t=A", f"https://{HOST}:443/stock?t=A", f"https://u:p@{HOST}/stock?t=A", f"https://{HOST}/stock/?t=A",
        f"https://{HOST}/stock?t=A#x", f"https://{HOST}/stock?t=A&t=B", f"https://{HOST}/stock?t=%41", f"https://{HOST}/stock?t=A&z=1",
        f"https://{HOST}/stock?t=A&ty=xx", f"https://{HOST}/stock?t=A&&ty=oc", f"https://x{HOST}/stock?t=A", f"https://{HOST}/stock?t=A B", "",
    ]
    assert one(lambda c: X.sym_from_url(c, HOST), [*good, *bad]) == [*good.values()] + [None] * len(bad)


@pytest.mark.parametrize("label", ["P/E", "Change %", "EPS (ttm)", "52W High", "No.", "Float/Outstanding", "  ", "a__b", "A+B-C"])
def test_label_rule_is_one_rule(one, label):
    assert one(X.label_to_field_column, [label]) == [X.label_to_field(label)]


SECRET = "s3cr3t-value"


@pytest.mark.parametrize(
    "text",
    [
        f"Authorization: Bearer {SECRET}", f"X-Api-Key: {SECRET}", f"Set-Cookie: sid={SECRET}; Path=/", f"GET /q?access_token={SECRET}&t=AAPL",
        f'token="{SECRET}" rejected', f'{{"access_token": "{SECRET}"}}', f"response_body=x {SECRET} y", f"via proxy http://u:{SECRET}@gw.example:9",
        f"HTTP_PROXY=http://gate.example:80/{SECRET}", f"https://user:{SECRET}@host.example/", f"cookies={SECRET} expired",
    ],
)
def test_secrets_are_masked(one, text):
    (clean,) = one(X.redact_text, [text])
    assert SECRET not in clean and "[REDACTED]" in clean


def test_public_text_survives(one):
    texts = ["invalid token format", "session expired for AAPL", "GET /q?token=[REDACTED]&t=AAPL", "plain words\nand lines"]
    assert one(X.redact_text, texts) == texts


def policy(text):
    """Labelled values only: words one after another, as the policy states it."""
    stems = ("token", "secret", "passw", "pwd", "cookie", "session", "api-key", "proxy", "body", "html")
    out = []
    for line in text.split("\n"):
        done, rest = "", line
        while rest:
            hits = [(rest.lower().find(s), s) for s in stems if s in rest.lower()]
            if not hits:
                break
            at, stem = min(hits, key=lambda h: (h[0], stems.index(h[1])))
            end = at + len(stem)
            while end < len(rest) and (rest[end].isalnum() or rest[end] in "_.-"):
                end += 1
            end += rest[end : end + 1] in ('"', "'")
            while rest[end : end + 1] in (" ", "\t") and rest[end : end + 1]:
                end += 1
            sep = rest[end : end + 1]
            value = rest[end + 1 :].lstrip(" \t")
            stop = len(value) if sep == ":" else value.find("&") if "&" in value else len(value)
            if sep in (":", "=") and sep and stop > 0:
                done += rest[: end + 1 + len(rest[end + 1 :]) - len(value)] + "[REDACTED]"
                rest = value[stop:]
            else:
                done, rest = done + rest[: at + 1], rest[at + 1 :]
        out.append(done + rest)
    return "\n".join(out)


def test_labels_follow_the_policy(one):
    rng = random.Random(5)
    bits = ["token", "=", ":", " ", "x", "&", "\n", "cookie", '"', "api-key", "pass", "word", "body", "my_", "Secret"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(3, 14))) for _ in range(2000)]
    assert one(X.redact_text, texts) == [policy(t) for t in texts]


def test_nested_values_are_masked(spark):
    kind = "a struct<token: string, n: int, list: array<struct<note: string, cookie: array<string>>>, deep: map<string, map<string, string>>>"
    value = ("x", 1, [("pwd=1&b", ["c"])], {"plain": {"sessionId": "s", "k": "v"}, "secrets": {"k": "v"}})
    df = spark.createDataFrame([(value,)], kind)
    row = df.select(X.redact_value(F.col("a"), df.schema["a"].dataType).alias("a")).first().a.asDict(recursive=True)
    assert row == {"token": "[REDACTED]", "n": 1, "list": [{"note": "pwd=[REDACTED]&b", "cookie": None}], "deep": {"plain": {"sessionId": "[REDACTED]", "k": "v"}, "secrets": None}}


def test_redact_map_by_key(spark):
    m = {"cookies": "a", "accessToken": "b", "responseBody": "c", "note": "token=d", "symbol": "AAPL"}
    row = spark.createDataFrame([(m,)], "m map<string,string>").select(X.redact_map(F.col("m")).alias("m")).first()
    assert row.m == {
        "cookies": "[REDACTED]", "accessToken": "[REDACTED]", "responseBody": "[BODY REDACTED]", "note": "token=[REDACTED]", "symbol": "AAPL",
    }
