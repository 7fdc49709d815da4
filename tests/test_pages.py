"""Page families on small hand-written bodies: repair, drift, both payload forms."""

import re

import pytest
from pyspark.sql import functions as F

from bindings import extraction as E
from bindings.core import Tables
from tickweave.plans import api as A
from tickweave.plans import families as P
from tickweave.sources import captures as C
from tickweave.sources import html as D
from tickweave.sources.embedded import x_embedded_json, x_object_literal

AT = "2026-08-27 18:00:00"


def captures(spark, *bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "capture_id bigint, body string")
    return df.withColumn("fetched_at", F.lit(AT).cast("timestamp"))


def texts(spark, body, tag="td"):
    docs = D.html_documents(captures(spark, body))
    return [r.text for r in D.nodes_of(docs).where(F.col("tag") == tag).orderBy("pos").collect()]


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<table><tr><td>a &amp; b</td><td> <b>c</b>d </td></tr></table>", ["a & b", "cd"]),
        ("<table><tr><td>x<table><tr><td>in</table>y<td>z</table>", ["xiny", "in", "z"]),
        ("<table><tr><td><p>a<p>b<td>c</table>", ["ab", "c"]),
        ("<table><tr><td>a<!-- <td>no</td> --><td>b</table>", ["a", "b"]),
        ("<table><tr><td>a<script>if (a<b) '<td>';</script><td>b</table>", ["a", "b"]),
        ("<table><tr><td title='x>y'>a<td title=\"<td>\">b</table>", ["a", "b"]),
        ("<td>loose", ["loose"]),
        ("", []),
    ],
)
def test_cells_are_repaired(spark, body, want):
    assert texts(spark, body) == want


def test_row_positions_and_heads(spark):
    body = '<table class="x y" id=t><thead><tr><th>A<th>B</thead><tbody><tr><td>1<td>2<tr><td>3<td>4</table>'
    cells = D.x_html_cells(D.html_documents(captures(spark, body))).where("tag = 'td'").orderBy("pos").collect()
    assert [(c.row_no, c.col_no, c.head, c.text) for c in cells] == [(1, 0, "A", "1"), (1, 1, "B", "2"), (2, 0, "A", "3"), (2, 1, "B", "4")]
    assert cells[0].table_classes == ["x", "y"] and cells[0].table_id == "t"


def test_fingerprint_ignores_values(spark):
    docs = D.html_documents(captures(spark, "<div class=a><b>1</b></div>", "<div class=a><b>22</b></div>", "<div class=b><b>1</b></div>"), skeleton=True)
    a, b, c = [r.fingerprint for r in D.x_fingerprint(docs).orderBy("capture_id").collect()]
    assert a == b != c


SCREEN = (
    '<div id="screener-total">#581 / 1,588 Total</div><table class="styled screener_table"><thead><tr><th>No.<th>Ticker<th>Market Cap<th>Odd</thead>'
    '<tr><td>581<td data-boxover-ticker="aapl"><a>x</a><td>1.5B<td>?<tr><td>582<td><a>msft</a><td>-<td>-<tr><td>583<td>short</table>'
)


def test_screener_rows_quarantine_and_facts(spark):
    table, bad = A.screen_captures(captures(spark, SCREEN), ["No.", "Ticker", "Market Cap", "Odd"])
    got = [(r.rank, r.symbol, r.market_cap, r.odd, r.page_start, r.total_rows) for r in table.orderBy("rank").collect()]
    assert got == [(581, "AAPL", 1.5e9, "?", 581, 1588), (582, "MSFT", None, None, 581, 1588)]
    assert bad.count() == 1
    assert P.dq_arity(P.table_rows(P.documents(captures(spark, SCREEN)), "screener_table")).first().n_cells == 2


def test_recognised_empty_screen(spark):
    docs = P.documents(captures(spark, '<table id="js-screener-body-empty"></table>', "<table><tr><td>x</table>"))
    assert [r.is_empty for r in P.screener_is_empty(docs).orderBy("capture_id").collect()] == [True, False]


def test_json_screen_keeps_requested_order_for_sparse_rows(spark):
    body = (
        '<script>{"selectedColumns":["row","ticker","company","volume"],"data":{"totalCount":2,"firstRow":40,"pageSize":20,'
        '"rows":[{"text":{"ticker":"b","company":"Bee"},"numbers":{}},{"text":{"ticker":"a"},"numbers":{"volume":12345}}]}}</script>'
    )
    rows = P.x_screener_json(P.documents(captures(spark, body))).orderBy("rank").collect()
    assert [r.heads for r in rows] == [["No.", "Ticker", "Company", "Volume"]] * 2
    assert [r.cells for r in rows] == [["41", "B", "Bee", "-"], ["42", "A", "-", "12,345"]]


def test_embedded_values_survive_braces_in_strings(spark):
    df = captures(spark, 'var a = {"x":"}{\\"","y":[1,{"z":2}]}; more {', "var a = oops", "none")
    got = df.select(x_embedded_json(F.col("body"), r"var a =").alias("j"), x_object_literal(F.col("body"), r"var a =").alias("o"), "capture_id").orderBy("capture_id").collect()
    assert got[0].j == got[0].o == '{"x":"}{\\"","y":[1,{"z":2}]}'
    assert [r.j for r in got[1:]] == [None, None] and got[1].o is None


def test_statement_problems_are_rows(spark):
    good = '{"currency":"USD","data":{"Period":["TTM","2025FY"],"Period End Date":["","9/30/2025"],"Sales":["1,5.0",null]}}'
    bodies = {
        "A": good,
        "B": '{"error":"no data"}',
        "C": '{"error":"denied"}',
        "D": good.replace('"USD"', '""'),
        "E": good.replace('"1,5.0",null', '"1"'),
        "F": good.replace("9/30/2025", "13/45/2025"),
        "G": "not json",
    }
    df = spark.createDataFrame([(k, "IA", b) for k, b in bodies.items()], "symbol string, statement string, body string")
    df = df.withColumn("fetched_at", F.lit(AT).cast("timestamp"))
    got = {r.symbol: r.problem for r in A.statement_documents(df).collect()}
    assert got == {
        "A": None, "B": "no data", "C": "unrecognized error envelope", "D": "no currency", "E": "metric misaligned",
        "F": "bad period end", "G": "no statement data",
    }
    long = A.statements(df).orderBy("period_label").collect()
    assert [(r.period_label, r.value, r.value_raw) for r in long] == [("2025FY", None, None), ("TTM", 15.0, "1,5.0")]


def test_batch_statuses(spark):
    df = spark.createDataFrame([("A", "IA", '{"error":"no data"}')], "symbol string, statement string, body string").withColumn("fetched_at", F.lit(AT).cast("timestamp"))
    requests = spark.createDataFrame([(0, "a"), (1, "A "), (2, "zz"), (3, "b@d")], "position int, requested string")
    out = A.statements_batch(df, requests, "IA")
    meta = out["metadata"].first()
    assert (meta.status, meta.requested_units, meta.succeeded_units, meta.failed_units) == ("PARTIAL", 3, 1, 2)
    assert sorted((r.symbol, r.message) for r in out["unit_errors"].collect()) == [("ZZ", "no capture"), ("b@d", "invalid symbol")]
    assert [r.canonical for r in out["resolution"].orderBy("position").collect()] == ["A", "A", "ZZ", None]


def test_outcomes(spark):
    host = "market.example"
    df = spark.createDataFrame(
        [
            (200, f"https://{host}/q", "<title>ok</title>"), (200, f"https://{host}/q", "<title>Page was not found</title>"), (403, f"https://{host}/q", ""),
            (429, f"https://{host}/q", ""), (404, f"https://{host}/q", ""), (500, f"https://{host}/q", ""), (200, "https://evil.example/q", ""),
            (200, f"https://elite.{host}/q", ""), (200, f"https://{host}/login.aspx", ""), (200, f"https://{host}.evil.example/q", ""),
        ],
        "status int, url string, body string",
    )
    got = [r[0] for r in df.select(C.classify_outcome(F.col("status"), F.col("url"), F.col("body"), host)).collect()]
    assert got == ["ok", "not_found", "blocked", "rate_limited", "not_found", "transport", "cross_origin", "entitlement", "entitlement", "cross_origin"]


def test_sitemap_comments_and_duplicates(spark):
    host = "market.example"
    body = (
        f"<urlset><url><loc>https://{host}/stock?t=B</loc></url><url><loc> https://{host}/st<!--c-->ock?t=A </loc></url>"
        f"<url><loc>https://{host}/stock?t=b&amp;ty=oc</loc></url><url><loc>https://{host}/news</loc></url></urlset>"
    )
    symbols, unexpected = A.symbols(captures(spark, body), host)
    assert sorted(r.symbol for r in symbols.collect()) == ["A", "B"]
    assert unexpected.count() == 1


def test_hierarchy_and_map_bundle(spark):
    page = captures(spark, '<script>a({initialPerf : {"nodes":{"AAA":0.5,"AAA-P":0.4},"subtype":"d1","version":3,"hash":"h"}})</script> Stock quotes delayed by 1 minute')
    asset = captures(spark, 'x=>{e.exports={name:"Root",children:[{name:"Tech",children:[{name:"Soft",children:[{name:"AAA",description:"d",value:5},{name:"BBB"}]}]}]}}')
    bundle = A.map_(page, asset)
    got = [(r.symbol, r.sector, r.industry, r.value, r.perf) for r in bundle["constituents"].orderBy("leaf_no").collect()]
    assert got == [("AAA", "Tech", "Soft", 5.0, 0.5), ("BBB", "Tech", "Soft", 0.0, None)]
    assert [r.symbol for r in bundle["unmapped"].collect()] == ["AAA-P"]


def test_export_round_trips_awkward_text(spark, tmp_path):
    df = spark.createDataFrame([("a,\"b\"\nc", {"k": 'v"'})], "s string, m map<string,string>")
    C.sink_export(df, str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "csv")).first()
    assert (back.s, back.m) == ('a,"b"\nc', '{"k":"v\\""}')


def test_cells_as_a_table_function(spark):
    D.register_html_cells(spark)
    captures(spark, "<table><tr><th>A<tr><td>1<td>2</table>").createOrReplaceTempView("captured")
    rows = spark.sql("SELECT capture_id, c.* FROM captured, LATERAL html_cells(body) c WHERE c.row_no = 1").collect()
    assert [(r.col_no, r.head, r.text) for r in rows] == [(0, "A", "1"), (1, None, "2")]


def test_hierarchies_of_another_shape_are_named(spark):
    leaf = "{name:'A',value:1}".replace("'", '"')
    bodies = {
        "good": f'e.exports = {{name:"R",children:[{{name:"S",children:[{{name:"I",children:[{leaf},{{name:"B"}}]}}]}}]}};more',
        "none": "nothing here", "flat": 'e.exports={name:"R",children:[]}', "shallow": f'e.exports={{name:"R",children:[{{name:"S",children:[{leaf}]}}]}}',
        "nameless": 'e.exports={name:"R",children:[{name:"S",children:[{name:"I",children:[{value:2}]}]}]}', "cut": 'e.exports={name:"R",children:[{name:"S"',
        "childless": 'e.exports={name:"R"}',
    }
    for name, value in {"text": '"abc"', "digits": '"5"', "truth": "true", "list": "[1]"}.items():
        bodies[name] = f'e.exports={{name:"R",children:[{{name:"S",children:[{{name:"I",children:[{{name:"A",value:{value}}}]}}]}}]}}'
    df = spark.createDataFrame(list(bodies.items()), "capture_id string, body string")
    assert [(r.symbol, r.value) for r in P.x_hierarchy(df).orderBy("leaf_no").collect()] == [("A", 1.0), ("B", 0.0)]
    named = {r.capture_id: r.problem for r in P.hierarchy_problems(df).collect()}
    assert set(named) == set(bodies) - {"good", "flat", "childless"} and named["nameless"] == "leaf without name" and named["shallow"].startswith("industry")
    assert all(named[k] == "value of leaf A is no number" for k in ("text", "digits", "truth", "list"))


def test_nothing_is_shuffled_below_the_parser(spark):
    df = spark.createDataFrame([(1, "<table class=screener_table><tr><th>A</tr><tr><td>1</tr></table>")], "capture_id long, body string")
    plan = P.table_rows(P.documents(df), "screener_table")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below


def test_one_bad_entry_does_not_end_the_calendar(spark):
    from tickweave.plans import api as A

    entries = '[{"ticker":"A","event":"E","date":"2026-08-12","importance":"2"},{"event":"no ticker","date":"2026-08-12"},{"ticker":"B","importance":"high"}]'
    body = f'<script id="route-init-data" type="application/json">{{"economic":{{"entries":{entries}}}}}</script>'
    df = spark.createDataFrame([(body,)], "body string").withColumn("fetched_at", F.lit("2026-08-12 00:00:00").cast("timestamp"))
    good, bad = A.calendar(df).collect(), A.calendar(df, quarantine=True).collect()
    assert [r.symbol for r in good] == ["A"] and len(bad) == 2 and all(r.problems for r in bad)


@pytest.mark.parametrize("body", ["<a x " * 100_000, '<a "x>' * 50_000, '<a "' * 100_000 + ">", "<aaa" * 100_000 + ">", "<a>" * 20_000 + "</a>" * 20_000, "<i>" * 20_000 + "<h1></x>" * 20_000])
def test_parsing_is_linear(body):
    import time

    start = time.perf_counter()
    D._Nodes(frozenset(), frozenset(), False).parse(body)
    assert time.perf_counter() - start < 5


def test_ancestors_are_ranges(spark):
    body = "<table id=t><tr><td>a<table><tr><td>b</table><td><a href=x>c</a></table><a href=y>d</a>"
    nodes = D.nodes_of(D.html_documents(captures(spark, body))).orderBy("pos").collect()
    outer = nodes[0]
    assert [n.text for n in nodes if outer.pos < n.pos <= outer.last and n.tag == "a"] == ["c"]
    assert [n.text for n in nodes if n.tag == "a"] == ["c", "d"]


def test_refused_rows_carry_their_place(spark):
    body = "<table class=groups_table><tr><th>No.<th>Name</tr><tr><td>1<td>A</tr><tr><td>x<td>B</tr><tr><td>2</tr></table>"
    df = captures(spark, body, "<p>nothing</p>")
    rows = sorted((r.capture_id, r.row_no, r.problem) for r in A.page_errors(df, "groups").collect() if r.row_no is not None)
    assert rows == [(0, 2, "rank or cell count"), (0, 3, "rank or cell count")]
    assert [(r.capture_id, r.problem) for r in A.page_errors(df, "groups").collect() if r.row_no is None] == [(1, "no table")]
    with pytest.raises(ValueError):
        A.page_errors(df, "no such family")


def tables(spark, tmp_path):
    part = [(i, f"name {i}", f"B{i % 3}", f"T{i % 2}", i) for i in range(1, 9)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(i, i) for i in range(1, 7)], "s_suppkey long, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    return Tables(spark, str(tmp_path))


def test_pages_are_dealt_out_before_they_are_parsed(spark, tmp_path):
    t = tables(spark, tmp_path)
    assert E._insider_docs(t).rdd.getNumPartitions() == E._news_docs(t).rdd.getNumPartitions() == 4
    rows, skipped = A.global_insider(E._insider_docs(t))
    assert (rows.count(), skipped.count()) == (7, 1)
    nodes = P.documents(E._insider_docs(t), carry=("fetched_at",), **P.INSIDER_READS)
    assert [r.row_no for r in P.x_global_insider(nodes)[0].collect()] == [1] * 7



def test_stored_parse_of_a_bundle_is_not_cached(spark, tmp_path):
    out = E.bundle_fanout(tables(spark, tmp_path))
    assert "InMemoryRelation" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.relation: r.n for r in out.collect()}["snapshot_tables"] == 88


def test_relations_of_a_bundle_read_their_parts_only(spark, tmp_path):
    plan = E.bundle_fanout(tables(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    read = [re.findall(r"(\w+)#", scan) for scan in re.findall(r"FileScan parquet \[([^]]*)\]", plan)]
    parts = sorted(tuple(c for c in scan if c in P.NODE_COLUMNS) for scan in read)
    assert parts == [()] * 3 + [("cell_nodes",)] + [("nodes",)] * 5 + [("row_nodes",)] * 3


def test_page_errors_parses_every_page_once(spark, tmp_path):
    out = E.page_errors(tables(spark, tmp_path))
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.family, r.problem): r.n for r in out.collect()}
    assert got["groups", None] == got["groups", "no table"] == 2 and got["global_news", "no link"] == 6


def test_page_errors_of_stock_pages_read_rows_only(spark, tmp_path):
    plan = E.page_errors(tables(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "quotes-" in line]
    assert len(scans) == 8 and not any("cell_nodes" in line or ",nodes" in line or "[nodes" in line for line in scans)


STOCK = (
    "<table><tr><td><div class=quote-header><h1 data-ticker=ABC></h1><h2 class=quote-header_ticker-wrapper_company>A</h2>"
    "<a class=quote-header_category href='?f=sec_x'>S</a></div></table>"
    "<table><tr><td class=snapshot-td2>Beta<td class=snapshot-td2><b>1</b><td class='snapshot-td2 quote_profile-bio'>P/E<td class=snapshot-td2>2</table>"
    "<table class=js-table-ratings><tr><th>Date<th>Action</tr><tr><td>Aug-01-01<td>Up</tr><tr><td>short</tr></table>"
    "<table id=news-table><tr><td>Aug-01-01 04:15PM<td><a class=tab-link-news href=/n>N</a></table>"
    "<table class=body-table><tr><th>Date<th>SEC Form 4</tr><tr><td>Jan 02 '01<td><a href=/f>f</a></table>"
    "<table><tr><td><div><a class=tab-link>Peers</a><span data-boxover-ticker=X></span></div><td><div><a class=tab-link>Held by</a><span data-boxover-ticker=E data-boxover-value=1></span></div></table>"
    "<table><tr><td class=js-quote-correlation-links-container><a class=sig-tab-link href=/screener>G</a></table><img src=/chart.ashx?p=w>"
)


def test_parts_of_stock_pages_hold_all_that_their_relations_read(spark):
    df = captures(spark, STOCK, "<p>nothing", STOCK.replace("ABC", "DEF").replace("js-table", "old-table").replace("quote_profile-bio", ""))
    whole = P.bundle_fanout(P.documents(df, carry=("fetched_at",)))
    parts = P.quote_parts(P.quote_documents(P.documents(df, carry=("fetched_at",), **P.QUOTE_READS)))
    assert parts.columns[-3:] == ["nodes", "row_nodes", "cell_nodes"]
    for name, rows in P.bundle_fanout(parts).items():
        found = [sorted(map(str, r.collect())) for r in (rows, whole[name])]
        assert found[0] == found[1] and found[0], name
    for family in ("stock", "ratings", "stock_news", "stock_insider"):
        by = [sorted((r.capture_id, r.row_no or -1, r.problem) for r in A.page_errors(x, family).collect()) for x in (df, parts)]
        assert by[0] == by[1] and (by[0] or family in ("stock_news", "stock_insider"))


def test_rows_that_are_read_bring_no_cells_along(spark):
    body = "<table id=t><tr><th>H<tr><td>1<td class=snapshot-td2>2</table><table><tr><td>3<a href=x>4</a></table>"
    nodes = [(n.tag, n.text, n.cells) for n in D.nodes_of(P.documents(captures(spark, body), rows=("t",))).orderBy("pos").collect()]
    assert nodes == [("table", None, None), ("tr", None, []), ("tr", None, ["1", "2"]), ("td", "2", None), ("a", "4", None)]


def test_tags_seen_before_are_read_alike():
    tags = [f'<td data-x="{i}" class=a>{i}</td>' for i in range(D._KNOWN_TAGS)]
    body = "<table><tr>" + "".join(tags + tags) + "<td/><TD  id=z>x</table>"
    nodes = [n for n in D._Nodes(frozenset(), frozenset(), False).parse(body) if n[D._TAG] == "td"]
    assert [dict(n[D._ATTRS]).get("data-x") for n in nodes[:-2]] == [str(i) for i in range(D._KNOWN_TAGS)] * 2
    assert (nodes[-1][D._ID], nodes[-1][D._TEXT], nodes[-1][D._COL_NO]) == ("z", "x", 2 * D._KNOWN_TAGS + 1)


def test_null_bodies_are_left_out_without_a_filter(spark):
    df = captures(spark, "<p>a", None, "<h1>b</h1>", None).union(captures(spark, None)).coalesce(1)
    docs = D.html_documents(df)
    assert "Filter" not in docs._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.capture_id, [n.text for n in r.nodes]) for r in docs.orderBy("capture_id").collect()] == [(0, []), (2, ["b"])]


def test_projections_of_parsed_pages_are_not_broadcast(spark):
    bundle = {"peers": P.x_quote_peers(P.quote_documents(P.documents(captures(spark, STOCK), carry=("fetched_at",))))}
    requests = spark.createDataFrame([(1, " abc"), (2, "ABC"), (3, "none"), (4, None)], "position int, requested string")
    out = A.quote_projection(bundle, "peers", requests)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [(r.symbol, r.peer) for r in out.collect()] == [("ABC", "X")]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
