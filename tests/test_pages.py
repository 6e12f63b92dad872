"""Extraction, links, routing, reconciliation."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymill.operators import extract, reconcile, routing
from tallymill.operators.extract import PageRule

# Four layouts: items with own labels, tab-laid text, items by class, one record per page.
RULES = (
    PageRule("cards", "cards.example", item=r'(?s)<div class="card">(.*?)</div>',
             label=r"(?s)<b>(.*?)</b>", text=r"(?s)<p>(.*?)</p>"),
    PageRule("tabs", "tabs.example", item=r'(?s)<div class="text_box">(.*?)</div>',
             label=r"(?s)<h6>(.*?)</h6>", text=r"(?s)^(.*)$", finish=extract.tabbed_cut),
    PageRule("columns", "columns.example", item=r'(?s)<td class="col">(.*?)</td>',
             label=r'(?s)<i class="t">(.*?)</i>', text=r'(?s)<span class="text">(.*?)</span>'),
    PageRule("single", "single.example", label=r"(?s)<h1>(.*?)</h1>", label_last_word=True,
             text=r'(?s)<div class="p-3">(.*?)</div>'),
)
PAGES = [
    (1, "https://cards.example/daily", '<script>var a="<div class=\\"card\\"><b>X</b></div>"</script>'
     '<div class="card"><b>Лев</b><p>Удача &amp; <a href="/x">успех</a></p></div>'
     '<div class="card"><p>без знака</p></div><!-- <div class="card"><b>Нет</b></div> -->'),
    (2, "http://tabs.example/", '<div class="text_box">\n<h6>Рак</h6>' + "\t" * 7 + "Покой"
     + "\t" * 6 + "</div>" + '<div class="text_box"><h6>Рыбы</h6>пусто</div>'),
    (3, "https://www.columns.example:8080/love?x=1",
     '<td class="col"><i class="t">Овен</i><span class="text">Текст&nbsp;а</span></td>'),
    (4, "https://single.example", '<h1>Гороскоп на сегодня Дева</h1><div class="p-3">День &amp;lt; ночь</div>'),
    (5, "https://other.example/", "<h1>x</h1>"),
]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id int, url string, html string")


def test_four_layouts_one_schema(spark):
    out = extract.extract_records(pages(spark), RULES, "2024-03-02", keep=("page_id",))
    got = sorted((r.page_id, r.zodiac, r.horo, r.source) for r in out.collect())
    assert got == sorted([
        (1, "Лев", "Удача & успех", "cards"), (1, "", "без знака", "cards"),
        (2, "Рак", "Покой", "tabs"), (2, "Рыбы", "", "tabs"),
        (3, "Овен", "Текст а", "columns"),
        (4, "Дева", "День &lt; ночь", "single"),
    ])
    assert out.first().date == datetime(2024, 3, 2)
    assert [f.name for f in out.schema][1:] == ["date", "zodiac", "horo", "source"]


def test_collected_records_are_appended_by_day(spark, tmp_path):
    from tallymill.plans.jobs import collect_job

    sink = str(tmp_path / "raw")
    collect_job(pages(spark), RULES, "2024-03-02", sink)
    collect_job(pages(spark), RULES, "2024-03-03", sink)
    days = {str(r.day): r["count"] for r in spark.read.parquet(sink).groupBy("day").count().collect()}
    assert days == {"2024-03-02": 6, "2024-03-03": 6}


def test_unify_aligns_by_name(spark):
    a = spark.createDataFrame([("x", 1)], "s string, n int")
    b = spark.createDataFrame([(2, "y")], "n int, s string")
    assert sorted(map(tuple, extract.unify([a, b]).collect())) == [("x", 1), ("y", 2)]


def test_links(spark):
    html = ('<a class="c" href="//cdn.example/a">1</a><a href="/b">2</a><a href="https://z.example/c">3</a>'
            '<script>"<a href="/no">"</script>')
    df = spark.createDataFrame([(1, "https://s.example/x/y?q", html)], "page_id int, url string, html string")
    assert sorted(r.link for r in extract.discover_links(df).collect()) == [
        "https://cdn.example/a", "https://s.example/b", "https://z.example/c"]


def test_route_priority(spark):
    texts = ["🔥Знаки Огня", "💧Знаки Воды", "🌍Знаки Земли", "🎈Знаки Воздуха", "Назад", "назад",
             "Хочу ♌Лев, привет", "Лев", "Доброе УТРО", "PRIVET", "think", "пока", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r.intent for r in routing.route(df).orderBy("i").collect()]
    assert got == ["menu_fire", "menu_water", "menu_earth", "menu_air", "back", "fallback",
                   "sign", "fallback", "greeting", "greeting", "greeting", "fallback", "fallback"]
    assert routing.route(df).columns == ["i", "text", "intent"]
    counts = {r.intent: r.n for r in routing.intent_counts(routing.route(df)).collect()}
    assert sum(counts.values()) == len(texts) and counts["greeting"] == 3


def test_unknown_match_kind(spark):
    with pytest.raises(ValueError):
        routing.route(spark.createDataFrame([("x",)], "text string"),
                      routes=(routing.Route("a", "fuzzy", ("x",)),))


LISTING = ["2022-12-05 12:23:48 2807409271 data/2019-08-22.txt",
           "2022-12-05 12:24:58       1024 data/a file.txt", "", "Total Objects: 2",
           "   Total Size: 2807410295"]


def test_listing_lines(spark):
    df = reconcile.parse_listing(spark.createDataFrame([(x,) for x in LISTING], "value string"))
    assert sorted(map(tuple, df.collect())) == [
        (datetime(2022, 12, 5, 12, 23, 48), 2807409271, "data/2019-08-22.txt"),
        (datetime(2022, 12, 5, 12, 24, 58), 1024, "data/a file.txt")]
    assert reconcile.totals(df).first()[:] == (2, 2807410295)
    assert reconcile.totals(df.filter("false")).first()[:] == (0, 0)


def listing(spark, rows):
    return spark.createDataFrame(rows, "key string, size long")


def test_reconcile_statuses(spark):
    source = listing(spark, [("p/a", 1), ("p/b", 2), ("p/c", 3), ("d", 4)])
    target = listing(spark, [("a", 1), ("b", 9), ("x", 5), ("d", 4)])
    got = {r.key: r.status for r in reconcile.compare(source, target, "p/").collect()}
    assert got == {"a": "ok", "b": "size_mismatch", "c": "missing", "x": "extra", "d": "ok"}
    assert {r.key for r in reconcile.missing_only(source, target, "p/").collect()} == {"c"}


def test_links_under_all_quotes_cases_and_path_forms(spark):
    page = """<A HREF='/one'>1</A><a class="m  x" href=two.html>2</a><a href="../three?q=1&amp;r=2#f">3</a>
      <a href="?page=2">4</a><a href="#part">5</a><a href="//cdn.example/a">6</a><a href="mailto:a@b.c">7</a>
      <a name="none">8</a><a title="a > b" class='m' href="./four/">9</a><a data-href="no" href="">x</a>
      <script>"<a href='/hidden'>"</script><!-- <a href="/gone"> --><abbr href="/not">z</abbr>"""
    df = spark.createDataFrame([(1, "https://s.example/a/b/c.html?x=1#y", page)], "page_id int, url string, html string")
    assert [r.link for r in extract.discover_links(df).collect()] == [
        "https://s.example/one", "https://s.example/a/b/two.html", "https://s.example/a/three?q=1&r=2#f",
        "https://s.example/a/b/c.html?page=2", "https://s.example/a/b/c.html?x=1#part",
        "https://cdn.example/a", "mailto:a@b.c", "https://s.example/a/b/four/"]
    assert [r.link for r in extract.discover_links(df, "m").collect()] == [
        "https://s.example/a/b/two.html", "https://s.example/a/b/four/"]


def test_character_references(spark):
    cases = {"&laquo;&raquo;&mdash;&#171;&#x2014;&apos;": "«»—«—'", "&amp;lt; &amp;amp;": "&lt; &amp;",
             "a & b &nosuch; &": "a & b &nosuch; &", "&#0;&#x110000;": "\ufffd\ufffd", "&nbsp;&hellip;": "\u00a0…",
             "": "", "&NotEqualTilde;": "≂̸"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)], "raw string, want string")
    got = df.select("raw", "want", extract.unescape("raw").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_rules_from_a_file(spark, tmp_path):
    import json

    path = tmp_path / "rules.json"
    path.write_text(json.dumps([{"source": "tabs", "host": "tabs.example", "label": r"(?s)<h6>(.*?)</h6>", "text": r"(?s)^(.*)$",
                                 "item": r'(?s)<div class="text_box">(.*?)</div>', "finish": "tabbed_cut"}]))
    out = extract.extract_records(pages(spark), extract.load_rules(str(path)), "2024-03-02")
    assert sorted((r.zodiac, r.horo) for r in out.collect()) == [("Рак", "Покой"), ("Рыбы", "")]


def test_reconcile_tells_unknown_sizes_and_duplicate_keys(spark):
    listing = lambda rows: spark.createDataFrame(rows, "key string, size long")
    source = listing([("a", None), ("b", 10), ("b", 20), ("c", 5), ("c", 5), ("d", None), ("e", 1)])
    target = listing([("a", 3), ("b", 20), ("c", 5), ("e", 1), ("e", 2), ("f", None)])
    got = {r.key: r.status for r in reconcile.compare(source, target).collect()}
    assert got == {"a": "unknown_size", "b": "duplicate_key", "c": "ok", "d": "missing",
                   "e": "duplicate_key", "f": "extra"}


def test_reconcile_with_itself_and_with_a_join(spark):
    rng = random.Random(9)
    rows = [(f"k{i}", rng.randrange(100)) for i in range(400)]
    a = listing(spark, rows)
    assert reconcile.differences(a, a).count() == 0
    b = listing(spark, [(k, s + (i % 7 == 0)) for i, (k, s) in enumerate(rows) if i % 5] + [("new", 1)])
    joined = a.withColumnRenamed("size", "s").join(b.withColumnRenamed("size", "t"), "key", "full")
    want = joined.select("key", F.expr(
        "CASE WHEN t IS NULL THEN 'missing' WHEN s IS NULL THEN 'extra' WHEN s <> t "
        "THEN 'size_mismatch' ELSE 'ok' END AS status"))
    got = reconcile.compare(a, b).select("key", "status")
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
