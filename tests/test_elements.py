"""Elements of pages by tag and class, nested and unclosed ones included."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallymill.operators import elements, extract
from tallymill.operators.elements import ElementRule, Selector

RULES = (
    ElementRule("cards", "cards.example", item=Selector(classes="IGRa5"), label=Selector(classes="_4K6U+ _9dcVo"),
                text=Selector(classes="BDPZt KUbeq")),
    ElementRule("tabs", "tabs.example", item=Selector(classes="text_box"), label=Selector("h6"), finish=extract.tabbed_cut),
    ElementRule("columns", "columns.example", item=Selector(classes="col-xs-12 col-md-6"), label=Selector(classes="t"),
                text=Selector(classes="text")),
    ElementRule("single", "single.example", label=Selector("h1"), label_last_word=True, text=Selector(classes="p-3")),
    ElementRule("shared", "shared.example", item=Selector("li"), label=Selector("h2"), label_on_page=True),
)

PAGES = [
    (1, "https://cards.example/daily", '<div class="feed"><div class="IGRa5 wide"><h3 class="_4K6U+ _9dcVo">Лев</h3>'
     '<div class="BDPZt  KUbeq"><div>Удача &amp; <b>успех</b></div> и покой</div> мимо</div>'
     '<div class=\'IGRa5\'>до <div class="IGRa5"><i class="_4K6U+ _9dcVo">Рак</i><p class="BDPZt KUbeq">внутри</p></div>'
     '<u class="_9dcVo _4K6U+">не тот</u> после</div><DIV CLASS=IGRa5></DIV></div>'),
    (2, "http://tabs.example/", '<div class="text_box">\n<h6>Рак</h6>' + "\t" * 7 + "<div>Покой</div>\n" + "\t" * 6 + "и сон"
     + "\t" * 7 + "конец</div>" + '<div class="text_box"><h6>Рыбы</h6>пусто</div>'),
    (3, "https://columns.example/x", '<section class="col-xs-12 col-md-6"><a title="</section>" class="x t">Овен</a>'
     '<span class="text">Текст&nbsp;а<br>б</span></section><td class="col-md-6 col-xs-12"><i class="t">нет</i></td>'
     '<section class="col-xs-12"><i class="t">нет</i></section>'),
    (4, "https://single.example", '<h1>Гороскоп <b>на</b> Дева</h1><script>"<div class=p-3>"</script>'
     '<div class="m p-3">День &amp;lt; ночь<div>ещё</div></div><div class="p-3">второй</div>'),
    (5, "https://shared.example", "</li></li><h2>Весы</h2><ul><li>a<li>b<ul><li>c</ul>d</li></ul>x<li>e < f"),
    (6, "https://nowhere.test", '<div class="IGRa5"><h1>x</h1></div>'),
    (7, "https://single.example", None), (8, "https://single.example", ""), (9, None, "<h1>x</h1>"),
]

# Written by hand: what each page holds.
EXPECTED = [
    (1, "cards", "Лев", "Удача & успех и покой"), (1, "cards", "Рак", "внутри"), (1, "cards", "Рак", "внутри"),
    (1, "cards", "", ""),
    (2, "tabs", "Рак", "Покойи сон"), (2, "tabs", "Рыбы", ""),
    (3, "columns", "Овен", "Текст\xa0аб"),
    (4, "single", "Дева", "День &lt; ночьещё"),
    (5, "shared", "Весы", "a"), (5, "shared", "Весы", "bcd"), (5, "shared", "Весы", "c"), (5, "shared", "Весы", "e < f"),
    (7, "single", "", ""), (8, "single", "", ""),
]


def _records(df):
    return sorted((r.page_id, r.source, r.zodiac, r.horo) for r in df.collect())


def test_hand_written_table(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4)
    out = elements.extract_elements(pages, RULES, "2024-03-02", keep=("page_id",))
    assert out.columns == ["page_id", "date", "zodiac", "horo", "source"]
    assert _records(out) == sorted(EXPECTED)
    assert out.first().date == datetime.datetime(2024, 3, 2)


def test_intervals_nest_like_the_tags(spark):
    """Intervals of random well-formed trees against a stack, on deep and wide pages."""
    import random
    import re

    draw, pages = random.Random(3), []
    for page in range(12):
        parts, stack = [], []
        for _ in range(draw.choice([3, 40, 400])):
            if stack and draw.random() < 0.5:
                parts.append(f"</{stack.pop()}>")
            else:
                stack.append(draw.choice(["div", "div", "span", "section", "b"]))
                parts.append(f"<{stack[-1]} class='c{draw.randrange(3)}'>t")
        pages.append((page, "".join(parts) + "".join(f"</{n}>" for n in reversed(stack))))
    df = spark.createDataFrame(pages, "page long, html string")
    events = elements.element_ends(elements.tag_events(df, "html", ("page",)), "page").collect()
    found = {(e.page, e.pos): e.end for e in events if e.kind == 1}
    expected = {}
    for page, html in pages:
        stack = []
        for pos, tag in enumerate(re.findall(r"</?\w+[^>]*>", html), 1):
            if tag.startswith("</"):
                expected[page, stack.pop()] = pos
            else:
                stack.append(pos)
    assert found == expected and len(found) > 500


def test_each_unclosed_element_ends_with_what_is_around_it(spark):
    df = spark.createDataFrame([(1, "<div><i>a<b>b</div>c<b>d<p>e<p>f</p>g")], "page long, html string")
    events = elements.element_ends(elements.tag_events(df, "html", ("page",)), "page").collect()
    ends = [(e.name, e.end) for e in sorted(events, key=lambda e: e.pos) if e.kind == 1]
    assert ends == [("div", 4), ("i", 4), ("b", 4), ("b", None), ("p", 7), ("p", 8)]


def test_one_shuffle_of_events_and_no_python(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    plan = elements.extract_elements(pages, RULES, "2024-03-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Python" not in plan and "CartesianProduct" not in plan


def test_many_tags_on_one_page(spark):
    html = "<div class='item'>" * 20000 + "<b>x</b>" + "</div>" * 20000
    pages = spark.createDataFrame([(1, "http://a.test", html)], "page_id long, url string, html string")
    rule = ElementRule("deep", "a.test", item=Selector("div", "item"), label=Selector("b"))
    out = elements.extract_elements(pages, [rule], "2024-03-02").groupBy("zodiac", "horo").agg(F.count("*").alias("n"))
    assert [tuple(r) for r in out.collect()] == [("x", "x", 20000)]


@pytest.mark.parametrize("columns", [(), ("html", "page_id", "rule", "page")])
def test_kept_columns_may_have_any_name(spark, columns):
    pages = spark.createDataFrame([(1, "https://single.example", "<h1>a b</h1>", 5, 6)],
                                  "page_id long, url string, html string, rule int, page int")
    out = elements.extract_elements(pages, RULES, "2024-03-02", keep=columns)
    assert out.columns == [*columns, "date", "zodiac", "horo", "source"] and out.first().zodiac == "b"
    assert elements.extract_elements(pages.limit(0), RULES, "2024-03-02").count() == 0
