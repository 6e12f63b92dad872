import re
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallymill.functions import tags, text
from tallymill.operators.extract import tabbed_cut


def run(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", column.alias("o")).orderBy("i").collect()]


def fold(s, symbols, passes):
    for x in list(symbols) * passes:
        s = s.replace(x, "")
    return s


ARTEFACTS = ["a..., b", "a,.. b", "a.?!.b", "слово , слово . Ещё : раз", "?.?. ..", "да?? нет?! что.?", "«. »тест",
             ".или .и  ..", " .,::,,", "", "a.:.b", "? . ?. ."]


@pytest.mark.parametrize("symbols,passes", [(text.EVAL_SYMBOLS, 1), (text.EVAL_SYMBOLS, 2),
                                            (text.BOT_SYMBOLS, 3)])
def test_ordered_removal(spark, symbols, passes):
    got = run(spark, ARTEFACTS, text.remove_symbols("t", symbols, passes))
    assert got == [fold(s, symbols, passes) for s in ARTEFACTS]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" .,:?!«»иляб", max_size=40), min_size=1, max_size=30))
def test_ordered_removal_on_any_text(spark, values):
    got = run(spark, values, text.remove_symbols("t", text.BOT_SYMBOLS, 3))
    assert got == [fold(s, text.BOT_SYMBOLS, 3) for s in values]


def test_pass_count_and_order_matter():
    assert fold("a,.. b", text.EVAL_SYMBOLS, 1) == "a, b"
    assert fold("a,.. b", text.EVAL_SYMBOLS[::-1], 1) == "a. b"
    assert fold("a.?!.b", text.EVAL_SYMBOLS, 1) == "a..b"
    assert fold("a.?!.b", text.EVAL_SYMBOLS, 2) == "ab"


def test_symbol_lists():
    assert len(text.EVAL_SYMBOLS) == 14 and len(text.BOT_SYMBOLS) == 21


def test_marker_cut_strips_only_where_it_cuts(spark):
    assert run(spark, [" a </s> b", " a ", "\u3000x\n</s></s>", "</s>"],
               text.cut_at_marker("t")) == ["a", " a ", "x", ""]


def test_marker_is_cut_before_its_brackets_are_filtered(spark):
    assert run(spark, ["Да.</s> Нет"], text.clean_generated("t", "bot")) == ["Да."]


def test_allow_lists_differ(spark):
    s = "Лев«а»-б;x1"
    got = run(spark, [s], F.concat_ws("|", *[text.keep_allowed("t", c) for c in (
        text.CORPUS_ALLOW, text.EVAL_ALLOW, text.BOT_ALLOW)]))
    assert got == ["Лев«а»-б;|Лев«а»б;|Лева-б;"]


def test_white_space_squeeze_matches_python_split(spark):
    values = ["  a \t b\n\nc ", "x\u00a0\u2003y", "\u3000", "", "a\x1cb\x85c d", "plain"]
    assert run(spark, values, text.squeeze_spaces("t")) == [" ".join(v.split()) for v in values]


def test_every_python_space_is_covered(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert run(spark, [f"a{s}b" for s in spaces], text.squeeze_spaces("t")) == ["a b"] * len(spaces)


def test_cut_at_first_no_break_space_leaves_none(spark):
    assert run(spark, ["a\u00a0b\u00a0c", "abc", "\u00a0x"], text.first_part("t")) == ["a", "abc", ""]
    cleaned = run(spark, ["да\u00a0нет"], text.clean_corpus_text("t"))
    assert cleaned == ["да"]


def test_last_token_and_lengths(spark):
    assert run(spark, ["Гороскоп на сегодня Лев", "Лев", "x "], text.last_token("t")) == ["Лев", "Лев", ""]
    assert run(spark, ["ёж"], F.length("t").cast("string")) == ["2"]


def test_contains_any(spark):
    got = run(spark, ["привет, мир", "мир", ""], text.contains_any("t", ["привет", "hi"]))
    assert got == [True, False, False]


def test_tabbed_cut(spark):
    t7, t6 = "\t" * 7, "\t" * 6

    def by_hand(s):
        parts = s.replace("\n", "").replace(t7, "li").split("li")
        return parts[1].replace(t6, "") if len(parts) > 1 else ""

    values = [f"Лев{t7}текст{t6}конец{t7}x", "без табов", f"a\n{t7}b\nc", "ali b", ""]
    assert run(spark, values, tabbed_cut(F.col("t"))) == [by_hand(v) for v in values]


def test_label_mapping(spark):
    df = spark.createDataFrame([("LABEL_1", "negative"), ("LABEL_0", "neutral"), (None, None)],
                               "g string, s string")
    got = df.select(tags.acceptable("g"), tags.non_negative("s")).collect()
    assert [tuple(r) for r in got] == [(1, 0), (0, 1), (0, 1)]


def test_corpus_text_agrees_with_a_plain_reading(spark):
    def by_hand(s):
        s = s.split("\u00a0")[0].replace("\n", "")
        return re.sub("[^а-яА-ЯЁё !.,:?;«»-]+", "", s)

    values = [string.printable + "Ёжик; «да»", "а\nб\u00a0в", "", "12 34"]
    assert run(spark, values, text.clean_corpus_text("t")) == [by_hand(v) for v in values]
