"""Record extraction by elements: nested blocks selected by tag and class.

A page is read into tag events, and an element is the interval between two of them.
End tags are matched per tag name by level: a running sum of begin and end tags,
reflected at zero so that stray end tags count nothing.  On one level begin and end
alternate, so an element's end is its successor there, however deep it nests and
whatever other tags stay open inside it.  What is inside an element is then a
comparison of positions, and the first inner element of a kind is the next event of
that kind: all selectors of all sources take one pass of running values over a
page's events, behind a single shuffle.

Texts do not take part in that pass.  An event knows how much text stands before it,
so an element's text is a slice of the page without its tags.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Callable, Optional

from pyspark.sql import functions as F, Window

from tallymill.functions.text import last_token
from tallymill.operators.extract import _attribute, host, unescape, visible
from tallymill.session import materialise

# Any tag; a quoted attribute value may hold angle brackets.
_TAG = r"""<[/!?]?[A-Za-z][^\s/>]*(?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
_TOKEN = f"[^<]*(?:{_TAG}|<|$)"
# Elements without content; elements whose end tag may be left out, and what ends them.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENDED_BY = {"p": "p", "li": "li", "option": "option", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td"}


@dataclass(frozen=True)
class Selector:
    """Elements of a tag name, of classes, or of both.

    One class is sought among an element's classes; several must be all that it has, in
    their order.
    """
    tag: Optional[str] = None
    classes: Optional[str] = None

    def matches(self, name, classes):
        conditions = [F.lit(True)]
        if self.tag:
            conditions.append(name == self.tag.lower())
        if self.classes:
            wanted = " ".join(self.classes.split())
            conditions.append((classes == wanted) if " " in wanted else F.array_contains(F.split(classes, " "), wanted))
        return reduce(and_, conditions)


@dataclass(frozen=True)
class ElementRule:
    """How one source lays out its records.

    ``item`` selects the record elements, nested ones included; the whole page is one record
    without it.  ``label`` and ``text`` are the first such elements inside an item (with
    ``label_on_page``: on its page); without ``text`` it is the item's own.  What is not found
    is an empty string.
    """
    source: str
    host: str
    label: Selector
    text: Optional[Selector] = None
    item: Optional[Selector] = None
    label_on_page: bool = False
    label_last_word: bool = False
    finish: Optional[Callable] = None


def _any_rule(rules, value):
    """Condition of the page's own rule; false where the rule has none."""
    return reduce(or_, [(F.col("rule") == i) & value(r) for i, r in enumerate(rules)], F.lit(False))


def tag_events(pages, page, columns=()):
    """One row per tag and page: ``pos``, its ``name`` and ``classes``, ``kind`` (1 begins, -1 ends,
    0 neither) and ``at``, the length of the page's text before it.  Event 0 is the page itself."""
    tokens = F.concat(F.array(F.lit("")), F.regexp_extract_all(page, F.lit(_TOKEN), F.lit(0)))
    tag = F.regexp_extract("token", _TAG, 0)
    name = F.lower(F.regexp_extract("tag", r"^</?([A-Za-z][^\s/>]*)", 1))
    kind = (F.when((F.col("name") == "") | F.col("name").isin(*VOID), 0)
            .when(F.startswith("tag", F.lit("</")), -1).otherwise(1))
    classes = F.when(F.col("kind") == 1, F.trim(F.regexp_replace(_attribute(F.col("tag"), "class"), r"\s+", " "))).otherwise("")
    events = (pages.select(*columns, F.posexplode(tokens).alias("pos", "token")).withColumn("tag", tag)
              .select(*columns, "pos", "tag", name.alias("name"), (F.length("token") - F.length("tag")).alias("text"))
              .withColumn("kind", kind))
    before = Window.partitionBy(columns[0]).orderBy("pos")
    return events.select(*columns, "pos", "name", "kind", classes.alias("classes"),
                         F.sum("text").over(before).cast("bigint").alias("at"))


def element_ends(events, page):
    """Events with ``end`` and ``end_at``, position and text offset of an element's end: null if
    it ends with the page.

    List items, cells and paragraphs end at the next of their kind on their level; they, and
    elements that are never closed, end at the latest with the closed element around them.
    """
    optional = F.col("name").isin(*ENDED_BY)
    by_name = Window.partitionBy(page, "name").orderBy("pos")
    upto = by_name.rowsBetween(Window.unboundedPreceding, 0)
    level = events.withColumn("sum", F.sum("kind").over(upto))
    level = level.withColumn("level", F.col("sum") - F.least(F.min("sum").over(upto), F.lit(0)))
    before = F.coalesce(F.lag("level").over(by_name), F.lit(0))
    # Begin and end of one element share a slot; a stray end tag has none.
    level = level.withColumn("slot", F.when((F.col("kind") == 0) | optional, 0).when(F.col("kind") == 1, F.col("level"))
                             .when(before == 0, 0).otherwise(F.col("level") + 1))
    in_slot = Window.partitionBy(page, "name", "slot").orderBy("pos")
    paired = F.col("slot") > 0
    begins = paired & (F.col("kind") == 1) & (F.lead("kind").over(in_slot) == -1)
    closes = paired & (F.col("kind") == -1) & (F.lag("kind").over(in_slot) == 1)
    span = lambda: F.struct(F.col("pos").alias("end"), F.col("at").alias("end_at"))
    ended = level.select(*events.columns, F.coalesce(closes, F.lit(False)).alias("closes"),
                         F.when(begins, F.lead(span()).over(in_slot)).alias("own"))
    # Depth by closed elements only: whatever stays open is inside the innermost of them.
    step = F.when(F.col("closes"), -1).when(F.col("own").isNotNull(), 1).otherwise(0)
    deep = ended.withColumn("depth", F.sum(step).over(Window.partitionBy(page).orderBy("pos")))
    kinds = F.create_map(*[F.lit(x) for pair in ENDED_BY.items() for x in pair])
    like = Window.partitionBy(page, F.coalesce(kinds[F.col("name")], F.col("name")), "depth").orderBy("pos")
    around = F.when(F.col("closes"), F.col("depth") + 1).otherwise(F.col("depth"))
    deep = deep.withColumns({"next": F.when(optional & (F.col("kind") == 1), F.lead(span()).over(like)), "around": around})
    later = Window.partitionBy(page, "around").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    deep = deep.withColumn("close", F.last(F.when(F.col("closes"), span()), ignorenulls=True).over(later))
    end = F.coalesce("own", F.when(F.col("kind") == 1, F.when(F.col("depth") > 0, F.least("next", "close")).otherwise(F.col("next"))))
    return deep.withColumn("own", end).select(*events.columns, "own.end", "own.end_at")


def _found(part, end):
    """Offsets of an inner element that begins before the item ends."""
    return F.when(F.col(f"{part}.pos") < end, F.col(part))


def extract_elements(pages, rules, run_date, keep=()):
    """Pages -> ``(date, zodiac, horo, source)`` by :class:`ElementRule`, one pass for all sources.

    The first rule whose host suffix fits the page's host applies; pages of unknown hosts give
    no record.  Only tag positions are shuffled beside the pages' plain text.
    """
    chain = F
    for i, rule in enumerate(rules):
        chain = chain.when(F.endswith(host(), F.lit(rule.host)), i)
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    names = [f"_keep{i}" for i in range(len(keep))]
    known = materialise(pages.select(*kept, chain.otherwise(None).alias("rule"), F.coalesce(visible("html"), F.lit("")).alias("html"))
                        .where("rule IS NOT NULL")
                        .withColumn("page", F.monotonically_increasing_id()), "known-pages")
    events = element_ends(tag_events(known, "html", ("page", "rule")), "page")
    begins = F.col("kind") == 1
    select = lambda which: _any_rule(rules, lambda r: which(r).matches(F.col("name"), F.col("classes")) if which(r) else F.lit(False))
    whole_page = _any_rule(rules, lambda r: F.lit(r.item is None)) & (F.col("pos") == 0)
    span = F.struct("pos", "at", "end_at")
    marked = events.select("page", "rule", "pos", "at", "end", "end_at",
                           (whole_page | (begins & select(lambda r: r.item))).alias("is_item"),
                           F.when(begins & select(lambda r: r.label), span).alias("is_label"),
                           F.when(begins & select(lambda r: r.text), span).alias("is_text"))
    # Read backwards, the last one met is the next one of the page.
    later = Window.partitionBy("page").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumns({c: F.last(f"is_{c}", ignorenulls=True).over(later) for c in ("label", "text")})
    if any(r.label_on_page for r in rules):
        first = F.min("is_label").over(Window.partitionBy("page"))
        marked = marked.withColumn("first_label", first)
    else:
        marked = marked.withColumn("first_label", F.lit(None).cast("struct<pos:int,at:bigint,end_at:bigint>"))
    end = F.coalesce("end", F.lit(1 << 31).cast("bigint"))
    own_text = _any_rule(rules, lambda r: F.lit(r.text is None))
    on_page = _any_rule(rules, lambda r: F.lit(r.label_on_page))
    items = marked.where("is_item").select(
        "page", F.when(on_page, F.col("first_label")).otherwise(_found("label", end)).alias("label"),
        F.when(own_text, span).otherwise(_found("text", end)).alias("text"))
    plain = known.select("page", "rule", *names, F.regexp_replace("html", _TAG, "").alias("plain"))

    def slice_of(part):
        stop = F.coalesce(F.col(f"{part}.end_at"), F.length("plain"))
        cut = F.substring(F.col("plain"), (F.col(f"{part}.at") + 1).cast("int"), (stop - F.col(f"{part}.at")).cast("int"))
        return F.when(F.col(part).isNull(), "").otherwise(unescape(cut))

    cut = items.join(plain, "page").select("rule", *names, slice_of("label").alias("zodiac"), slice_of("text").alias("horo"))
    by_rule = lambda value: reduce(lambda c, pair: c.when(F.col("rule") == pair[0], value(pair[1])), enumerate(rules), F)
    return cut.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], F.to_timestamp(F.lit(str(run_date))).alias("date"),
        by_rule(lambda r: last_token("zodiac") if r.label_last_word else F.col("zodiac")).alias("zodiac"),
        by_rule(lambda r: r.finish(F.col("horo")) if r.finish else F.col("horo")).alias("horo"),
        by_rule(lambda r: F.lit(r.source)).alias("source"))
