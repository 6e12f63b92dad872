"""Rule-driven record extraction from raw pages."""

import json
from dataclasses import dataclass
from html.entities import html5
from typing import Callable, Optional

from pyspark.sql import functions as F

from tallymill.functions.text import last_token

# Parts of a page whose content is not page text, and any single tag.
_HIDDEN = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_TAG = r"<[^>]*>"
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# The references that pages hold most come first in the lookup.
_COMMON = ["amp", "lt", "gt", "quot", "nbsp", "apos", "laquo", "raquo", "mdash", "ndash", "hellip", "copy", "middot"]


def _named_references():
    """Map of all names to their characters; one JSON literal, which folds to one constant."""
    names = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
    order = _COMMON + sorted(set(names) - set(_COMMON))
    return F.from_json(F.lit(json.dumps({n: names[n] for n in order})), "map<string,string>")


def visible(html):
    """Page source without scripts, styles and comments."""
    return F.regexp_replace(html, _HIDDEN, "")


def _character(code):
    """Text of a code point; U+FFFD where there is no such character."""
    legal = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    number = F.when(legal, code).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def unescape(c):
    """Every named, decimal and hexadecimal character reference replaced, once; what is
    none stays as it stands."""
    named = _named_references()

    def decode(part):
        name = F.regexp_extract(part, _REFERENCE, 1)
        digits = F.conv(F.substring(name, 3, 6), 16, 10).cast("long")
        value = (F.when(name == "", F.lit(None).cast("string"))
                 .when(F.lower(F.substring(name, 1, 2)) == "#x", _character(digits))
                 .when(F.startswith(name, F.lit("#")), _character(F.substring(name, 2, 7).cast("long")))
                 .otherwise(F.try_element_at(named, name)))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        return F.coalesce(F.concat(value, rest), F.concat(F.lit("&"), part))

    def one(x):
        decoded = F.transform(F.split(x, "&"), lambda part, i: F.when(i == 0, part).otherwise(decode(part)))
        return F.when(F.contains(x, F.lit("&")), F.array_join(decoded, "")).otherwise(x)

    # A one-element array names the text, which is thereby computed once.
    return F.get(F.transform(F.array(c), one), 0)


def plain_text(fragment):
    """Tags removed, character references decoded."""
    return unescape(F.regexp_replace(fragment, _TAG, ""))


def tabbed_cut(c):
    """Second piece of a text laid out with tabs: the line ends are dropped, runs
    of seven tabs delimit, runs of six are deleted; empty if there is no cut.

    The delimiter's stand-in is the letters ``li``, so a text holding them is cut
    there too."""
    # Tab run lengths and the stand-in.
    c = F.replace(F.replace(c, F.lit("\n"), F.lit("")), F.lit("\t" * 7), F.lit("li"))
    return F.coalesce(F.replace(F.get(F.split(c, "li"), 1), F.lit("\t" * 6), F.lit("")), F.lit(""))


@dataclass(frozen=True)
class PageRule:
    """How one source lays out its records.

    ``item`` selects repeated blocks (the page is one block without it); ``label``
    and ``text`` are regexes with one group, tried on the block, or on the page
    where ``label_on_page``. A piece that is not found is an empty string.
    """
    source: str
    host: str
    label: str
    text: str
    item: Optional[str] = None
    label_on_page: bool = False
    label_last_word: bool = False
    finish: Optional[Callable] = None


def _label(rule, part):
    label = plain_text(F.regexp_extract(part, rule.label, 1))
    return last_token(label) if rule.label_last_word else label


def _record(rule, block):
    label = F.col("_page_label") if rule.label_on_page else _label(rule, block)
    text = plain_text(F.regexp_extract(block, rule.text, 1))
    if rule.finish:
        text = rule.finish(text)
    return F.struct(label.alias("zodiac"), text.alias("horo"), F.lit(rule.source).alias("source"))


def _records(rule, page):
    blocks = F.regexp_extract_all(page, F.lit(rule.item), F.lit(1)) if rule.item else F.array(page)
    return F.transform(blocks, lambda block: _record(rule, block))


def _by_host(rules, value):
    """Value of the first rule whose host suffix fits the page's host."""
    chain = F
    for rule in rules:
        chain = chain.when(F.endswith(F.col("_host"), F.lit(rule.host)), value(rule))
    return chain


def host(url="url"):
    return F.regexp_extract(url, r"^https?://([^/?#:]+)", 1)


def extract_records(pages, rules, run_date, keep=()):
    """Pages -> ``(date, zodiac, horo, source)``, one scan for all sources.

    The first rule whose host suffix fits the page's host applies; pages of
    unknown hosts give no record.
    """
    page = F.col("_page")
    parts = pages.select(*keep, visible("html").alias("_page"), host().alias("_host"))
    # A label that stands once per page is read once, not once per block.
    labelled = parts.withColumn("_page_label", _by_host(
        rules, lambda r: _label(r, page) if r.label_on_page else F.lit("")))
    return (
        labelled.select(*keep, F.explode(_by_host(rules, lambda r: _records(r, page))).alias("_r"))
        .select(*keep, F.to_timestamp(F.lit(str(run_date))).alias("date"), "_r.*")
    )


def unify(frames):
    """Union of per-source record tables by column name."""
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def load_rules(path):
    """Page rules from a JSON file: a list of objects with the fields of ``PageRule``;
    ``finish`` may name the tab layout (``"tabbed_cut"``)."""
    named = {"tabbed_cut": tabbed_cut, None: None}
    with open(path, encoding="utf-8") as f:
        return [PageRule(**{**rule, "finish": named[rule.get("finish")]}) for rule in json.load(f)]


def _resolve(path):
    """A path without ``.`` and ``..`` segments."""
    def step(done, part):
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends_open = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(ends_open, F.lit("/")).otherwise(F.lit("")))


def absolute_url(href, page_url):
    """A link as a full address: with its own scheme as it is, else relative to the page
    (``//host``, ``/path``, ``?query``, ``#part``, ``path``, ``../path``)."""
    site = F.regexp_extract(page_url, r"^(https?://[^/?#]+)", 1)
    address = F.regexp_extract(page_url, r"^https?://[^/?#]+([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(address, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    path, tail = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"([?#].*)$", 1)
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href))
            .when(F.startswith(href, F.lit("/")), F.concat(site, _resolve(path), tail))
            .when(F.startswith(href, F.lit("?")), F.concat(site, address, href))
            .when(F.startswith(href, F.lit("#")), F.concat(F.regexp_extract(page_url, r"^([^#]*)", 1), href))
            .otherwise(F.concat(site, _resolve(F.concat(folder, path)), tail)))


_ANCHOR = r"""(?is)<a\s(?:"[^"]*"|'[^']*'|[^'">])*>"""


def _attribute(tag, name):
    """Value of a tag's attribute, quoted either way or not at all; empty without it."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def discover_links(pages, css_class=None):
    """``(page_id, link)`` for every anchor outside scripts and comments, or for those that
    carry a class. Links are decoded and absolute; anchors without one are left out."""
    anchors = F.regexp_extract_all(visible("html"), F.lit(_ANCHOR), F.lit(0))
    tags = pages.select("page_id", "url", F.explode(anchors).alias("tag"))
    if css_class:
        tags = tags.filter(F.array_contains(F.split(_attribute(F.col("tag"), "class"), r"\s+"), css_class))
    href = F.trim(unescape(_attribute(F.col("tag"), "href")))
    return (tags.select("page_id", "url", href.alias("href")).filter("href <> ''")
            .select("page_id", absolute_url(F.col("href"), F.col("url")).alias("link")))
