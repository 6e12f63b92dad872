"""Main text of web pages, with what a host repeats taken out.

A page is cut into blocks of text.  Blocks in elements that never hold the
article (menus, footers, forms, adverts ...) are dropped, blocks of an explicit
article element are kept, and the rest is decided by the host: the token streams
of all its pages outside articles are concatenated, and their suffixes ordered
by their first ``MIN_RUN`` tokens, as in a suffix array cut at that depth.
Suffixes of distinct pages that are neighbours there, with equal beginnings,
mark a long repeated run; a block that repeated runs cover almost whole is
boilerplate, and the unique ones stay.

A page without an article element may have its whole text on other pages of the
host: copies under other addresses, print views, quotations.  Such pages with
equal streams are one page, a run needs ``MIN_PAGES`` of them to count as repeated,
and what fewer pages repeat than the host's commonest blocks stays where it is the
larger part of what those leave.

The order is that of a shuffle by the hash of host and tokens: equal beginnings
meet as one partially aggregated group, so neither a large host nor a menu that
stands on all its pages fills a task.
"""

import re
from collections import Counter
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from tallymill.session import materialise

MIN_RUN = 6
MIN_PAGES = 3
COVERED = 0.8
COMMON = 0.5

DROPPED, ARTICLE, OPEN = range(3)
PLAIN, UNLESS, NEVER = range(3)

# Element and class names.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "canvas", "video",
        "audio", "select", "button"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
           "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
           "math", "mfrac", "mi", "mn", "mo", "mroot", "mrow", "ms", "msqrt", "msub", "msubsup", "msup", "mtext"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
          "menubar", "toolbar"}
_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo",
          "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent",
          "gdpr", "notice", "notices", "banner", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "share",
          "sharing", "social", "related", "recommended", "comment", "comments", "commentlist", "disqus", "widget", "widgets",
          "pagination", "pager", "masthead", "footer", "login", "search", "toolbar"}
# A wrapper of these holds no article of the page, even where an article element stands in it.
_NEVER = {"nav", "footer", "aside", "menu", "dialog", "head"}
_NEVER_ROLES = {"navigation", "contentinfo", "complementary", "dialog", "alert", "alertdialog", "menu", "menubar"}
_NEVER_WORDS = {"comment", "comments", "commentlist", "disqus", "related", "recommended"}
_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
_OUTSIDE_WORDS = {"header", "topbar", "copyright", "legal"}
_CLOSES_P = {"p", "div", "ul", "ol", "li", "dl", "table", "section", "article", "main", "header", "footer", "nav", "aside", "form",
             "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figure", "hr", "address", "fieldset"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _mark(name, attributes, in_article):
    """PLAIN, or by name, role, class and id: UNLESS an element never holds article text but around an
    article element, NEVER if not even then.

    Class and id of paragraphs and headings of an article, and the id of its sections,
    tell what the text is about."""
    mark = NEVER if name in _NEVER else UNLESS if name in _BOILERPLATE or (name == "header" and not in_article) else PLAIN
    if not attributes.strip() or name in ("html", "body", "article", "main"):
        return mark
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return NEVER
        if key == "role" and value.lower() in _ROLES:
            mark = max(mark, NEVER if value.lower() in _NEVER_ROLES else UNLESS)
        if key in ("class", "id") and not (in_article and name in _TEXT):
            words = {w for part in value.split() for w in _SPLIT.split(part.lower())}
            if words & _NEVER_WORDS:
                return NEVER
            if in_article and name == "section" and key == "id":
                continue
            if words & _WORDS or (not in_article and words & _OUTSIDE_WORDS):
                mark = max(mark, UNLESS)
    return mark


def blocks(html):
    """(text, state) of the blocks of a page in order; states DROPPED, ARTICLE, OPEN.

    References are decoded, white space is one space, empty blocks are left out.
    Elements that are not closed end with the element around them or the page. An
    element around an article is not dropped for its name, class or id, except one of
    those that hold other articles: menus, asides, footers, comments."""
    out, around = _blocks(html, frozenset())
    return _blocks(html, around)[0] if around else out


def _blocks(html, kept):
    """The blocks of a page, and where dropped elements around article elements begin; those in
    ``kept`` are not dropped."""
    out, buffer, stack, around = [], [], [], set()  # stack: (name, state inside, begin, in an element of NEVER)
    state, at = OPEN, 0
    standing = Counter()  # open elements by name: a closing tag without one is not looked for

    def flush():
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                out.append((text, state))

    while True:
        match = _MARKUP.search(html, at)
        if match is None:
            buffer.append(html[at:])
            flush()
            return out, around
        if match.start() > at:
            buffer.append(html[at:match.start()])
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        name, attributes = name.lower(), match.group(3)
        if match.group(1):
            if standing[name]:
                flush()
                closed = None
                while closed != name:
                    closed = stack.pop()[0]
                    standing[closed] -= 1
                state = stack[-1][1] if stack else OPEN
            elif name not in _INLINE:
                flush()
            continue
        if name in _RAW and not attributes.endswith("/"):
            flush()
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        if name in _INLINE and not attributes:
            continue
        if name in _VOID:
            if name not in _INLINE:
                flush()
            continue
        mark = _mark(name, attributes, state == ARTICLE)
        marked = state != DROPPED and (mark == NEVER or (mark == UNLESS and match.start() not in kept))
        if name in _INLINE and not marked:
            continue
        flush()
        if name in _CLOSES_P and stack and stack[-1][0] == "p":
            standing[stack.pop()[0]] -= 1
            state = stack[-1][1] if stack else OPEN
            mark = _mark(name, attributes, state == ARTICLE)
            marked = state != DROPPED and (mark == NEVER or (mark == UNLESS and match.start() not in kept))
        if attributes.endswith("/") and name not in ("p", "div"):
            continue
        inside = DROPPED if marked or state == DROPPED else ARTICLE if name in ("article", "main") else state
        never = mark == NEVER or bool(stack and stack[-1][3])
        if name in ("article", "main") and inside == DROPPED and not never:
            for _, held, begin, _ in reversed(stack):
                if held != DROPPED or begin in around:
                    break
                around.add(begin)
        stack.append((name, inside, match.start(), never))
        standing[name] += 1
        state = inside


def outside_tokens(parts):
    """Tokens of the blocks outside articles, and the number of the block each is from."""
    tokens, owner = [], []
    for i, (text, state) in enumerate(parts):
        if state != ARTICLE:
            words = text.split()
            tokens += words
            owner += [i] * len(words)
    return tokens, owner


def suffixes(pages, min_run=MIN_RUN):
    """``page, source, site, run, pos, is_open``: the first tokens of every suffix of every page's stream
    outside articles as one hash with the host; ``is_open`` where they touch an undecided
    block.  A shorter stream is one run.  ``source`` tells pages apart: by their rows, and
    without an article by their streams; ``site`` is the hash of the host."""
    schema = "page long, source long, site long, run long, pos int, is_open boolean"
    hashed = lambda text, seed: int(np.uint64(xxhash.xxh64_intdigest(text, seed)).view(np.int64))

    def cut(batches):
        for batch in batches:
            out = []
            for page, host, html in zip(batch["page"], batch["host"], batch["html"]):
                parts = blocks(html)
                tokens, owner = outside_tokens(parts)
                is_open = [parts[i][1] == OPEN for i in owner]
                seed = xxhash.xxh64_intdigest((host or "").encode("utf-8", "surrogatepass"))
                site = int(np.uint64(seed).view(np.int64))
                source = page if has_article(parts) else hashed("\0".join(tokens).encode("utf-8", "surrogatepass"), seed)
                for pos in range(max(1, len(tokens) - min_run + 1) if tokens else 0):
                    run = "\0".join(tokens[pos:pos + min_run]).encode("utf-8", "surrogatepass")
                    out.append((page, source, site, hashed(run, seed), pos, any(is_open[pos:pos + min_run])))
            yield pd.DataFrame(out, columns=["page", "source", "site", "run", "pos", "is_open"])

    return pages.mapInPandas(cut, schema)


def has_article(parts):
    """Whether blocks hold text of an article element."""
    return any(state == ARTICLE for _, state in parts)


def _keyed(pages):
    """Pages with a hash of the whole row as ``page``, and their host."""
    return pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
        F.xxhash64("page_id", "url", "html").alias("page"),
        F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/:?#]+)", 1).alias("host"))


def repeated_positions(keyed, min_run=MIN_RUN):
    """``page, covered``: where runs that other pages of the host repeat begin in a page's stream, on
    how many pages they stand, and whether that is near the most of any run of the host,
    for pages with undecided blocks among them."""
    stored = materialise(suffixes(keyed.select("page", "host", "html"), min_run), "suffixes")
    # Written before the join, so that a run on very many pages can be split there.
    counted = materialise(stored.groupBy("site", "run").agg(F.countDistinct("source").alias("n")).where("n > 1"), "counted-runs")
    most = materialise(counted.groupBy("site").agg(F.max("n").alias("most")), "commonest-runs")
    repeated = materialise(counted.join(most, "site").select("run", "n", (F.col("n") > F.col("most") * COMMON).alias("common")),
                           "repeated-runs")
    covered = (stored.where("is_open").join(repeated, "run")
               .groupBy("page").agg(F.collect_set(F.struct("pos", "n", "common")).alias("covered")))
    return materialise(covered, "covered")


def _repeated_blocks(parts, starts, min_run):
    """Undecided blocks that runs beginning at ``starts`` cover almost whole."""
    _, owner = outside_tokens(parts)
    inside = np.zeros(len(owner) + min_run + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + min_run, -1)
    hit = np.cumsum(inside)[:len(owner)] > 0
    of, hits = np.bincount(owner, minlength=len(parts)), np.bincount(owner, weights=hit, minlength=len(parts))
    return {i for i, (_, state) in enumerate(parts) if state == OPEN and hits[i] >= COVERED * of[i]}


def main_text(parts, covered, on=None, common=None, min_run=MIN_RUN):
    """The article of a page's blocks, given where its repeated runs begin, on how many pages each
    stands, and whether it is common on the host."""
    dropped = set()
    if any(state == OPEN for _, state in parts) and covered is not None and len(covered):
        starts = np.asarray(covered)
        if has_article(parts):
            dropped = _repeated_blocks(parts, starts, min_run)
        else:
            several = np.asarray(on) >= MIN_PAGES
            dropped = _repeated_blocks(parts, starts[several], min_run)
            commonest = _repeated_blocks(parts, starts[several & np.asarray(common, bool)], min_run)
            size = lambda chosen: sum(len(parts[i][0].split()) for i in chosen)
            alone = {i for i, (_, state) in enumerate(parts) if state == OPEN} - dropped
            if size(dropped - commonest) > size(alone):
                dropped = commonest
            elif not alone:
                dropped = set()
    return " ".join(text for i, (text, state) in enumerate(parts) if state != DROPPED and i not in dropped)


def _extract(html, covered):
    @F.pandas_udf("string")
    def text(htmls: pd.Series, wheres: pd.Series, ons: pd.Series, commons: pd.Series) -> pd.Series:
        return pd.Series([main_text(blocks(h), *runs) for h, *runs in zip(htmls, wheres, ons, commons)], dtype=object)

    return text(html, *(F.col(covered)[k] for k in ("pos", "n", "common")))


def extract(pages):
    """``page_id, url, text, n_chars`` for every row.

    Null and empty pages and pages without text give the empty text.  A repeated
    row is one page to its host, so it is no evidence against itself; it gives a
    repeated result.  So are pages without an article that differ in markup only.  Pages without a host share one.  Other columns are not read.
    An empty table gives no rows.
    """
    keyed = _keyed(pages)
    text = _extract("html", "covered")
    return (keyed.join(repeated_positions(keyed), "page", "left")
            .select("page_id", "url", text.alias("text"))
            .select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")))
