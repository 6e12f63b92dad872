"""Queries over texts, pages and messages."""

from functools import reduce

from pyspark.sql import functions as F

from tallymill import schemas
from tallymill.functions import tags, text
from tallymill.operators import clean, elements, evaluate, extract, lookup, routing
from tallymill.operators.elements import ElementRule, Selector
from tallymill.operators.extract import PageRule
from tallymill.plans.catalog import query
from tallymill.plans.views import CORPUS, GENERATIONS, corpus, generations, table
from tallymill.session import materialise, scratch_path
from tallymill.sources import files, quoted

_ANY = r"[^\p{L} !.,:?;«»-]+"
_CLEAN_HORO = (rf"regexp_replace(replace(replace(split_part(horo, chr(160), 1), chr(10), ''), chr(160), ''),"
               rf" '{_ANY}', '', 'g')")
_CLEAN_CORPUS = CORPUS + f""",
cleaned as (
  select distinct date, zodiac, horo, source from (
    select date, zodiac, {_CLEAN_HORO} as horo, source from corpus
    where date is not null and zodiac is not null and horo is not null and source is not null
      and zodiac not in ('Гороскоп на сегодня', 'Для всех знаков зодиака.'))
  where length(horo) < 500 and length(horo) > 300
)"""


def any_script(c):
    return text.clean_corpus_text(c, text.ANY_LETTER_ALLOW)


@query("clean_text", f"with {_CLEAN_CORPUS} select * from cleaned")
def clean_text(spark, sf_dir):
    return clean.clean_corpus(corpus(spark, sf_dir), any_script)


@query("csv_corpus_clean", f"with {_CLEAN_CORPUS} select * from cleaned")
def csv_corpus_clean(spark, sf_dir):
    """Round trip through CSV records holding quoted line breaks."""
    path = scratch_path(spark, "corpus-csv")
    files.append_records(corpus(spark, sf_dir), path, fmt="csv")
    return clean.clean_corpus(files.read_corpus_csv(spark, path), any_script)


@query("csv_corpus_ranges", f"with {_CLEAN_CORPUS} select * from cleaned")
def csv_corpus_ranges(spark, sf_dir):
    """The same round trip, each file read in ranges of 128 KB that begin anywhere."""
    path = scratch_path(spark, "corpus-csv")
    files.append_records(corpus(spark, sf_dir), path, fmt="csv")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128k")
    try:
        rows = materialise(quoted.read_quoted_csv(spark, path, schemas.CORPUS), "corpus-rows")
    finally:
        spark.conf.set(key, before)
    return clean.clean_corpus(rows, any_script)


@query("text_dedup", f"""
with {CORPUS} select zodiac, source, count(*)::bigint as n_texts, sum(length(horo))::bigint as n_chars
from (select distinct date, zodiac, {_CLEAN_HORO} as horo, source from corpus) group by all""")
def text_dedup(spark, sf_dir):
    distinct = (corpus(spark, sf_dir).withColumn("horo", any_script("horo")).dropDuplicates())
    return distinct.groupBy("zodiac", "source").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("horo")).alias("n_chars"))


_SPACE = (r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}]+")


@query("train_pairs", f"""
with {_CLEAN_CORPUS}, p as (
  select *, trim(regexp_replace(zodiac, '{_SPACE}', ' ', 'g')) as s,
         trim(regexp_replace(horo, '{_SPACE}', ' ', 'g')) as h from cleaned)
select case when substr(md5(concat_ws('|', zodiac, horo, '42')), 1, 8) < 'b3333333'
            then 'train' else 'val' end as split,
  s as source_text, horo as target_text, length(s)::int as source_chars,
  length(horo)::int as target_chars, len(string_split(h, ' '))::int as target_words
from p""")
def train_pairs(spark, sf_dir):
    return evaluate.train_pairs(clean.clean_corpus(corpus(spark, sf_dir), any_script))


# Texts with the punctuation artefacts of a text generator put in.
def _artefacts(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "concat(replace(replace(text, '. ', CASE WHEN doc_id % 2 = 0 THEN '... ' ELSE ' . ' END),"
        " ', ', CASE WHEN doc_id % 3 = 0 THEN ',. ' ELSE ' , ' END),"
        " CASE WHEN doc_id % 4 = 0 THEN ' </s> tail' ELSE '' END) AS gen_text")


_ARTEFACTS = """
g as (
  select doc_id, replace(replace(text, '. ', case when doc_id % 2 = 0 then '... ' else ' . ' end),
    ', ', case when doc_id % 3 = 0 then ',. ' else ' , ' end)
    || case when doc_id % 4 = 0 then ' </s> tail' else '' end as gen_text from documents
),
cut as (
  select doc_id, case when contains(gen_text, '</s>')
    then regexp_replace(regexp_replace(split_part(gen_text, '</s>', 1), '^""" + _SPACE + """', ''),
                        '""" + _SPACE + """$', '')
    else gen_text end as c from g
)"""


def _removed(expr, symbols, passes):
    return reduce(lambda e, s: f"replace({e}, '{s}', '')", list(symbols) * passes, expr)


@query("clean_generated", f"""
with {_ARTEFACTS} select doc_id, {_removed(f"regexp_replace(c, '{_ANY}', '', 'g')",
                                           text.EVAL_SYMBOLS, 2)} as clean_text from cut""")
def clean_generated(spark, sf_dir):
    return _artefacts(spark, sf_dir).select("doc_id", text.clean_generated(
        "gen_text", "eval", text.ANY_LETTER_ALLOW).alias("clean_text"))


@query("clean_generated_bot", f"""
with {_ARTEFACTS} select doc_id, {_removed(f"regexp_replace(c, '{_ANY}', '', 'g')",
                                           text.BOT_SYMBOLS, 3)} as clean_text from cut""")
def clean_generated_bot(spark, sf_dir):
    return _artefacts(spark, sf_dir).select("doc_id", text.clean_generated(
        "gen_text", "bot", text.ANY_LETTER_ALLOW).alias("clean_text"))


@query("text_functions", f"""
with t as (select doc_id, lang, text,
    replace(replace(text, '. ', repeat(chr(9), 7)), ', ', repeat(chr(9), 6)) as tabbed from documents),
cutting as (select *, string_split(replace(replace(tabbed, chr(10), ''), repeat(chr(9), 7), 'li'), 'li') as p from t)
select doc_id, split_part(text, '. ', 1) as first_sentence,
  list_extract(string_split(text, ' '), -1) as last_word,
  trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) as squeezed,
  lower(text) as lowered, length(text)::bigint as n_chars,
  coalesce(replace(p[2], repeat(chr(9), 6), ''), '') as tab_piece,
  contains(text, 'the') or contains(text, 'que') or contains(text, 'der') as has_word
from cutting""")
def text_functions(spark, sf_dir):
    tabbed = F.replace(F.replace("text", F.lit(". "), F.lit("\t" * 7)), F.lit(", "), F.lit("\t" * 6))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.first_part("text", ". ").alias("first_sentence"),
        text.last_token("text").alias("last_word"),
        text.squeeze_spaces("text").alias("squeezed"),
        F.lower("text").alias("lowered"),
        F.length("text").cast("bigint").alias("n_chars"),
        extract.tabbed_cut(tabbed).alias("tab_piece"),
        text.contains_any("text", ["the", "que", "der"]).alias("has_word"))


# Four page layouts: paragraphs under one heading, navigation entries, whole articles, and
# tab-laid headings (a space ends the first piece there).
_H1 = r"(?s)<h1[^>]*>(.*?)</h1>"
PAGE_RULES = (
    PageRule("paragraphs", ".example.com", item=r"(?s)<p>(.*?)</p>", label=_H1,
             label_on_page=True, label_last_word=True, text=r"(?s)^(.*)$"),
    PageRule("navigation", ".example.net", item=r"(?s)<li>(.*?)</li>",
             label=r"(?s)<a [^>]*>(.*?)</a>", text=r'href="([^"]*)"'),
    PageRule("article", ".example.org", label=_H1, label_last_word=True,
             text=r"(?s)<article>(.*?)</article>"),
    PageRule("tabs", "", label=_H1, label_last_word=True, text=_H1,
             finish=lambda c: extract.tabbed_cut(F.replace(c, F.lit(" "), F.lit("\t" * 7)))),
)
_KNOWN = "(ends_with(host, '.example.com') or ends_with(host, '.example.net') or ends_with(host, '.example.org'))"


# The references that the stored pages hold, for the check.
_REFERENCES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _plain_sql(e):
    return reduce(lambda s, pair: "replace({}, '{}', '{}')".format(s, *pair),
                  _REFERENCES, f"regexp_replace({e}, '<[^>]*>', '', 'g')")


def _last_word_sql(e):
    return f"list_extract(string_split({e}, ' '), -1)"


_H1_SQL = f"regexp_extract(page, '{_H1}', 1)"
_PAGES = r"""
v as (
  select page_id, url, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host,
    regexp_replace(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') as page
  from pages
),"""
_RECORDS = _PAGES + f"""
records as (
  select page_id, {_last_word_sql(_plain_sql(_H1_SQL))} as zodiac, {_plain_sql('b')} as horo,
    'paragraphs' as source
  from (select page_id, page, unnest(regexp_extract_all(page, '(?s)<p>(.*?)</p>', 1)) as b
        from v where ends_with(host, '.example.com'))
  union all
  select page_id, {_plain_sql("regexp_extract(b, '(?s)<a [^>]*>(.*?)</a>', 1)")},
    {_plain_sql("regexp_extract(b, 'href=\"([^\"]*)\"', 1)")}, 'navigation'
  from (select page_id, unnest(regexp_extract_all(page, '(?s)<li>(.*?)</li>', 1)) as b
        from v where ends_with(host, '.example.net'))
  union all
  select page_id, {_last_word_sql(_plain_sql(_H1_SQL))},
    {_plain_sql("regexp_extract(page, '(?s)<article>(.*?)</article>', 1)")}, 'article'
  from v where ends_with(host, '.example.org')
  union all
  select page_id, {_last_word_sql(_plain_sql(_H1_SQL))},
    coalesce(list_extract(string_split(replace({_plain_sql(_H1_SQL)}, ' ', 'li'), 'li'), 2), ''), 'tabs'
  from v where not {_KNOWN}
)"""


@query("extract_records", f"""
with {_RECORDS} select page_id, timestamp '2024-03-02' as date, zodiac, horo, source from records""")
def extract_records(spark, sf_dir):
    return extract.extract_records(
        table(spark, sf_dir, "pages"), PAGE_RULES, "2024-03-02", keep=("page_id",))


@query("unify_sources", f"""
with {_RECORDS} select source, count(*)::bigint as n_records, sum(length(horo))::bigint as n_chars,
  count(*) filter (zodiac = '')::bigint as n_unlabelled from records group by source
union all
select 'documents', count(*)::bigint, sum(length(text))::bigint, 0::bigint from documents""")
def unify_sources(spark, sf_dir):
    """Page records and collected documents in one schema."""
    records = extract.extract_records(table(spark, sf_dir, "pages"), PAGE_RULES, "2024-03-02")
    documents = table(spark, sf_dir, "documents").select(
        F.lit("2024-03-02").cast("timestamp").alias("date"), F.col("lang").alias("zodiac"),
        F.col("text").alias("horo"), F.lit("documents").alias("source"))
    return extract.unify([records, documents]).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.length("horo")).alias("n_chars"),
        F.count_if(F.col("zodiac") == "").alias("n_unlabelled"))


@query("discover_links", f"""
with {_PAGES} hrefs as (
  select page_id, url, unnest(regexp_extract_all(page, '<a [^>]*?href="([^"]+)"', 1)) as href from v)
select page_id, case when starts_with(href, '//') then 'https:' || href
  when starts_with(href, '/') then regexp_extract(url, '^(https?://[^/?#]+)', 1) || href
  else href end as link from hrefs""")
def discover_links(spark, sf_dir):
    return extract.discover_links(table(spark, sf_dir, "pages"))


@query("discover_links_by_class", r"""
with a as (
  select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as site,
    case when regexp_matches(url, '^https?://[^/]+/.*/') then regexp_extract(url, '^https?://[^/]+(/.*/)[^/]*$', 1)
      else '/' end as folder,
    unnest(regexp_extract_all(split_part(split_part(html, '<nav>', 2), '</nav>', 1), '<a href="/([^"]+)"', 1)) as word
  from pages)
select page_id, case page_id % 4 when 0 then site || '/' || word when 1 then site || folder || word
    when 2 then site || '/top/' || word else site || '/' || word || '?a=1&b=«2»' end as link from a""")
def discover_links_by_class(spark, sf_dir):
    """The menu's links under other quotes, cases, path forms and references, chosen by class."""
    kind = F.col("page_id") % 4
    marked = (F.when(kind == 0, F.regexp_replace("html", r'<a href="(/[^"]+)"', "<A Class='item first' HREF='$1'"))
              .when(kind == 1, F.regexp_replace("html", r'<a href="/([^"]+)"', '<a href="$1" class=item'))
              .when(kind == 2, F.regexp_replace("html", r'<a href="/([^"]+)"',
                                                '<a class="x item" data-href="/no" href="/a/./b/../../top/$1"'))
              .otherwise(F.regexp_replace("html", r'<a href="(/[^"]+)"',
                                          '<a class="item" href="$1?a=1&amp;b=&laquo;2&#xBB;"')))
    menu = F.regexp_extract(marked, r"(?s)<nav>(.*?)</nav>", 1)
    page = F.concat(F.lit('<a href="/other">x</a><a class="items" href="/other">x</a>'), menu)
    return extract.discover_links(table(spark, sf_dir, "pages").withColumn("html", page), css_class="item")


@query("character_references", r"""
select page_id, replace(replace(replace(url, '/', '«'), '.', '—'), 'e', '&lt;') || '&nosuch; & €𝄞 ' || chr(65533) as text
from pages""")
def character_references(spark, sf_dir):
    """Named, decimal, hexadecimal, escaped, unknown and illegal references."""
    coded = F.replace(F.replace(F.replace("url", F.lit("e"), F.lit("&amp;lt;")), F.lit("/"), F.lit("&laquo;")),
                      F.lit("."), F.lit("&#8212;"))
    return table(spark, sf_dir, "pages").select("page_id", extract.unescape(
        F.concat(coded, F.lit("&nosuch; & &#x20aC;&#119070; &#xD800;"))).alias("text"))


# Routes over the stored conversations: an exact text, a literal, lower-cased literals.
MESSAGE_ROUTES = (
    routing.Route("thanks", "exact", ("Thanks.", "Danke.")),
    routing.Route("order", "contains", ("Que", "Der ")),
    routing.Route("greeting", "contains_lower", ("que", "hallo", "the")),
)
_INTENT = """case when text in ('Thanks.', 'Danke.') then 'thanks'
  when contains(text, 'Que') or contains(text, 'Der ') then 'order'
  when contains(lower(text), 'que') or contains(lower(text), 'hallo') or contains(lower(text), 'the')
    then 'greeting' else 'fallback' end"""


@query("route_messages",
       f"select conv_id, turn, role, text, {_INTENT} as intent from conversations")
def route_messages(spark, sf_dir):
    return routing.route(table(spark, sf_dir, "conversations"), routes=MESSAGE_ROUTES).select(
        "conv_id", "turn", "role", "text", "intent")


@query("intent_counts",
       f"select role, {_INTENT} as intent, count(*)::bigint as n from conversations group by all")
def intent_counts(spark, sf_dir):
    routed = routing.route(table(spark, sf_dir, "conversations"), routes=MESSAGE_ROUTES)
    return routing.intent_counts(routed, "role")


# Conversations with the bot's own captions, signs and greetings put in front.
_BOT_TEXT = """case conv_id % 6 when 0 then '🔥Знаки Огня' when 1 then 'Назад'
  when 2 then '♌Лев ' || text when 3 then 'Привет ' || text when 4 then 'hey ' || text
  else text end"""


@query("bot_intent_counts", f"""
with m as (select role, {_BOT_TEXT} as t from conversations)
select role, case t when '🔥Знаки Огня' then 'menu_fire' when 'Назад' then 'back' else
  case when contains(t, '♌Лев') then 'sign'
  when {' or '.join(f"contains(lower(t), '{g}')" for g in routing.BOT_ROUTES[-1].needles)}
  then 'greeting' else 'fallback' end end as intent, count(*)::bigint as n from m group by all""")
def bot_intent_counts(spark, sf_dir):
    messages = table(spark, sf_dir, "conversations").withColumn("text", F.expr(_BOT_TEXT))
    return routing.intent_counts(routing.route(messages), "role")


_SIGN_SQL = "['" + "', '".join(evaluate.PROMPTS) + "']"


@query("sign_element", f"""
with s as (select c_custkey, {_SIGN_SQL}[(c_custkey % 12 + 1)::int] as sign from customer)
select c_custkey, sign, case
  {' '.join("when sign in ('" + "', '".join(signs) + f"') then '{element}'"
            for element, signs in lookup.ELEMENT_SIGNS.items())} end as element from s""")
def sign_element(spark, sf_dir):
    signs = F.array(*[F.lit(s) for s in evaluate.PROMPTS])
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.element_at(signs, (F.col("c_custkey") % 12 + 1).cast("int")).alias("sign"))
    return lookup.with_element(customers).select("c_custkey", "sign", "element")


@query("label_rates", """
select count(*)::bigint as n, round(count(*) filter (quality = 1) / count(*)::double * 100, 2) as gramm_corr,
  round(count(*) filter (toxic = 0) / count(*)::double * 100, 2) as positiv from labels""")
def label_rates(spark, sf_dir):
    """Rates from model label texts, mapped to 0/1 first."""
    named = table(spark, sf_dir, "labels").selectExpr(
        "CASE quality WHEN 1 THEN 'LABEL_1' ELSE 'LABEL_0' END AS grammar",
        "CASE toxic WHEN 1 THEN 'negative' WHEN 0 THEN 'neutral' END AS mood")
    return evaluate.label_rates(named.select(
        tags.acceptable("grammar").alias("grm_label"),
        tags.non_negative("mood").alias("sentiment")))


_CENTROID = """
normed as (
  select {keys} unnest(embedding)::double / sqrt(list_inner_product(embedding::double[], embedding::double[])) as e,
    generate_subscripts(embedding, 1) as pos from {source}
),
centre as (select {keys} pos, avg(e) as c, count(*) as n from normed group by all)"""


@query("diversity", f"""
with {_CENTROID.format(keys='', source='embeddings')}
select max(n)::bigint as n_texts, round(1 - sum(c * c), 6) as diversity from centre""")
def diversity(spark, sf_dir):
    out = evaluate.diversity(table(spark, sf_dir, "embeddings"))
    return out.withColumn("diversity", F.round("diversity", 6))


@query("diversity_by_group", f"""
with {_CENTROID.format(keys='label,', source='embeddings')}
select label, max(n)::bigint as n_texts, round(1 - sum(c * c), 6) as diversity from centre group by label""")
def diversity_by_group(spark, sf_dir):
    out = evaluate.diversity(table(spark, sf_dir, "embeddings"), by=["label"])
    return out.withColumn("diversity", F.round("diversity", 6))


def _text_diversity_sql(key):
    keys = "label," if key else ""
    on = "using (label, pos)" if key else "using (pos)"
    return f"""with {_CENTROID.format(keys='vec_id, label,', source='embeddings').split('centre as')[0]}
  centre as (select {keys} pos, avg(e) as c from normed group by all)
  select vec_id, round(1 - sum(e * c), 6) as diver from normed join centre {on} group by vec_id"""


@query("text_diversity", _text_diversity_sql(False))
def text_diversity(spark, sf_dir):
    out = evaluate.text_diversity(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", F.round("diver", 6).alias("diver"))


@query("text_diversity_by_group", _text_diversity_sql(True))
def text_diversity_by_group(spark, sf_dir):
    out = evaluate.text_diversity(table(spark, sf_dir, "embeddings"), by=["label"])
    return out.select("vec_id", F.round("diver", 6).alias("diver"))


_GROUPED = """
g as (select vec_id, case when vec_id % 7 = 0 then null else label end as label, embedding from embeddings),
normed as (
  select vec_id, label, unnest(embedding)::double / sqrt(list_inner_product(embedding::double[], embedding::double[])) as e,
    generate_subscripts(embedding, 1) as pos from g),
centre as (select label, pos, avg(e) as c from normed group by all)"""


@query("text_diversity_null_group", f"""with {_GROUPED}
select vec_id, round(1 - sum(e * c), 6) as diver from normed join centre
  on normed.pos = centre.pos and normed.label is not distinct from centre.label group by vec_id""")
def text_diversity_null_group(spark, sf_dir):
    """Texts without a group form a group."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 != 0, F.col("label")))
    out = evaluate.text_diversity(vectors, by=["label"])
    return out.select("vec_id", F.round("diver", 6).alias("diver"))


@query("sweep_report", f"""
with {GENERATIONS},
{_CENTROID.format(keys='top_p, temperature,', source='generations')},
d as (select top_p, temperature, round((1 - sum(c * c)) * 100, 2) as diversity from centre group by all)
select model_name, top_p, temperature, count(*)::bigint as n_texts,
  round(count(*) filter (grm_label = 1) / count(*)::double * 100, 2) as gramm_corr,
  round(count(*) filter (sentiment = 1) / count(*)::double * 100, 2) as positiv,
  round(avg(gen_time), 4) as avg_gen_time, any_value(diversity) as diversity
from generations join d using (top_p, temperature) group by all""")
def sweep_report(spark, sf_dir):
    return evaluate.sweep_report(generations(spark, sf_dir))


# Pages whose layout nests: the stored title, menu and article inside the blocks of four sources.
_TITLE, _ARTICLE = r"(?s)<title>(.*?)</title>", r"(?s)<article>(.*)</article>"
_MENU = r"(?s)<nav>(.*?)</nav>"
ELEMENT_RULES = (
    ElementRule("cards", ".example.com", item=Selector(classes="IGRa5"), label=Selector(classes="_4K6U+ _9dcVo"),
                text=Selector(classes="BDPZt KUbeq")),
    ElementRule("columns", ".example.net", item=Selector(classes="col-xs-12 col-md-6"), label=Selector(classes="t"),
                text=Selector(classes="text")),
    ElementRule("boxes", ".example.org", item=Selector("div", "text_box"), label=Selector("h6")),
    ElementRule("single", "", label=Selector("h1"), label_last_word=True, text=Selector(classes="p-3")),
)
_LAYOUTS = {
    ".example.com": ['<div class="feed IGRa5"><nav class="_4K6U+">', "menu", '</nav><h3 class="_4K6U+ _9dcVo">', "title",
                     '</h3><div class="BDPZt KUbeq"><div>', "article", '</div> <i>ok</i></div><div class="IGRa5 in">'
                     '<b class="_9dcVo _4K6U+">no</b><b class="_4K6U+ _9dcVo">in</b><p class="BDPZt KUbeq">', "title",
                     "</div></div>"],
    ".example.net": ['<section class="col-xs-12 col-md-6"><ul>', "menu", '</ul><a title="</section>" class="x t">', "title",
                     '</a><div class="text wide"><div class="text">', "article", "</div>, </div>after</section>"
                     '<section class="col-md-6 col-xs-12"><i class="t">no</i></section>'],
    ".example.org": ['<div class="text_box first"><h6>', "title", "</h6>: <div>", "article", '<div class="text_box">',
                     "title", "</div></div>end</div>"],
    "": ["<h1>", "title", "</h1><main class=p-3>", "article", "<main>", "title", "</main></main>"],
}


def _nested(hosts, concat, literal, parts):
    """The page of a host as one expression, in either dialect."""
    return {host: concat([parts[x] if x in parts else literal(x) for x in _LAYOUTS[host]]) for host in hosts}


def nested_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    parts = {"title": F.regexp_extract("html", _TITLE, 1), "menu": F.regexp_extract("html", _MENU, 1),
             "article": F.regexp_extract("html", _ARTICLE, 1)}
    layouts = _nested(_LAYOUTS, lambda x: F.concat(*x), F.lit, parts)
    html = F
    for suffix, layout in layouts.items():
        html = html.when(F.endswith(extract.host(), F.lit(suffix)), layout)
    return pages.select("page_id", "url", html.otherwise(layouts[""]).alias("html"))


# What those blocks hold, from the parts themselves: no element is sought in SQL.
@query("extract_elements", f"""
with parts as (
  select page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host, {_plain_sql(f"regexp_extract(html, '{_TITLE}', 1)")} as title,
    {_plain_sql(f"regexp_replace(regexp_extract(html, '{_ARTICLE}', 1), '(?s)<script[^a-z].*?</script>|<style[^a-z].*?</style>|<!--.*?-->', '', 'g')")} as article
  from pages),
records as (
  select page_id, title as zodiac, article || ' ok' as horo, 'cards' as source from parts where ends_with(host, '.example.com')
  union all select page_id, 'in', title, 'cards' from parts where ends_with(host, '.example.com')
  union all select page_id, title, article || ', ', 'columns' from parts where ends_with(host, '.example.net')
  union all select page_id, title, title || ': ' || article || title || 'end', 'boxes' from parts where ends_with(host, '.example.org')
  union all select page_id, '', title, 'boxes' from parts where ends_with(host, '.example.org')
  union all select page_id, {_last_word_sql('title')}, article || title, 'single' from parts where not {_KNOWN})
select page_id, timestamp '2024-03-02' as date, zodiac, horo, source from records""")
def extract_elements(spark, sf_dir):
    """Records by tag and class from nested blocks, unclosed tags of the stored articles inside."""
    return elements.extract_elements(nested_pages(spark, sf_dir), ELEMENT_RULES, "2024-03-02", keep=("page_id",))
