"""One registered query per operator over the stored tables, and the SQL that checks it."""

from pyspark.sql import functions as F

from tallymill.llm import (
    decontaminate, langid, licenses, lines, mixing, pages, quality, quotes, sharding, simhash, spelling,
    structure, vectors)
from tallymill.llm.common import table

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_shard_tree(spark, sf_dir):
    """Every document in one of 40 shards, with its shard among 41."""
    docs = sharding.size_and_crc(table(spark, sf_dir, "documents"))
    return sharding.assign(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op2_line_field(spark, sf_dir):
    """Quality of every document by a conditional random field over its lines."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score_documents(docs, quality.train(docs, labels))


@query
def op3_reply_order(spark, sf_dir):
    """Conversations without quotes, ordered by answers."""
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


ORACLES["op3_reply_order"] = r"""
WITH RECURSIVE m AS (
    SELECT row_number() OVER () AS message, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (
    SELECT message, conv_id, turn, unnest(string_split_regex(text, '\r?\n')) AS line,
           generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS pos FROM m),
d AS (
    SELECT message, conv_id, turn, pos,
           len(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')) AS depth,
           regexp_replace(line, '^[ \t]*((?:>[ \t]*)+)', '') AS body FROM l),
own AS (
    SELECT m.message, m.conv_id, m.turn, m.role,
           regexp_replace(coalesce(string_agg(d.body, chr(10) ORDER BY d.pos) FILTER (d.depth = 0), ''),
                          '^\s+|\s+$', '', 'g') AS content
    FROM m LEFT JOIN d USING (message) GROUP BY ALL),
ownline AS (
    SELECT message, conv_id, turn, unnest(string_split(content, chr(10))) AS line,
           generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM own),
normline AS (
    SELECT *, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS part FROM ownline),
said AS (
    SELECT conv_id, turn, part AS said FROM normline WHERE part <> ''
    UNION SELECT conv_id, turn, string_agg(part, ' ' ORDER BY pos) FROM normline WHERE part <> ''
    GROUP BY message, conv_id, turn),
runs AS (
    SELECT *, sum(fresh) OVER (PARTITION BY message ORDER BY pos) AS passage FROM (
        SELECT *, CASE WHEN depth = lag(depth) OVER (PARTITION BY message ORDER BY pos) THEN 0 ELSE 1 END AS fresh
        FROM d)),
parts AS (
    SELECT message, conv_id, turn, passage, depth, pos,
           trim(regexp_replace(lower(body), '\s+', ' ', 'g')) AS part FROM runs WHERE depth > 0),
quoted AS (
    SELECT message, conv_id, turn, passage, depth, string_agg(part, ' ' ORDER BY pos) AS body
    FROM parts WHERE part <> '' GROUP BY ALL),
asked AS (
    SELECT message, passage, conv_id, turn, part AS said, false AS entire FROM parts WHERE part <> ''
    UNION ALL SELECT message, passage, conv_id, turn, body, true FROM quoted),
sources AS (
    SELECT a.message, a.passage, a.entire, (
        SELECT max(s.turn) FROM said s WHERE s.conv_id = a.conv_id AND s.said = a.said AND s.turn < a.turn) AS source
    FROM asked a),
best AS (
    SELECT message, passage, source FROM (
        SELECT message, passage, source, max(entire) AS entire, count(*) AS n
        FROM sources WHERE source IS NOT NULL GROUP BY message, passage, source)
    QUALIFY row_number() OVER (PARTITION BY message, passage ORDER BY entire DESC, n DESC, source DESC) = 1),
links AS (SELECT q.message, q.conv_id, q.turn, q.depth, b.source FROM quoted q LEFT JOIN best b USING (message, passage)),
answers AS (
    SELECT message, conv_id, turn, source AS reply_to FROM links WHERE source IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY message ORDER BY depth, source DESC) = 1),
up AS (SELECT conv_id, turn, min(reply_to) AS reply_to FROM answers GROUP BY conv_id, turn),
climb AS (
    SELECT conv_id, turn, reply_to AS thread FROM up
    UNION ALL SELECT c.conv_id, c.turn, u.reply_to FROM climb c JOIN up u ON u.conv_id = c.conv_id AND u.turn = c.thread),
threads AS (SELECT conv_id, turn, min(thread) AS thread FROM climb GROUP BY conv_id, turn),
counts AS (SELECT message, count(*) AS n_quotes, count(source) AS n_linked FROM links GROUP BY message)
SELECT o.conv_id, o.turn, o.role, o.content, coalesce(c.n_quotes, 0) AS n_quotes, coalesce(c.n_linked, 0) AS n_linked,
       a.reply_to, coalesce(t.thread, o.turn) AS thread,
       '<|im_start|>' || coalesce(o.role, '') || chr(10) || o.content || '<|im_end|>' || chr(10) AS formatted
FROM own o LEFT JOIN counts c USING (message) LEFT JOIN answers a USING (message)
LEFT JOIN threads t ON t.conv_id = o.conv_id AND t.turn = o.turn
"""


def _quoting(conversations):
    """Stored messages that quote the message one turn before them and, one level deeper, the one before that."""
    said = conversations.where("text IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("text").alias("said"))
    before = {depth: said.select("conv_id", (F.col("turn") + depth).alias("turn"), F.col("said").alias(f"said{depth}"))
              for depth in (1, 2)}
    quoted = lambda column, marks: F.concat(
        F.lit(marks), F.replace(F.col(column), F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))
    joined = conversations.join(before[1], ["conv_id", "turn"], "left").join(before[2], ["conv_id", "turn"], "left")
    empty = F.lit("")
    return joined.select("conv_id", "turn", "role", F.concat(
        F.coalesce(quoted("said2", "> > "), empty), F.coalesce(quoted("said1", "> "), empty),
        F.coalesce("text", empty)).alias("text"))


@query
def quoted_replies(spark, sf_dir):
    """Reply order of the stored messages, each of which quotes the two before it at nested depths."""
    return quotes.reply_ordered(_quoting(table(spark, sf_dir, "conversations")))


_QUOTING = """quoting AS (
    SELECT c.conv_id, c.turn, c.role,
           coalesce('> > ' || replace(s2.said, chr(10), chr(10) || '> > ') || chr(10), '')
           || coalesce('> ' || replace(s1.said, chr(10), chr(10) || '> ') || chr(10), '') || coalesce(c.text, '') AS text
    FROM conversations c
    LEFT JOIN (SELECT conv_id, turn, max(text) AS said FROM conversations WHERE text IS NOT NULL GROUP BY ALL) s1
        ON s1.conv_id = c.conv_id AND s1.turn + 1 = c.turn
    LEFT JOIN (SELECT conv_id, turn, max(text) AS said FROM conversations WHERE text IS NOT NULL GROUP BY ALL) s2
        ON s2.conv_id = c.conv_id AND s2.turn + 2 = c.turn),"""
ORACLES["quoted_replies"] = (ORACLES["op3_reply_order"].replace("FROM conversations)", "FROM quoting)")
                             .replace("WITH RECURSIVE", f"WITH RECURSIVE {_QUOTING}"))


@query
def op4_projection_links(spark, sf_dir):
    """Vectors with a cosine of at least 0.95, and their components."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_poisson_mix(spark, sf_dir):
    """All documents repeated by Poisson draws towards square-root weights of the sources' bytes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op5_poisson_mix"] = r"""
WITH RECURSIVE sizes AS (
    SELECT source, sum(coalesce(strlen(text), 0))::BIGINT AS bytes FROM documents GROUP BY source),
weighed AS (SELECT source, bytes, pow(bytes::DOUBLE, 0.5) AS weight FROM sizes),
totals AS (SELECT sum(bytes)::BIGINT AS all_bytes, list_sum(list_sort(list(weight))) AS all_weights FROM weighed),
rates AS (
    SELECT source, CASE WHEN bytes > 0 AND all_weights > 0
        THEN all_bytes::DOUBLE * weight / all_weights / bytes::DOUBLE ELSE 0.0 END AS rate FROM weighed, totals),
cdf AS (
    SELECT source, rate, 0 AS k, -rate AS term, exp(-rate) AS c,
           ceil(rate + 12 * sqrt(rate) + 40)::INT AS top FROM rates WHERE rate > 0
    UNION ALL SELECT source, rate, k + 1, term + ln(rate) - ln((k + 1)::DOUBLE),
           c + exp(term + ln(rate) - ln((k + 1)::DOUBLE)), top FROM cdf WHERE k < top),
drawn AS (
    SELECT *, (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE)
              / 4503599627370496.0::DOUBLE AS u FROM documents),
counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.rate, count(*)::INT AS n
    FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND d.u >= c.c GROUP BY ALL),
copies AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1))::INT AS copy FROM counted)
SELECT *, ('0x' || substr(md5('shuffle-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT
          AS shuffle_key FROM copies
"""


@query
def op6_line_runs(spark, sf_dir):
    """Every document without the runs of lines that stand in an earlier place."""
    return lines.remove_repeated(table(spark, sf_dir, "documents"))


@query
def op7_simhash_groups(spark, sf_dir):
    """Near-duplicate groups of all documents: 4-word shingles, at most 4 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_byte_network(spark, sf_dir):
    """Language of every document by a bidirectional recurrent network over its bytes."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query
def op9_main_text(spark, sf_dir):
    """The article of every page."""
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op10_template_matches(spark, sf_dir):
    """Documents that hold a passage of a benchmark item, word for word or re-parameterised."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(
        F.count("*").alias("n_places"), F.max("n_windows").alias("n_windows"), F.max("changed").alias("changed"))


@query
def op11_lightest_repair(spark, sf_dir):
    """Faults of damaged conversations, their cheapest repair and a digest of its result."""
    messages = table(spark, sf_dir, "conversations")
    report, repaired = structure.repair(structure.damage(messages))
    hashes = structure.digests(repaired)
    ids = messages.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(report, ids.conv_id.eqNullSafe(report.conv_id), "left")
            .join(hashes, ids.conv_id.eqNullSafe(hashes.conv_id), "left")
            .select(ids.conv_id, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


@query
def op12_spelling_forms(spark, sf_dir):
    """Words of all documents with their near words and the form that each is a variant of."""
    return spelling.variants(spelling.corpus_words(table(spark, sf_dir, "documents")))


@query
def op13_license_blocks(spark, sf_dir):
    """Licenses that every document names, by phrases and by templates."""
    return licenses.scan(table(spark, sf_dir, "documents"))


_TEMPLATES = ", ".join(
    f"('{label}', {licenses.template_words(text)}, {licenses.needed(len(licenses.template_words(text)), licenses.THRESHOLD)})"
    for label, text in licenses.TEMPLATES)
_PHRASES = ", ".join(f"('{label}', {phrase.split(' ')})" for phrase, label in licenses.PHRASES)
ORACLES["op13_license_blocks"] = r"""
WITH templates(label, t, need) AS (VALUES {templates}), phrases(label, p) AS (VALUES {phrases}),
d AS (
    SELECT row_number() OVER () AS r, doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
w AS (
    SELECT r, doc_id, lowered, list_filter(string_split_regex(lowered, '{between}'), lambda x: x <> '') AS words FROM d),
places AS (
    SELECT r, p.label, unnest(list_filter(range(len(words)),
           lambda i: list_slice(words, (i + 1)::BIGINT, (i + len(p.p))::BIGINT) = p.p)) AS place FROM w, phrases p),
base AS (
    SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
    FROM places GROUP BY r),
blocks AS (
    SELECT r, unnest(string_split_regex(regexp_replace(lowered, '([.!?])[	-
 ]+', '' || chr(10) || chr(10), 'g'),
                                        '
[	-
 ]*
')) AS block FROM d),
sets AS (SELECT r, list_distinct(string_split_regex(block, '{between}')) AS words FROM blocks),
met AS (
    SELECT r, label, len(list_intersect(words, t))::DOUBLE / len(t)::DOUBLE AS share
    FROM sets, templates WHERE len(list_intersect(words, t)) >= need),
more AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '')
           AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN more USING (r)
""".replace("{templates}", _TEMPLATES).replace("{phrases}", _PHRASES).replace("{between}", licenses.BETWEEN_WORDS)
