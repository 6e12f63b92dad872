"""Reply-ordered conversations from quoted messages.

A line that begins with ``>`` markers quotes at the depth of their number.  A
passage is a run of lines of one depth.  Passages are normalised (case, white
space) and hashed, whole and line by line, and joined to the same hashes of what
the earlier messages of the conversation say themselves.  A message answers the
latest earlier message that its outermost linked passage comes from; threads
follow those answers to their first message.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

from tallymill.session import materialise

TURN_BLOCK = 4096
_MARKERS = r"^[ \t]*((?:>[ \t]*)+)"


def _normal(text):
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text):
    """Array of (depth, body) of a message's lines."""
    def parse(line):
        markers = F.regexp_extract(line, _MARKERS, 1)
        return F.struct(
            (F.length(markers) - F.length(F.replace(markers, F.lit(">"), F.lit("")))).alias("depth"),
            F.when(markers == "", line).otherwise(F.regexp_replace(line, _MARKERS, "")).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), parse)


def _hash(text):
    return F.xxhash64(text)


def parse(messages):
    """``message, conv_id, turn, role, lines, content``: each message's id in the written copy,
    its lines with depths, and what it says itself."""
    parsed = messages.select(
        F.monotonically_increasing_id().alias("message"),
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        "role", _lines(F.col("text")).alias("lines"))
    own = F.transform(F.filter("lines", lambda x: x["depth"] == 0), lambda x: x["body"])
    return parsed.withColumn("content", F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", ""))


def passages(parsed):
    """``message, conv_id, turn, passage, depth, body, parts``: the quoted passages of the messages
    that have any."""
    quoting = parsed.where(F.exists("lines", lambda x: x["depth"] > 0))
    at = Window.partitionBy("message").orderBy("pos")
    lines = (quoting.select("message", "conv_id", "turn", F.posexplode("lines").alias("pos", "line"))
             .select("message", "conv_id", "turn", "pos", "line.depth", "line.body")
             .withColumn("new", (F.col("depth") != F.coalesce(F.lag("depth").over(at), F.lit(-1))).cast("int"))
             .withColumn("passage", F.sum("new").over(at)))
    return (lines.where("depth > 0").groupBy("message", "conv_id", "turn", "passage", "depth")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("lines"))
            .withColumn("parts", F.filter(F.transform("lines", lambda x: _normal(x["body"])), lambda x: x != ""))
            .where(F.size("parts") > 0)
            .select("message", "conv_id", "turn", "passage", "depth",
                    F.array_join("parts", " ").alias("body"), "parts"))


def said(parsed):
    """``conv_id, hash, turn``: hashes of every message's own words, whole and by line."""
    lines = F.filter(F.transform(F.split("content", "\n"), _normal), lambda x: x != "")
    own = parsed.select("conv_id", "turn", lines.alias("parts")).where(F.size("parts") > 0)
    hashes = F.concat(F.array(_hash(F.array_join("parts", " "))), F.transform("parts", _hash))
    return own.select("conv_id", "turn", F.explode(F.array_distinct(hashes)).alias("hash"))


def latest_before(asked, known, block=TURN_BLOCK):
    """For distinct ``conv_id, hash, turn`` of ``asked``, the latest lower turn in ``known`` with the
    same conversation and hash, as ``source_turn``; rows without one are left out.

    Turns are compared inside blocks, and blocks through their last turns, so a
    line that a long conversation repeats forever fills no single task.
    """
    keys = ["conv_id", "hash"]
    wanted = asked.select(*keys).distinct()
    events = (known.join(wanted, keys, "left_semi").select(*keys, "turn", F.lit(True).alias("is_known"))
              .unionByName(asked.select(*keys, "turn", F.lit(False).alias("is_known")))
              .where("turn is not null").groupBy(*keys, "turn")
              .agg(F.max("is_known").alias("is_known"), F.min("is_known").alias("all_known"))
              .withColumn("block", F.floor(F.col("turn") / block)))
    known_turn = F.when(F.col("is_known"), F.col("turn"))
    inside = Window.partitionBy(*keys, "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    events = events.withColumn("near", F.max(known_turn).over(inside))
    across = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (events.groupBy(*keys, "block").agg(F.max(known_turn).alias("last"))
               .withColumn("far", F.max("last").over(across)).drop("last"))
    return (events.where("not all_known").join(earlier, [*keys, "block"])
            .select(*keys, "turn", F.coalesce("near", "far").alias("source_turn"))
            .where("source_turn is not null"))


def link_quotes(parsed):
    """``message, conv_id, turn, passage, depth, source_turn``: for every quoted passage the latest
    earlier message that says the whole passage; else, each line naming the latest
    earlier message that says it, the message most lines name (the latest of
    equals); else null."""
    quoted = passages(parsed)
    whole = F.array(F.struct(_hash("body").alias("hash"), F.lit(True).alias("entire")))
    lines = F.transform("parts", lambda x: F.struct(_hash(x).alias("hash"), F.lit(False).alias("entire")))
    asked = quoted.select("message", "passage", "conv_id", "turn",
                          F.explode(F.concat(whole, lines)).alias("a")).select(
        "message", "passage", "conv_id", "turn", "a.hash", "a.entire")
    sources = latest_before(asked.select("conv_id", "hash", "turn"), said(parsed))
    best = (asked.join(sources, ["conv_id", "hash", "turn"])
            .groupBy("message", "passage", "source_turn")
            .agg(F.max("entire").alias("entire"), F.count("*").alias("n"))
            .groupBy("message", "passage")
            .agg(F.max(F.struct("entire", "n", "source_turn"))["source_turn"].alias("source_turn")))
    return (quoted.join(best, ["message", "passage"], "left")
            .select("message", "conv_id", "turn", "passage", "depth", "source_turn"))


def thread_roots(answers):
    """``conv_id, turn, thread`` from ``conv_id, turn, reply_to``: the first message of every answer's
    chain, by pointer doubling (rounds: the logarithm of the longest chain)."""
    at = materialise(answers.select("conv_id", "turn", F.col("reply_to").alias("thread")), "threads")
    while True:
        up = at.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        joined = at.join(up, ["conv_id", "thread"], "left")
        moved = materialise(joined.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"),
                                          F.col("above").isNotNull().alias("moved")), "threads")
        if moved.where("moved").isEmpty():
            return moved.select("conv_id", "turn", "thread")
        at = moved.drop("moved")


def reply_ordered(messages, template="<|im_start|>{role}\n{content}<|im_end|>\n"):
    """Every message without its quotes, ordered by conversation, thread and turn.

    Columns: ``conv_id, turn, role, content, n_quotes, n_linked, reply_to, thread, formatted``.
    ``reply_to`` is the turn answered, null where nothing quoted is found; ``thread``
    the turn that the chain of answers begins with (its own turn without one).
    Within a thread an answer always comes after what it answers.

    Quotes link inside one conversation, to lower turns only.  Null and empty
    texts give empty content; a null conversation or turn links with nothing and
    is its own thread (null).  Repeated rows stay; where rows share a turn, the
    thread of the turn is the least of theirs.  Other columns are not read.  An
    empty table gives no rows.
    """
    parsed = materialise(parse(messages), "messages")
    links = materialise(link_quotes(parsed), "quotes")
    outer = F.min(F.when(F.col("source_turn").isNotNull(), F.struct("depth", (-F.col("source_turn")).alias("back"))))
    per_message = links.groupBy("message").agg(
        F.count("*").alias("n_quotes"), F.count("source_turn").alias("n_linked"),
        (-outer["back"]).alias("reply_to"))
    linked = (links.where("source_turn is not null").groupBy("message", "conv_id", "turn")
              .agg((-outer["back"]).alias("reply_to"))
              .groupBy("conv_id", "turn").agg(F.min("reply_to").alias("reply_to")))
    head, tail = template.split("{content}")
    before, after = head.split("{role}")
    role = F.coalesce("role", F.lit(""))
    return (parsed.join(per_message, "message", "left").join(thread_roots(linked), ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "content",
                    F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                    "reply_to", F.coalesce("thread", "turn").alias("thread"),
                    F.concat(F.lit(before), role, F.lit(after), F.col("content"), F.lit(tail)).alias("formatted"))
            .orderBy("conv_id", "thread", "turn"))
