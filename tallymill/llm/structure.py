"""Repair of conversation structure by lightest derivations.

A sound conversation's roles begin with ``s?(ua)+``: maybe a system message, then
user and assistant in turn.  A message is kept, given the role user or assistant, or
deleted; blank messages and repetitions must go; a message without text may be
inserted anywhere.  Items are weighted deductions: ``(i, state)`` says that the first
``i`` messages have been edited into a sequence that ends in ``state``.  Its weight is
the pair (cost, audit), the edits' initials.  An agenda pops the lightest item,
finalises it and pushes what follows from it, until the goal item is final.

That is sound because every rule is monotone and superior: it adds to the cost, and
appends to the audit.  Of two audits of one item at one cost none begins with the
other - both hold as many edits of messages, and each further insertion costs - so
what is appended never changes their order.

A conversation may be long, so it is cut into blocks of ``2 ** BLOCK_BITS`` places of
the sorted table.  Each block derives its items for every state that it may begin in,
in tasks of their own; they are the axioms of a second agenda whose rules take two
antecedents, an item up to the block and an item of the block.  No task holds more of
a conversation than its audit, which is one value of the result.

Nulls: a null role or text is one space; null ids are one conversation; null turns
come first.  Messages of one turn are ordered by role, then by a digest of the text.
Equal rows are one row and its repetitions.  A role's initial is its first code point;
a message of an empty role cannot be kept.  Texts of any length move only at the end,
once to their edits and once to their place.  An empty table gives no rows.  Further
columns are not read; the columns of the results are fixed.
"""

import hashlib
import heapq
import itertools
import re

import pandas as pd
from pyspark.sql import functions as F

from tallymill.session import materialise

BLOCK_BITS = 10
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
_SPACES = " \t\n\x0b\x0c\r"

# States by the roles so far: none, system, user last, assistant last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_SOUND = (EMPTY, ASSISTANT)
_LEGAL = {"su", "ua", "au"}
GOAL = "goal"


def _wanted(state):
    """The role, if not system, that must follow a state."""
    return "assistant" if state == USER else "user"


def lightest(axioms, follow, goals):
    """Final items and their weights, by Knuth's generalisation of Dijkstra's algorithm.

    ``axioms`` are (cost, audit, item, how); ``follow(item, weight)`` gives the items that follow
    from a final item and from items final before it.  Stops when all ``goals`` are final.
    """
    order = itertools.count()       # never compares how an item came about
    agenda = [(cost, audit, next(order), item, how) for cost, audit, item, how in axioms]
    heapq.heapify(agenda)
    final, open_goals = {}, set(goals)
    while agenda:
        cost, audit, _, item, how = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit, how)
        open_goals.discard(item)
        if not open_goals:
            break
        for more, edits, onward, step in follow(item):
            if onward not in final:
                heapq.heappush(agenda, (cost + more, audit + edits, next(order), onward, (how, step)))
    return final


def block_items(moves):
    """``(first state, last state, cost, audit)`` of the lightest edits of a block's messages.

    ``moves`` has a letter per message: ``d`` if it must go, else the role's initial (``x`` for
    any other), as a capital if the message is cut short.
    """
    messages = re.findall("d+|.", moves, re.S)

    def follow(item):
        i, state = item
        onward = _STEP[state, _wanted(state)[0]]
        yield INSERT, "I", (i, onward), None
        if i < len(messages):
            this = messages[i]
            yield DELETE * len(this), "D" * len(this), (i + 1, state), None
            if this[0] != "d":
                short = CUT_SHORT if this.isupper() else 0
                yield REROLE + short, "R", (i + 1, onward), None
                if (state, this.lower()) in _STEP:
                    yield short, "K", (i + 1, _STEP[state, this.lower()]), None

    items = []
    for first in range(4):
        ends = [(len(messages), last) for last in range(1, 4)] + [(len(messages), first)]
        final = lightest([(0, "", (0, first), None)], follow, ends)
        items += [(first, last, *final[len(messages), last][:2]) for last in range(4) if (len(messages), last) in final]
    return items


def join_blocks(blocks):
    """Cost, audit and its pieces ``(at, state, audit)`` of a conversation's blocks, each an
    ``(at, items)`` in order."""
    by_state = [{} for _ in blocks]
    for k, (_, items) in enumerate(blocks):
        for first, last, cost, audit in items:
            by_state[k].setdefault(first, []).append((last, cost, audit))

    def follow(item):
        k, state = item
        if k == len(blocks):
            if state in _SOUND:
                yield 0, "", GOAL, None
        else:
            for last, cost, audit in by_state[k].get(state, ()):
                yield cost, audit, (k + 1, last), (blocks[k][0], state, audit)

    cost, audit, how = lightest([(0, "", (0, EMPTY), None)], follow, [GOAL])[GOAL]
    pieces = []
    while how:
        how, step = how
        if step:
            pieces.append(step)
    return cost, audit, pieces[::-1]


def edited(keys, copies, moves, state, audit):
    """``(key, role)`` of the messages that a block's audit leaves: no key if inserted, no role if kept."""
    rows = itertools.chain.from_iterable([key] * n for key, n in zip(keys, copies))
    messages, out = zip(rows, moves), []
    for edit in audit:
        if edit == "I":
            key, role = None, _wanted(state)
        else:
            (key, move), role = next(messages), None
            if edit == "D":
                continue
            if edit == "R":
                role = _wanted(state)
        state = _STEP[state, role[0] if role else move.lower()]
        out.append((key, role))
    return out


def damage(messages):
    """Messages with faults put in by a checksum of conversation and turn: every twentieth turn is
    dropped, emptied, freed of ``[.!?]``, repeated, or given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    return messages.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def _keyed(messages):
    """Messages with a digest of what is said by whom in which conversation, and one of the whole row."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    filled = messages.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                             F.coalesce("text", F.lit(" ")).alias("text"))
    said = F.md5(F.concat(text("conv_id"), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    return filled.withColumn("said", said).withColumn("key", F.md5(F.concat(text("turn"), F.lit(":"), "said").cast("binary")))


def _blocks(keyed):
    """One written row per conversation and block: its messages in order and what they count."""
    spoken = F.rtrim("text", F.lit(_SPACES))
    rows = keyed.groupBy("key", "said", "conv_id", "turn", "role", (spoken == "").alias("blank"),
                         (~F.right(spoken, F.lit(1)).isin(".", "!", "?")).alias("short")).agg(F.count("*").cast("int").alias("n"))
    order = ["conv_id", "turn", "role", "said"]
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("place", F.monotonically_increasing_id()), "messages-in-order")
    first = placed.groupBy("said").agg(F.min("place").alias("first"), F.count("*").alias("times")).where("times > 1")
    marked = placed.join(first.drop("times"), "said", "left")
    repeated = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("x")
    move = F.when(F.col("blank") | repeated, "d").when(F.col("short"), F.upper(initial)).otherwise(initial)
    sound = ~F.col("blank") & ~repeated
    message = F.struct("place", "key", "n", F.concat(move, F.repeat(F.lit("d"), F.col("n") - 1)).alias("moves"),
                       F.repeat(initial, F.col("n")).alias("initials"))
    grouped = marked.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(
        F.min("place").alias("at"), F.sort_array(F.collect_list(message)).alias("messages"),
        # As text: integers beside nulls would come to Python as floats.
        F.min("turn").cast("string").alias("least"), F.max("turn").cast("string").alias("most"),
        F.count_distinct("turn").alias("turns"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.when(repeated, 0).otherwise(1))).alias("duplicate"),
        F.sum(F.when(sound & F.col("short"), 1).otherwise(0)).alias("truncated"))
    joined = lambda name: F.array_join(F.transform("messages", lambda m: m[name]), "").alias(name)
    return materialise(grouped.select(
        "conv_id", "at", F.col("messages.key").alias("keys"), F.col("messages.n").alias("copies"), joined("moves"),
        joined("initials"), "least", "most", "turns", "blank", "duplicate", "truncated"), "message-blocks")


def _items(moves):
    def derive(moves: pd.Series) -> pd.Series:
        return moves.map({m: block_items(m) for m in moves.unique()})

    return F.pandas_udf(derive, "array<struct<first:int,last:int,cost:bigint,audit:string>>")(moves)


def _edited(*columns):
    def edit(keys: pd.Series, copies: pd.Series, moves: pd.Series, state: pd.Series, audit: pd.Series) -> pd.Series:
        return pd.Series([edited(*row) for row in zip(keys, copies, moves, state, audit)], dtype=object)

    return F.pandas_udf(edit, "array<struct<key:string,role:string>>")(*columns)


_SUMS = ("blank", "duplicate", "truncated")
_FIELDS = ("gaps", *_SUMS, "illegal", "cost", "audit", "pieces")
_REPORT = ("struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string,"
           "pieces:array<struct<at:bigint,state:int,audit:string>>>")


def _illegal(initials):
    return sum(a + b not in _LEGAL for a, b in itertools.pairwise(initials))


def _conversation(blocks):
    """Report of one conversation from its blocks in order."""
    cost, audit, pieces = join_blocks([(b["at"], [(i["first"], i["last"], i["cost"], i["audit"]) for i in b["items"]])
                                       for b in blocks])
    turned = [b for b in blocks if b["least"] is not None]
    shared = sum(a["most"] == b["least"] for a, b in itertools.pairwise(turned))
    gaps = (int(turned[-1]["most"]) - int(turned[0]["least"]) + 1 - sum(b["turns"] for b in turned) + shared) if turned else 0
    ends = [b["ends"] for b in blocks]
    illegal = sum(b["illegal"] for b in blocks) + _illegal("".join(ends)) - sum(_illegal(e) for e in ends)
    return {"gaps": gaps, **{c: sum(b[c] for b in blocks) for c in _SUMS}, "illegal": illegal, "cost": cost, "audit": audit,
            "pieces": [{"at": at, "state": state, "audit": piece} for at, state, piece in pieces]}


def _report(blocks):
    """``conv_id`` and a struct of its report, one row per conversation."""
    def pairs(initials: pd.Series) -> pd.Series:
        return initials.map(_illegal)

    def whole(parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_conversation(list(blocks)) for blocks in parts], columns=_FIELDS)

    ends = F.concat(F.left("initials", F.lit(1)), F.right("initials", F.lit(1)))
    parts = blocks.select("conv_id", F.struct(
        "at", "least", "most", "turns", *_SUMS, ends.alias("ends"), F.pandas_udf(pairs, "bigint")("initials").alias("illegal"),
        _items("moves").alias("items")).alias("part"))
    return materialise(parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
                       .select("conv_id", F.pandas_udf(whole, _REPORT)("parts").alias("r")), "conversation-reports")


def repair(messages):
    """``(report, repaired)`` of messages ``conv_id, turn, role, text``.

    ``report`` has a row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit``.  ``repaired`` has its messages: ``conv_id, at, step, role, text`` in the order
    of ``at`` and ``step``.
    """
    keyed = _keyed(messages)
    blocks = _blocks(keyed)
    reports = _report(blocks)
    pieces = reports.select(F.inline("r.pieces"))
    edits = (blocks.select("conv_id", "at", "keys", "copies", "moves").join(pieces, "at")
             .select("conv_id", "at", F.posexplode(_edited("keys", "copies", "moves", "state", "audit")).alias("step", "m"))
             .select("conv_id", "at", "step", "m.key", F.col("m.role").alias("new_role")))
    texts = keyed.groupBy("key").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    kept = edits.where("key IS NOT NULL").join(texts, "key").select(
        "conv_id", "at", "step", F.coalesce("new_role", "role").alias("role"), "text")
    inserted = edits.where("key IS NULL").select("conv_id", "at", "step", F.col("new_role").alias("role"), F.lit("").alias("text"))
    report = reports.select("conv_id", *[F.col(f"r.{c}").alias(c) for c in _FIELDS[:-1]])
    return report, kept.unionByName(inserted)


def digests(repaired):
    """``conv_id, sha256`` of each conversation's ``role:text`` lines, joined by line ends.

    A checksum over a text in order is one task's work by nature; the task streams the messages
    and holds one batch of them.
    """
    def hashed(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for conv, null, role, text in zip(batch["conv_id"], batch["no_id"], batch["role"], batch["text"]):
                name = None if null else conv
                if state is None or name != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = name, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield pd.DataFrame(out, columns=["conv_id", "sha256"]).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["conv_id", "sha256"]).astype({"conv_id": "Int64"})

    order = ["conv_id", "at", "step"]
    return (repaired.repartition("conv_id").sortWithinPartitions(*order)
            .select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"), "role", "text")
            .mapInPandas(hashed, "conv_id bigint, sha256 string"))
