"""Conversation repair against all edit sequences, and over block borders."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from cases import empty

from tallymill.llm import queries, structure
from tallymill.llm.common import table

_WS = " \t\n\x0b\x0c\r"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _cheapest(rows, must_go, short):
    """Least (cost, audit) and its result, by all ways through the messages (inserted ones at most
    one more than messages)."""
    best = {"": (0, "", [])}

    def insertions(held):
        found = dict(held)
        for _ in range(2):
            for roles, (cost, audit, lines) in list(found.items()):
                for role in ("user", "assistant"):
                    _offer(found, roles + role[0], (cost + 2, audit + "I", lines + [role + ":"]))
        return found

    def _offer(into, roles, value):
        # Of sequences with one last role only the lightest can become the lightest whole.
        if not re.fullmatch(r"s?(ua)*u?", roles):
            return
        name = roles[-1:] if roles else ""
        key = {"": "", "s": "s", "u": "u", "a": "ua"}[name]
        if key not in into or value[:2] < into[key][:2]:
            into[key] = value

    for (role, text), gone, cut in zip(rows, must_go, short):
        best, after = insertions(best), {}
        for roles, (cost, audit, lines) in best.items():
            _offer(after, roles, (cost + 3, audit + "D", lines))
            if not gone:
                if role:
                    _offer(after, roles + role[0], (cost + cut, audit + "K", lines + [f"{role}:{text}"]))
                for new in ("user", "assistant"):
                    _offer(after, roles + new[0], (cost + 2 + cut, audit + "R", lines + [f"{new}:{text}"]))
        best = after
    best = insertions(best)
    return min((v for k, v in best.items() if k in ("", "ua")), key=lambda v: v[:2])


def _plain(messages):
    """Result of one conversation's (turn, role, text) rows after damage."""
    rows = sorted(messages, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    counts, seen, must_go, short = defaultdict(int), set(), [], []
    for _, role, text in rows:
        spoken = text.strip(_WS)
        fault = "blank" if not spoken else "duplicate" if (role, text) in seen else "truncated" if spoken[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        must_go.append(fault in ("blank", "duplicate"))
        short.append(int(fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = _cheapest([r[1:] for r in rows], must_go, short)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _expected(rows, damage=True):
    by_conv = {r[0]: [] for r in rows}
    for conv, turn, role, text in _damaged(rows) if damage else rows:
        by_conv[conv].append((turn, role, text))
    return {conv: _plain(messages) for conv, messages in by_conv.items()}


def _result(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    monkeypatch.setattr(queries, "table", lambda *_: df)
    out = queries.op11_lightest_repair(spark, "").collect()
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out}
    assert len(found) == len(out)
    return found


def test_the_lightest_of_all_edit_sequences():
    """Short conversations against every sequence of edits, without any dynamic programme."""
    sound = re.compile(r"(s?(ua)+)?")

    def every(moves):
        best = None
        for n in range(4):
            for edits in itertools.product("DKR", repeat=len(moves)):
                if any(m == "d" and e != "D" for m, e in zip(moves, edits)):
                    continue
                for gaps in itertools.combinations_with_replacement(range(len(moves) + 1), n):
                    audit, choices, cost = "", [], 0
                    for i in range(len(moves) + 1):
                        audit += "I" * gaps.count(i)
                        choices += ["ua"] * gaps.count(i)
                        if i < len(moves):
                            audit += edits[i]
                            if edits[i] != "D":
                                choices.append(moves[i].lower() if edits[i] == "K" else "ua")
                                cost += moves[i].isupper()
                    cost += 2 * n + sum({"D": 3, "K": 0, "R": 2}[e] for e in edits)
                    if (best is None or (cost, audit) < best) and any(
                            sound.fullmatch("".join(c)) for c in itertools.product(*choices)):
                        best = (cost, audit)
        return best

    draw = random.Random(2)
    for _ in range(150):
        moves = "".join(draw.choice("dsuaxSUAXuaua") for _ in range(draw.randrange(5)))
        cost, audit, _ = structure.join_blocks([(0, structure.block_items(moves))])
        assert (cost, audit) == every(moves), moves
        at = draw.randrange(len(moves) + 1)
        split = [(0, structure.block_items(moves[:at])), (1, structure.block_items(moves[at:]))]
        assert structure.join_blocks(split)[:2] == (cost, audit), moves


def test_rules_are_monotone_and_superior():
    """A popped weight is never below one popped before: each item is final when popped."""
    popped = []

    def follow(item):
        popped.append(item)
        yield from ()

    structure.lightest([(2, "K", "x", None), (1, "R", "y", None), (1, "D", "z", None), (2, "DI", "x", None)], follow, ["x", "none"])
    assert popped == ["z", "y", "x"]


def test_stored_conversations(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_lightest_repair(spark, sf_dir).collect()}
    assert found == _expected(rows)
    for i in range(5):
        assert any(v[i] for v in found.values())


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_random_conversations_over_block_borders(spark, monkeypatch, bits):
    draw, rows = random.Random(bits), []
    for conv in range(60):
        for turn in range(draw.choice([1, 2, 5, 12, 40])):
            if draw.random() < 0.1:
                continue
            rows.append((conv, turn, draw.choice(["user", "assistant", "user", "assistant", "system", "bot", "sys", ""]),
                         draw.choice(["Yes.", "No", f"Well {draw.randrange(9)}!", f"So {draw.randrange(9)}", "", " \t\x0b", "What? \n", "."])))
    monkeypatch.setattr(structure, "BLOCK_BITS", bits)
    assert _result(spark, rows, monkeypatch) == _expected(rows)


def test_one_long_conversation_and_many_equal_rows(spark, monkeypatch):
    long = [(7, t, ("user", "assistant")[t % 2], f"Message {t}.") for t in range(6000)]
    # A turn that the checksum neither drops nor changes.
    equal = [(8, next(t for t in range(99) if zlib.crc32(f"8:{t}".encode()) % 20 > 4), "user", "Again and again.")] * 5000
    found = _result(spark, long + equal, monkeypatch)
    expected = _expected(long + equal)
    assert found == expected and found[8][6] == "K" + "D" * 4999 + "I" and len(found[7][6]) > 5000


def test_awkward_rows(spark, monkeypatch):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, "system", "Be brief."), (1, None, None, None),
            (None, 1, "user", "No conversation."), (None, None, None, "No one"), (None, 2, "assistant", None),
            (2, None, "user", "Only nulls?"), (2, None, "assistant", "Yes."), (3, 1, None, None), (4, 5, "", "No role."),
            (5, 2 ** 61, "user", "Late."), (5, -2 ** 61, "assistant", "Early"), (6, 1, "user", "long " * 200000 + "end."),
            (6, 2, "assistant", "　"), (6, 3, "Assistant", "Zażółć \U0001f600!")]
    dropped = next(t for t in range(99) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows.append((9, dropped, "user", "Gone."))
    found = _result(spark, rows, monkeypatch)
    assert found == _expected(rows)
    assert found[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 1)], "conv_id long, turn long, role string, text string, key string, at int")
    report, repaired = structure.repair(df)
    assert [r.audit for r in report.collect()] == ["KI"]
    assert [(r.role, r.text) for r in repaired.orderBy("at", "step").collect()] == [("user", "Hi."), ("assistant", "")]
    report, repaired = structure.repair(empty(df))
    assert report.count() == repaired.count() == structure.digests(repaired).count() == 0
