"""Conversation repair against all edit sequences, and a plain programme over strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from leadspark.llm import repair
from leadspark.llm.shared import Workspace

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, place int, audit string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def plain_best(marks):
    """Cheapest (cost, audit) over whole strings, state by state; marks are (initial, fault)."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for role, onward in steps[state].items():
                    if role != "s":
                        best[onward] = min(best.get(onward, (9e9, "")), (cost + 5, audit + "I"))
        return best

    best = inserted({"": (0, "")})
    for initial, fault in marks:
        new = {}

        def offer(state, cost, audit, new=new):
            new[state] = min(new.get(state, (9e9, "")), (cost, audit))

        for state, (cost, audit) in best.items():
            offer(state, cost + 2, audit + "D")
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                for role, onward in steps[state].items():
                    if role == initial:
                        offer(onward, cost + more, audit + "K")
                    if role != "s":
                        offer(onward, cost + more + 1, audit + "R")
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def every_audit(marks, most=2):
    """Cheapest (cost, audit) by trying all letters for all rows, with few insertions."""
    best = (9e9, "")
    for letters in itertools.product("DKR", repeat=len(marks)):
        gaps = range(len(marks) + 1)
        for number in range(most + 1):
            for at in itertools.combinations_with_replacement(gaps, number):
                cost, audit, choices = 0, "", []
                for i in gaps:
                    audit += "I" * at.count(i)
                    cost += 5 * at.count(i)
                    choices += ["ua"] * at.count(i)
                    if i < len(marks):
                        (initial, fault), x = marks[i], letters[i]
                        if x != "D" and fault in ("blank", "duplicate"):
                            cost += 10**6
                        cost += {"D": 2, "K": 0, "R": 1}[x] + 5 * (x != "D" and fault == "truncated")
                        choices += [] if x == "D" else [initial] if x == "K" else ["ua"]
                        audit += x
                if (cost, audit) < best and any(
                    re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in itertools.product(*choices)
                ):
                    best = (cost, audit)
    return best


def plain_report(rows, damage=True):
    ids = {r[0] for r in rows}
    left = plain_damage(rows) if damage else rows
    out = {}
    for conv in ids:
        mine = sorted((r[1:] for r in left if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = plain_faults(mine)
        initials = [r[1][:1] for r in mine]
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = plain_best(list(zip(initials, faults, strict=True)))
        kept, at, state = [], 0, ""
        for i, letter in enumerate(audit):
            if letter == "K":
                kept.append([mine[at][1], mine[at][2]])
            elif letter != "D":
                role = {"u": "assistant"}.get(state, "user")
                kept.append([role, "" if letter == "I" else mine[at][2]])
            if letter != "D":
                state = kept[-1][0][:1]
            at += letter != "I"
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (
            gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def told(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def test_plain_programme_tries_all_audits():
    random.seed(3)
    for _ in range(60):
        marks = [(random.choice("suax"), random.choice([None, None, "blank", "truncated"])) for _ in range(random.randint(0, 4))]
        assert plain_best(marks) == every_audit(marks)


def test_programme_from_every_state(monkeypatch):
    """With weak hashes too: equal hashes of different prefixes are told apart."""
    random.seed(4)
    for prime in (repair.PRIME, 2):
        monkeypatch.setattr(repair, "PRIME", prime)
        for _ in range(300):
            marks = [(random.choice(["s", "u", "a", "x", ""]), random.choice([None, None, "blank", "duplicate", "truncated"])) for _ in range(random.randint(0, 30))]
            programme = repair.Programme(repair.START)
            for initial, fault in marks:
                programme.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
            found = programme.found()
            assert min(found[e] for e in repair.ENDS if e in found) == plain_best(marks)


def test_order_of_linked_strings():
    random.seed(5)
    nodes = repair.Nodes()
    made = {}
    for _ in range(300):
        text, node = "".join(random.choices("DI", k=random.randint(0, 12))), 0
        for letter in text:
            node = nodes.child(node, letter)
        made[text] = node
        assert nodes.text(node) == text
    for a, b in itertools.product(list(made)[:60], repeat=2):
        assert nodes.less(made[a], made[b]) == (a < b)


def odd_rows():
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("user", "Hi."), ("assistant", "Yes."), ("user", "x" * 100_000 + ".")])]
    rows += [(2, None, None, None), (2, None, "user", "b."), (2, 0, "user", "b."), (2, 0, "user", "b.")]
    rows += [(None, 1, "user", "no id?"), (None, 2, "assistant", ""), (3, 5, "", " \n\t"), (4, None, "system", "only.")]
    rows += [(5, t, "tool", "tie.") for t in (1, 1, 1, 9)] + [(6, 0, "user", "é…"), (6, 0, "assistant", "ß.\x0b")]
    random.seed(6)
    rows += [(7, t, random.choice(["user", "assistant", "system"]), random.choice(["a.", "b", "c!", "d?"]) + str(t % 40) * (t % 3)) for t in range(600)]
    return rows


@pytest.mark.parametrize("parts", [1, 40])
def test_report_on_odd_conversations(spark, parts):
    """Also with conversations cut into many pieces, and columns that bear working names."""
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "c", 1, "K") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        assert told(repair.reported(frame, repair.damaged(frame))) == plain_report(rows)
        got = told(repair.reported(frame, frame.fillna(" ", ["role", "text"])))
        assert got == plain_report([(c, t, r or ("" if r == "" else " "), x if x is not None else " ") for c, t, r, x in rows], damage=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_conversation_is_cut(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"t{t % 50}.") for t in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    work = Workspace(spark, "test")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = repair.ordered(frame, work)
        answers = repair.solved(repair.faults(ordered), work)
        assert answers.count() > 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_report_on_given_conversations(given):
    frame = given("conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert told(repair.reported(frame, repair.damaged(frame))) == plain_report(rows)
    empty = frame.limit(0)
    assert told(repair.reported(empty, repair.damaged(empty))) == {}
