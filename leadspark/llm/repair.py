"""Repair of conversation structure by a dynamic programme over edits, with its audit.

A conversation is repaired when the first letters of its roles read (s?(ua)+)?. Rows are
kept, given the role user or assistant, or deleted, and empty rows may be inserted; the
cheapest edits are wanted, and among them those whose letters (the audit) come first.

For every state of the role pattern the programme holds its cheapest edits so far. Edits
are linked nodes that share their prefixes: a node has its letter, depth, ancestors at
powers of two and the rolling hash of all letters up to it. A tie is settled at the first
letter that differs, which ancestors and hashes find in logarithmic time. Nodes are made
once for a parent and letter, so that equal prefixes are one node: a hash that says
"equal" is verified by asking whether the nodes are the same. Two audits of equal cost over
the same rows are never prefixes of one another (the longer one has more inserted rows), so
that the smaller prefix stays the smaller one, whatever follows.

Rows are put in order by a range partitioning on conversation and place, which cuts a long
conversation among tasks. A task solves its piece of a cut conversation from every state it
may begin in; pieces then join as (cost, audit) from state to state. A conversation is thus
never gathered: tasks hold one letter for each of its rows, and no texts.

Edge cases: NULL roles and texts count as one space; NULL turns come first and conversations
with NULL ids are one conversation; rows of one turn are ordered by role and text, and equal
rows stay adjacent; empty and long texts are rows like others; a role is known by its first
letter (one with another letter, or empty, must change or go); an empty table gives none.
Only the four named columns are read, so that others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace

# Fixed values of the contract.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
BLANKS = "\x20\t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

#: States of the role pattern: nothing yet, after system, user, assistant; and the states
#: that a conversation may end in.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
STEPS = {
    START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
NAMES = {"u": "user", "a": "assistant"}
BASE, PRIME = 131, (1 << 61) - 1


class Nodes:
    """Strings as linked nodes that share prefixes; node 0 is the empty string."""

    def __init__(self):
        self.letter, self.depth, self.mark, self.up, self.below = [""], [0], [0], [[]], {}

    def child(self, node: int, letter: str) -> int:
        key = (node, letter)
        found = self.below.get(key)
        if found is None:
            found = self.below[key] = len(self.letter)
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.mark.append((self.mark[node] * BASE + ord(letter)) % PRIME)
            ups, at = [], node
            while True:  # the ancestors 1, 2, 4, ... letters up
                ups.append(at)
                if len(self.up[at]) < len(ups):
                    break
                at = self.up[at][len(ups) - 1]
            self.up.append(ups)
        return found

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            far = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][min(far, len(self.up[node]) - 1)]
        return node

    def _same(self, a: int, b: int) -> bool:
        return self.mark[a] == self.mark[b] and a == b

    def less(self, a: int, b: int) -> bool:
        """Whether the string at `a` comes before that at `b`."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self._same(x, y):
            return self.depth[a] < self.depth[b]
        power = depth.bit_length()
        while power >= 0:
            if power < len(self.up[x]) and not self._same(self.up[x][power], self.up[y][power]):
                x, y = self.up[x][power], self.up[y][power]
            power -= 1
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))


class Programme:
    """The cheapest edits of rows so far, from one state to each state."""

    def __init__(self, start: int):
        self.nodes = Nodes()
        self.best = {start: (0, 0)}
        self._insert()

    def _offer(self, best: dict, state: int, cost: int, parent: int, letter: str) -> bool:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return False
        node = self.nodes.child(parent, letter)
        if held is None or cost < held[0] or (node != held[1] and self.nodes.less(node, held[1])):
            best[state] = (cost, node)
            return True
        return False

    def _insert(self) -> None:
        todo = list(self.best)
        while todo:
            state = todo.pop()
            cost, node = self.best[state]
            for role, onward in STEPS[state].items():
                if role in NAMES and self._offer(self.best, onward, cost + COSTS[INSERT], node, INSERT):
                    todo.append(onward)

    def row(self, initial: str, gone: bool, truncated: bool) -> None:
        best: dict[int, tuple[int, int]] = {}
        more = TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(best, state, cost + COSTS[DELETE], node, DELETE)
            if gone:
                continue
            for role, onward in STEPS[state].items():
                if role == initial:
                    self._offer(best, onward, cost + more + COSTS[KEEP], node, KEEP)
                if role in NAMES:
                    self._offer(best, onward, cost + more + COSTS[REROLE], node, REROLE)
        self.best = best
        self._insert()

    def found(self) -> dict[int, tuple[int, str]]:
        return {state: (cost, self.nodes.text(node)) for state, (cost, node) in self.best.items()}


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the stated damage: a fifth of a row's kinds are dropped, emptied,
    stripped of stops, repeated, or given to the user, by a hash of its id and turn."""
    held = {c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")}
    mark = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(mark.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", *(v.alias(c) for c, v in held.items()), kind.alias("kind"))
    rows = rows.where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).select("conv_id", "turn", "role", "text")


def named(conv: str) -> Column:
    """A name for a conversation that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def ordered(rows: DataFrame, work: Workspace) -> DataFrame:
    """(conv, place, turn, role, text): rows with numbers that follow the order, one apart
    within a partition."""
    filled = rows.select(
        named("conv_id").alias("conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = ["conv", "turn", "role", "text"]
    put = filled.repartitionByRange(*order).sortWithinPartitions(*order)
    return work.store(put.withColumn("place", F.monotonically_increasing_id()), "rows")


def faults(rows: DataFrame) -> DataFrame:
    """(conv, place, turn, initial, fault): the first fault of each row, or NULL."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    alike = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    marked = rows.select(
        "conv", "place", "turn", F.substring("role", 1, 1).alias("initial"), alike.alias("alike"),
        F.substring(bare, -1, 1).alias("end"), (F.length(bare) == 0).alias("blank"),
    )
    # Copies are folded in each task first: a row that comes very often is one row here.
    first = marked.groupBy("conv", "alike").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    told = marked.join(first, "place", "left")
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("end").isin(".", "!", "?"), "truncated")
    )
    return told.select("conv", "place", "turn", "initial", fault.alias("fault"))


PIECES = "conv string, place long, n long, edge boolean, first string, last string, illegal long, start int, end int, cost long, audit string"


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows of one conversation with places one apart, solved from state to state.

    The first and last run of consecutive places may go on in another task, and so are
    solved from every state.
    """
    conv = before = None
    state: dict = {}
    out: list[tuple] = []
    edge = True  # whether the open run begins where places begin

    def closed(cut: bool) -> None:
        for start, programme in state["from"].items():
            if start == START or state["edge"]:
                for end, (cost, audit) in programme.found().items():
                    out.append((
                        conv, state["place"], state["n"], state["edge"] or cut, state["first"], state["last"],
                        state["illegal"], start, end, cost, audit,
                    ))

    for batch in batches:
        columns = (batch[c].tolist() for c in ("conv", "place", "initial", "fault"))
        for name, place, initial, fault in zip(*columns, strict=True):
            jump = before is None or place != before + 1
            if jump or name != conv:
                if before is not None:
                    closed(jump)
                edge, conv = jump, name
                starts = range(4) if edge else (START,)
                state = {"from": {s: Programme(s) for s in starts}, "edge": edge, "place": place, "n": 0, "first": initial, "last": None, "illegal": 0}
            if state["last"] is not None and state["last"] + initial not in LEGAL:
                state["illegal"] += 1
            state["last"] = initial
            state["n"] += 1
            before = place
            for programme in state["from"].values():
                programme.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if len(out) > 1000:
            yield _frame(out)
            out = []
    if before is not None:
        closed(True)
    yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pd.DataFrame(rows, columns=names, dtype=object)


JOINED = "conv string, place long, start int, end int, audit string, cost long, illegal long"


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation put together: the audit of each, with the states it
    begins and ends in; cost and illegal pairs stand at the first piece."""
    best: dict[int, tuple[int, str]] = {START: (0, "")}
    trail: list[tuple[int, dict]] = []
    illegal, last = 0, None
    for place, piece in rows.groupby("place", sort=True):
        one = piece.iloc[0]
        illegal += int(one["illegal"]) + (last is not None and last + one["first"] not in LEGAL)
        last = one["last"]
        onward: dict[int, tuple[int, str]] = {}
        came: dict[int, tuple[int, str]] = {}
        for start, end, cost, audit in zip(piece["start"], piece["end"], piece["cost"], piece["audit"], strict=True):
            if start in best:
                whole = (best[start][0] + int(cost), best[start][1] + audit)
                if end not in onward or whole < onward[end]:
                    onward[end], came[end] = whole, (start, audit)
        best = onward
        trail.append((int(place), came))
    end = min((e for e in ENDS if e in best), key=best.__getitem__)
    cost, out = best[end][0], []
    for place, came in reversed(trail):
        start, audit = came[end]
        out.append([one["conv"], place, start, end, audit, 0, 0])
        end = start
    out[-1][5:] = [cost, illegal]
    return pd.DataFrame(out, columns=[x.split()[0] for x in JOINED.split(", ")], dtype=object)


def solved(marks: DataFrame, work: Workspace) -> DataFrame:
    """(conv, place, start, end, audit, cost, illegal): for each piece of a conversation its
    part of the audit; cost and illegal of the pieces add up."""
    narrow = marks.select("conv", "place", "initial", "fault")
    put = narrow.repartitionByRange("place").sortWithinPartitions("place")
    pieces = work.store(put.mapInPandas(_pieces, PIECES), "pieces")
    whole = pieces.where(~F.col("edge") & F.col("end").isin(*ENDS))
    best = F.min(F.struct("cost", "audit", "end")).alias("best")
    whole = whole.groupBy("conv", "place", "illegal").agg(best)
    whole = whole.select("conv", "place", F.lit(START).alias("start"), "best.end", "best.audit", "best.cost", "illegal")
    # Few conversations lie on the edge of a task: two for each task at most.
    cut = pieces.where("edge").groupBy("conv").applyInPandas(_joined, JOINED)
    return work.store(whole.unionByName(cut), "solved")


ACTIONS = "conv string, piece long, nth long, place long, role string"


def _actions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the repaired conversation: the place of the row that stays, if any, and the
    role that is given, if any."""
    for batch in batches:
        out: list[tuple] = []
        columns = (batch[c].tolist() for c in ("conv", "place", "start", "end", "audit"))
        for conv, piece, state, end, audit in zip(*columns, strict=True):
            at = piece
            # A row kept first is a system row if the turns left over end in this state.
            turns = len(audit) - audit.count(DELETE)
            system = end == SYSTEM or (turns > 1 and (turns % 2 == 0) == (end == USER))
            for nth, letter in enumerate(audit):
                if letter != DELETE:
                    first_kept = state == START and letter == KEEP and system
                    role = "s" if first_kept else "u" if "u" in STEPS[state] else "a"
                    state = STEPS[state][role]
                    out.append((conv, piece, nth, None if letter == INSERT else at, None if letter == KEEP else NAMES[role]))
                at += letter != INSERT
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in ACTIONS.split(", ")], dtype=object)
                out = []
        yield pd.DataFrame(out, columns=[x.split()[0] for x in ACTIONS.split(", ")], dtype=object)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256): of each conversation's `role:text`, joined by newlines.

    A digest reads its text in order, so a conversation is one task's; its rows pass
    through one by one and are not held.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        open_, digest = None, None
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv"], batch["role"], batch["text"], strict=True):
                if conv != open_:
                    if open_ is not None:
                        out.append((open_, digest.hexdigest()))
                    open_, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pd.DataFrame(out, columns=["conv", "sha256"], dtype=object)
        if open_ is not None:
            yield pd.DataFrame([(open_, digest.hexdigest())], columns=["conv", "sha256"], dtype=object)

    put = repaired.repartition("conv").sortWithinPartitions("conv", "piece", "nth")
    return put.select("conv", "role", "text").mapInPandas(hashed, "conv string, sha256 string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits, one row for each conversation, and the repaired rows.

    Audits: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit). Repaired rows:
    (conv, piece, nth, role, text), in the order of piece and nth. `conv` is the name that
    named() gives to conv_id.
    """
    work = Workspace(conversations.sparkSession, "repair")
    rows = ordered(conversations, work)
    marks = work.store(faults(rows), "marks")
    answers = solved(marks, work)
    kinds = ("blank", "duplicate", "truncated")
    turns = marks.groupBy("conv", "turn").agg(*(F.count_if(F.col("fault") == k).alias(k) for k in kinds))
    gap = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = turns.groupBy("conv").agg(F.coalesce(gap, F.lit(0)).cast("long").alias("gaps"), *(F.sum(k).alias(k) for k in kinds))
    parts = F.array_sort(F.collect_list(F.struct("place", "audit")))  # a piece for each task at most
    audits = answers.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit"),
    )
    actions = answers.select("conv", "place", "start", "end", "audit").mapInPandas(_actions, ACTIONS)
    texts = rows.select("place", F.col("role").alias("own"), "text")
    put = actions.join(texts, "place", "left")
    repaired = put.select(
        "conv", "piece", "nth", F.coalesce("role", "own").alias("role"),
        F.when(F.col("place").isNull(), "").otherwise(F.col("text")).alias("text"),
    )
    return counts.join(audits, "conv"), repaired


def reported(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A report on every conversation of `conversations`, of which `rows` are left."""
    audits, repaired = repair(rows)
    every = conversations.select("conv_id").distinct().withColumn("conv", named("conv_id"))
    told = every.join(audits, "conv", "left").join(digests(repaired), "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return told.select(
        "conv_id", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
