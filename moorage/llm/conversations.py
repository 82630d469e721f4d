"""Repair of the structure of conversations: the cheapest edits by a Viterbi search whose survivors coalesce.

Rows of a conversation, by turn, shall have the roles ``(system? (user assistant)+)?``, told by their initials. A row is
kept (K, 0), gets another role (R, 1) or is deleted (D, 2); an empty row may be inserted (I, 5). Blank rows and repeated
ones have to go; a truncated one that stays costs 5 more. Of edits of equal cost those whose letters are least count.

The search walks the rows once. Each of four states (nothing yet, after system, after user, after assistant) has one
survivor, a leaf in a tree of back pointers whose nodes count their children: leaves without survivors go, and where the
root has one child left all survivors agree, so its edit is final and leaves the tree. Survivors that can't win any more,
since another one can do the same for less, are dropped at once, which lets the others agree early. Two survivors' letters
never begin one another, so what decides between them stays decided: their order is carried from row to row, which
equals comparing the complete suffixes that are not final yet. Should ``PENDING`` characters of text wait for that, the
survivors go on as trees of their own, each with its own digest and letters, so texts are never piled up.

What is not said by the rules above: rows of one turn come by role, by the first ``PREFIX`` characters of text and by
digest. Turns that are null come first. Null roles and texts are one space, and so are null ids and turns in the draw of
damage. Rows of a null id are one conversation. A role without a character fits nowhere. A conversation without rows left
has zeros, no edits and the digest of nothing. No rows give no conversations. Columns of other names take no part.

A conversation's digest runs over all of its text in order, so its rows have to pass one task, sorted; that task holds
a few of them at a time. Repeats are found before, by an aggregation on the digest of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
PREFIX = 64
PENDING = 1 << 20  # characters that may wait for agreement
TAIL = 4096
LARGEST = 2**63 - 1

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
BY_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWERS = {EMPTY: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, TRUNCATED_COST, INSERT_COST = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
# What it may cost at most to go on from the first state as a survivor of the second would: to do without a system row
# that the other still could keep, or to insert the row that is missing.
DETOUR = {
    (EMPTY, SYSTEM): 0,
    (EMPTY, ASSISTANT): 0,
    (ASSISTANT, SYSTEM): 0,
    (ASSISTANT, EMPTY): DELETE_COST,
    (EMPTY, USER): INSERT_COST,
    (SYSTEM, USER): INSERT_COST,
    (ASSISTANT, USER): INSERT_COST,
    (USER, SYSTEM): INSERT_COST,
    (USER, ASSISTANT): INSERT_COST,
    (USER, EMPTY): INSERT_COST + DELETE_COST,
}


def moves(role: int | None, forced: bool, truncated: bool) -> list[tuple[int, int, str, int]]:
    """State before, state after, letters and cost of all that can be done with a row.

    An insertion comes right before a row that stays: before a deleted one its letters would be larger. Two insertions
    in a row never are cheapest.
    """
    found = [(state, state, DELETE, DELETE_COST) for state in FOLLOWERS]
    if forced:
        return found
    for state in FOLLOWERS:
        inserted = ASSISTANT if state == USER else USER
        for at, letters, cost in ((state, "", 0), (inserted, INSERT, INSERT_COST)):
            cost += TRUNCATED_COST * truncated
            for after in FOLLOWERS[at]:
                if after == role:
                    found.append((state, after, letters + KEEP, cost))
                elif after in NAMES:
                    found.append((state, after, letters + REROLE, cost + REROLE_COST))
    return found


MOVES = {(r, f, t): moves(r, f, t) for r in (None, SYSTEM, USER, ASSISTANT) for f in (False, True) for t in (False, True)}


class Written:
    """Letters and digest of what is final. Copies share the letters written before, but for the last few."""

    __slots__ = ("before", "tail", "digest", "empty")

    def __init__(self, before: tuple | None = None, tail: tuple[str, ...] = (), digest=None, empty: bool = True) -> None:
        self.before, self.tail, self.digest, self.empty = before, list(tail), digest or hashlib.sha256(), empty

    def copy(self) -> Written:
        return Written(self.before, self.tail, self.digest.copy(), self.empty)

    def add(self, letters: str) -> None:
        self.tail.append(letters)
        if len(self.tail) == TAIL:
            self.before, self.tail = (self.before, "".join(self.tail)), []

    def line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "replace"))
        self.empty = False

    def step(self, node: Node) -> None:
        self.add(node.letters)
        if node.letters == DELETE:
            return
        if node.letters[0] == INSERT:
            self.line(NAMES[USER if node.state == ASSISTANT else ASSISTANT], "")
        self.line(node.role if node.letters[-1] == KEEP else NAMES[node.state], node.text)

    def all_letters(self) -> str:
        parts, rest = ["".join(self.tail)], self.before
        while rest:
            rest, part = rest
            parts.append(part)
        return "".join(reversed(parts))


class Node:
    """An edit in the tree. ``written`` is set at roots only."""

    __slots__ = ("parent", "letters", "state", "role", "text", "children", "written")

    def __init__(self, parent: Node | None, letters: str, state: int, role: str, text: str, written: Written | None = None) -> None:
        self.parent, self.letters, self.state, self.role, self.text = parent, letters, state, role, text
        self.children: list[Node] = []
        self.written = written


class Search:
    """The survivors of one conversation."""

    def __init__(self, pending: int = PENDING) -> None:
        root = Node(None, "", EMPTY, "", "", Written())
        # By state: cost, place in the order of letters, leaf.
        self.survivors: dict[int, tuple[int, int, Node]] = {EMPTY: (0, 0, root)}
        self.roots = [root]
        self.waiting, self.pending = 0, pending

    def push(self, role: str, text: str, forced: bool, truncated: bool) -> None:
        best: dict[int, tuple[int, int, str, Node]] = {}
        for before, after, letters, cost in MOVES[BY_INITIAL.get(role[:1]), forced, truncated]:
            survivor = self.survivors.get(before)
            if survivor is not None:
                offer = (survivor[0] + cost, survivor[1], letters, survivor[2])
                if after not in best or offer[:3] < best[after][:3]:
                    best[after] = offer
        for worse in list(best):
            if any(best[b][0] + DETOUR.get((b, worse), LARGEST) < best[worse][0] for b in best):
                del best[worse]
        order = {key: n for n, key in enumerate(sorted({(o[1], o[2]) for o in best.values()}))}
        leaves = [s[2] for s in self.survivors.values()]
        self.survivors = {}
        for state, (cost, place, letters, parent) in best.items():
            node = Node(parent, letters, state, role, "" if letters == DELETE else text)
            parent.children.append(node)
            self.survivors[state] = (cost, order[place, letters], node)
        self.waiting += len(text) + 1
        for leaf in leaves:
            self._release(leaf)
        self._settle()
        if self.waiting > self.pending:
            self._part()

    def _release(self, node: Node) -> None:
        while not node.children:
            parent = node.parent
            if parent is None:
                self.roots.remove(node)
                return
            parent.children.remove(node)
            node = parent

    def _settle(self) -> None:
        """Edits that all survivors of a tree share are final."""
        live = {id(s[2]) for s in self.survivors.values()}
        for i, root in enumerate(self.roots):
            while len(root.children) == 1 and id(root) not in live:
                child = root.children[0]
                child.parent, child.written = None, root.written
                child.written.step(child)
                if len(self.roots) == 1:
                    self.waiting -= len(child.text) + 1
                child.text = ""
                root = child
            self.roots[i] = root
        if len(self.roots) == 1 and id(self.roots[0]) in live:
            self.waiting = 0

    def _part(self) -> None:
        """Each survivor goes on as a tree of its own."""
        self.roots = []
        for state, (cost, place, leaf) in self.survivors.items():
            path, node = [], leaf
            while node.parent is not None:
                path.append(node)
                node = node.parent
            written = node.written.copy()
            for step in reversed(path):
                written.step(step)
            root = Node(None, "", state, "", "", written)
            self.roots.append(root)
            self.survivors[state] = (cost, place, root)
        self.waiting = 0

    def finish(self) -> tuple[int, str, str]:
        """Cost, letters and digest of the best edits. A conversation can't end with user, nor with system alone."""
        self._part()
        ends = []
        for state, (cost, _, leaf) in self.survivors.items():
            if state == USER:
                leaf.written.add(INSERT)
                leaf.written.line(NAMES[ASSISTANT], "")
                cost += INSERT_COST
            if state != SYSTEM:
                ends.append((cost, leaf.written))
        least = min(cost for cost, _ in ends)
        tied = [(written.all_letters(), written.digest.hexdigest()) for cost, written in ends if cost == least]
        return least, *min(tied)


class Conversation:
    """What is found in the rows of one conversation as they come."""

    def __init__(self, key) -> None:
        self.key = key
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None
        self.search = Search()

    def add(self, turn: int | None, role: str, text: str, blank: bool, truncated: bool, first: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.last = role[:1]
        repeated = not blank and not first
        self.blank += blank
        self.duplicate += repeated
        truncated = truncated and not blank and not repeated
        self.truncated += truncated
        self.search.push(role, text, blank or repeated, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else min(LARGEST, self.high - self.low + 1 - self.turns)
        cost, audit, digest = self.search.finish()
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PRESENT, FIRST, ROW = 0, 1, 2


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as conv, turn, role, text and copies (0: dropped), damaged by the digest of id and turn."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    fault = F.pmod(F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")), F.lit(20))
    return rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(said[2]).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(said[3], "".join(ENDS), "")).otherwise(said[3]).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows of each conversation in their order, in one partition, with a mark before the first of those alike.

    ``rows`` has conv, turn, role, text and copies. Texts are shuffled once; of each kind of row only the digest and the
    smallest turn are aggregated before.
    """
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    judged = rows.select(
        "conv",
        "turn",
        F.col("role"),
        "text",
        "copies",
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(*ENDS)).alias("truncated"),
        F.substring("text", 1, PREFIX).alias("beginning"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        F.lit(ROW).alias("kind"),
    )
    there = judged.where("copies > 0")
    # Turns may be null, and null comes first: a struct keeps that order.
    kinds = there.where(~F.col("blank")).groupBy("conv", "role", "digest", "beginning").agg(F.min(F.struct("turn")).alias("first"))
    marks = kinds.select("conv", "role", "digest", "beginning", F.col("first.turn").alias("turn"), F.lit(FIRST).alias("kind"))
    gone = judged.where("copies = 0").select("conv", F.lit(PRESENT).alias("kind"))
    together = there.unionByName(marks, allowMissingColumns=True).unionByName(gone, allowMissingColumns=True)
    return together.repartition("conv").sortWithinPartitions("conv", "turn", "role", "beginning", "digest", "kind")


def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations of a task, whose rows come in order."""
    current, mark = None, None

    def batch_of(done: list[Conversation]) -> pa.RecordBatch:
        columns = list(zip(*[c.result() for c in done], strict=True))
        arrays = [pa.array(columns[0], key_type), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
        arrays += [pa.array(c, pa.string()) for c in columns[7:]]
        return pa.RecordBatch.from_arrays(arrays, names=["conv", *COUNTS, "audit", "repaired_sha256"])

    for batch in batches:
        key_type = batch.schema.field("conv").type
        done = []
        for conv, turn, role, text, copies, blank, truncated, digest, kind in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current is None or conv != current.key:
                if current is not None:
                    done.append(current)
                current, mark = Conversation(conv), None
            if kind == FIRST:
                mark = (turn, digest)
            elif kind == ROW:
                for _ in range(copies):
                    current.add(turn, role, text, blank, truncated, mark == (turn, digest))
                    mark = None
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of([current])


def repair_report(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What is wrong in each conversation and what mends it: counts, cost, audit and repaired_sha256.

    ``rows`` has conv, turn, role, text and copies: 1 for a row, more for adjacent repeats, 0 for one that only tells that
    its conversation is there.
    """
    read = ["conv", "turn", "role", "text", "copies", "blank", "truncated", "digest", "kind"]
    ordered = ordered_rows(rows).select(*read)
    fields = [StructField("conv", rows.schema["conv"].dataType)]
    fields += [StructField(c, LongType()) for c in COUNTS] + [StructField(c, StringType()) for c in ("audit", "repaired_sha256")]
    return ordered.mapInArrow(searched, StructType(fields)).withColumnRenamed("conv", conv)


def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows from the letters of each conversation and its rows, which follow them."""
    current, letters, at, place, state = None, "", 0, 0, EMPTY

    for batch in batches:
        out: list[tuple] = []

        def write(turn: int | None, role: str, text: str, edit: str) -> None:
            nonlocal place, state
            out.append((current[0], place, turn, role, text, edit))
            place += 1
            state = BY_INITIAL[role[:1]]

        def other() -> str:
            return NAMES[ASSISTANT if state == USER else USER]

        for conv, turn, role, text, copies, kind, audit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current != (conv,):
                current, letters, at, place, state = (conv,), "", 0, 0, EMPTY
            if kind < 0:
                letters = audit
            for _ in range(copies if kind == ROW else 0):
                if letters[at] == INSERT:
                    write(None, other(), "", INSERT)
                    at += 1
                if letters[at] != DELETE:
                    write(turn, role if letters[at] == KEEP else other(), text, letters[at])
                at += 1
            if letters and at == len(letters) - 1 and letters[at] == INSERT:
                write(None, other(), "", INSERT)
                at += 1
        if out:
            kept = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [batch.schema.field("conv").type, pa.int64(), pa.int64(), *[pa.string()] * 3], strict=True)]
            yield pa.RecordBatch.from_arrays(kept, names=["conv", "place", "turn", "role", "text", "edit"])


def repaired_rows(rows: DataFrame, report: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The repaired conversations, row by row: conv, place from 0, turn (null if inserted), role, text and edit.

    ``report`` is what ``repair_report`` gave for ``rows``; its letters are sent before the rows they belong to.
    """
    letters = report.select(F.col(f"`{conv}`").alias("conv"), "audit", F.lit(-1).alias("kind"))
    told = ordered_rows(rows).where(F.col("kind") == ROW).unionByName(letters, allowMissingColumns=True)
    # Letters come first: no row has a kind below zero, so that is looked at before the turn.
    order = [F.col("conv"), F.col("kind") >= 0, "turn", "role", "beginning", "digest"]
    ordered = told.repartition("conv").sortWithinPartitions(*order)
    fields = [StructField("conv", rows.schema["conv"].dataType), StructField("place", LongType()), StructField("turn", LongType())]
    fields += [StructField(c, StringType()) for c in ("role", "text", "edit")]
    out = ordered.select("conv", "turn", "role", "text", "copies", "kind", "audit").mapInArrow(edited, StructType(fields))
    return out.withColumnRenamed("conv", conv)


def conversation_report(rows: DataFrame) -> DataFrame:
    """Report on rows of the usual names after damage."""
    return repair_report(damaged(rows))

