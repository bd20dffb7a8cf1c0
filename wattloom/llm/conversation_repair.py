"""Repair of conversations to the role order ``(s?(ua)+)?`` by a generalised LR parse with edits.

Grammar: S -> nothing | L; L -> s u a | u a | L u a, over the initials of the roles. The parser reads a conversation's rows and may at each
keep the row, give it another role, delete it, or insert an empty row before it, all with costs. Alternatives are held in a graph-structured stack: stacks
share what lies below, and two that have the same top are merged into the one of least cost and, at equal cost, of the
least audit (the initials of its edits in ASCII order). A complete pair is reduced at once, so there are six tops at most.

Audits are not compared as whole strings: after each row the tops carry the rank of their audit, and a rank together with the
edits added since decides. Tops that can't win any more are dropped, and what all others have in common is put out,
so a task holds only the rows since the alternatives last agreed, however long a conversation is. Rows that must be deleted
(blank or seen before) carry no text, and a run of them is one step. Rows come by conversation and turn from one shuffle; the sum of a repaired
text is sequential, so one conversation is one task's, read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.base import query, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
HOLD = 64  # rows held before looking for what the alternatives have in common
BLANK, LATE, OPEN = 1, 2, 3

# LR table of the grammar. States: 0 start, 1 s, 2 u, 3 L, 5 s u, 6 L u; a closes a pair, which is reduced to L at once.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 5, (3, "u"): 6, (2, "a"): 4, (5, "a"): 7, (6, "a"): 8}
_REDUCE = {4: 2, 7: 3, 8: 3}  # states with a whole right side on top, and its length
_GOTO = {0: 3}
ACCEPT = {0, 3}
# Where one top can do all that another can, at no more than so much more cost.
_COVERS = {0: ((3, DELETE),), 1: ((3, 0),), 2: ((5, 0), (6, 0)), 5: ((2, 0), (6, 0)), 6: ((2, 0), (5, 0))}


class Stack:
    """Nodes of the graph-structured stack: a state on top of another node, made once each."""

    def __init__(self) -> None:
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.made: dict[tuple[int, int], int] = {(0, -1): 0}
        self.moves: dict[int, dict[str, int]] = {}

    def push(self, state: int, below: int) -> int:
        at = self.made.setdefault((state, below), len(self.nodes))
        if at == len(self.nodes):
            self.nodes.append((state, below))
        return at

    def move(self, node: int) -> dict[str, int]:
        """Top after each token that the node can shift, reductions done."""
        if node not in self.moves:
            found = {}
            for token in "sua":
                state = _SHIFT.get((self.nodes[node][0], token))
                if state is None:
                    continue
                top = self.push(state, node)
                while (size := _REDUCE.get(self.nodes[top][0])) is not None:
                    for _ in range(size):
                        top = self.nodes[top][1]
                    top = self.push(_GOTO[self.nodes[top][0]], top)
                found[token] = top
            self.moves[node] = found
        return self.moves[node]


STACK = Stack()


class Parse:
    """One conversation. ``tops``: node to (cost, rank of the audit up to the last row, tokens inserted since, path)."""

    def __init__(self) -> None:
        self.tops: dict[int, tuple] = {}
        self._insert({0: (0, 0, "", None)})
        self.held: list[tuple[str, str] | int] = []  # rows, or numbers of rows that must go, since the last agreement
        self.look = HOLD

    def _insert(self, tops: dict[int, tuple]) -> None:
        """Add what insertions reach, least cost first, and drop tops that others cover."""
        todo = list(tops)
        while todo:
            node = todo.pop(0)
            cost, rank, tail, path = tops[node]
            for token, after in STACK.move(node).items():
                new = (cost + INSERT, rank, tail + token, path)
                if token != "s" and (after not in tops or (new[0], new[1], len(new[2])) < (tops[after][0], tops[after][1], len(tops[after][2]))):
                    tops[after] = new
                    todo.append(after)
        costs: dict[int, int] = {}
        for node, top in tops.items():
            state = STACK.nodes[node][0]
            costs[state] = min(costs.get(state, top[0]), top[0])
        self.tops = {
            node: top for node, top in tops.items()
            if not any(y in costs and costs[y] + more < top[0] for y, more in _COVERS.get(STACK.nodes[node][0], ()))
        }

    def _step(self, found: Iterator[tuple[int, tuple, str, str]]) -> None:
        """Merge ``(node, top before, edit, token)`` by cost and audit, rank the audits, insert."""
        merged: dict[int, tuple] = {}
        for node, cost, (_, rank, tail, path), edit, token in found:
            new = (cost, rank, "I" * len(tail) + edit, tail, token, path)
            if node not in merged or new[:3] < merged[node][:3]:
                merged[node] = new
        ranks = {key: r for r, key in enumerate(sorted({m[1:3] for m in merged.values()}))}
        self._insert({n: (m[0], ranks[m[1:3]], "", (m[5], m[3], m[2][-1], m[4])) for n, m in merged.items()})

    def delete(self, times: int) -> list[tuple]:
        """A run of rows that must go."""
        self.held.append(times)
        self._step((n, t[0] + DELETE * times, t, "D", "") for n, t in self.tops.items())
        return self._agree()

    def read(self, role: str, text: str, is_open: bool) -> list[tuple]:
        """A row that may stay; ``is_open``: it is truncated."""
        self.held.append((role, text))
        initial, stay = role[:1], TRUNCATED if is_open else 0

        def found():
            for node, top in self.tops.items():
                yield node, top[0] + DELETE, top, "D", ""
                for token, after in STACK.move(node).items():
                    if token == initial:
                        yield after, top[0] + KEEP + stay, top, "K", token
                    if token != "s":
                        yield after, top[0] + REROLE + stay, top, "R", token

        self._step(found())
        return self._agree()

    def _agree(self) -> list[tuple]:
        """Edits of the rows that all alternatives treat alike, once enough rows are held."""
        if len(self.held) < self.look:
            return []
        paths = {n: self._steps(t[3]) for n, t in self.tops.items()}
        rows = list(zip(*paths.values(), strict=True))
        same = next((i for i, r in enumerate(rows) if any(x != r[0] for x in r[1:])), len(rows))
        out = [e for i in range(same) for e in self._edits(rows[i][0], self.held[i])]
        self.held = self.held[same:]
        for n, steps in paths.items():
            path = None
            for step in steps[same:]:
                path = (path, *step)
            self.tops[n] = (*self.tops[n][:3], path)
        self.look = max(HOLD, 2 * len(self.held))
        return out

    @staticmethod
    def _steps(path) -> list[tuple]:
        out = []
        while path is not None:
            path, *step = path
            out.append(tuple(step))
        return out[::-1]

    @staticmethod
    def _edits(step: tuple, row) -> list[tuple]:
        """``(edit, times, role, text)`` of a row and of what is inserted before it."""
        tail, edit, token = step
        out = [("I", 1, NAMES[t], "") for t in tail]
        if isinstance(row, int):
            return [*out, ("D", row, None, None)]
        if edit == "D":
            return [*out, ("D", 1, None, None)]
        return [*out, (edit, 1, row[0] if edit == "K" else NAMES[token], row[1])]

    def end(self) -> tuple[int, list[tuple]]:
        """Cost of the best repair, and its edits not put out yet."""
        node = min((n for n in self.tops if STACK.nodes[n][0] in ACCEPT), key=lambda n: (self.tops[n][0], self.tops[n][1], len(self.tops[n][2])))
        cost, _, tail, path = self.tops[node]
        out = [e for step, row in zip(self._steps(path), self.held, strict=True) for e in self._edits(step, row)]
        return cost, out + [("I", 1, NAMES[t], "") for t in tail]


def conversation(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of one conversation, then its counts. ``rows``: ``(turn, role, text, times, fault, late, digest)`` by turn, equal rows side by side."""
    parse, forced = Parse(), 0
    blank = duplicate = truncated = illegal = distinct = 0
    low = high = before = last = None
    for turn, role, text, times, fault, late, digest in rows:
        if times and turn is not None:
            distinct += turn != high
            low, high = turn if low is None else low, turn
        for _ in range(times):
            illegal += last is not None and last + role[:1] not in LEGAL
            last = role[:1]
            same = before == (turn, role, digest)
            before = (turn, role, digest)
            if fault == BLANK or late or same:
                blank, duplicate, forced = blank + (fault == BLANK), duplicate + (fault != BLANK), forced + 1
                continue
            truncated += fault == OPEN
            if forced:
                yield from parse.delete(forced)
                forced = 0
            yield from parse.read(role, text, fault == OPEN)
    if forced:
        yield from parse.delete(forced)
    cost, rest = parse.end()
    yield from rest
    gaps = 0 if low is None else high - low + 1 - distinct
    yield None, 1, None, None, gaps, blank, duplicate, truncated, illegal, cost


EDITS = "conv_id long, place long, edit string, times long, role string, text string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 6]
_COLUMNS = [x.split()[0] for x in EDITS.split(", ")]


def faulted(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """Rows by conversation and turn, each with its fault, in the tasks that will read them.

    NULL roles and texts are one space, an unknown turn comes first. Rows of one turn go by role, then by a digest of role and text. What is
    seen earlier is found by a grouping on digests, so neither a long conversation nor a frequent text is one task's.
    """
    said = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if times is None else times).cast("int").alias("times"),
    )
    said = said.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = said.filter("times > 0").groupBy("conv_id", "digest").agg(F.min(when).alias("first"))
    first = first.select(F.col("conv_id").alias("in_conv"), F.col("digest").alias("same"), "first")
    met = said.join(first, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("digest") == F.col("same")), "left")
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), OPEN).otherwise(0)
    )
    late = F.coalesce(when > F.col("first"), F.lit(False))
    text = F.when(~late & (fault != BLANK) & (F.col("times") > 0), F.col("text"))
    told = met.select("conv_id", "turn", "role", text.alias("text"), "times", fault.alias("fault"), late.alias("late"), "digest")
    return told.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")


def edits(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """Edits of each conversation in order (``place``): ``edit`` is K, R, D or I, ``times`` how often (D only), ``role`` and ``text`` what stands there after
    it; the last one of a conversation has no edit but its counts and cost. ``times``: a row stands so often (0: not at all).

    A conversation without rows has its counts, all 0. An empty table gives no rows; a NULL conversation is one like any other.
    """
    def read(batches):
        out: list[tuple] = []
        for conv, own in _by_first(batches):
            for place, (edit, times, role, text, *counts) in enumerate(conversation(own)):
                out.append((conv, place, edit, times, role, text, *(counts or [None] * 6)))
                if len(out) >= 4096:
                    yield _batch(out, _KINDS, _COLUMNS)
                    out = []
        if out:
            yield _batch(out, _KINDS, _COLUMNS)

    return faulted(rows, times).mapInArrow(read, EDITS)


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _by_first(batches) -> Iterator[tuple]:
    """Value of the first column and an iterator over the rest of its rows, for each run of equal values; rows are read once."""
    def flat():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    rows = flat()
    ahead = next(rows, None)

    def run(value):
        nonlocal ahead
        while ahead is not None and ahead[0] == value:
            yield ahead[1:]
            ahead = next(rows, None)

    while ahead is not None:
        value = ahead[0]
        own = run(value)
        yield value, own
        for _ in own:  # what the caller has left
            pass


def repaired(rows: DataFrame) -> DataFrame:
    """Rows of the repaired conversations: ``conv_id``, ``place``, ``role``, ``text`` and the ``edit`` that each comes from."""
    return edits(rows).filter("edit <> 'D'").select("conv_id", "place", "role", "text", "edit")


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """One row per conversation: counts of faults, ``cost``, ``audit`` (initials of the edits) and SHA-256 of the repaired ``role:text`` lines."""
    def read(batches):
        out = []
        for conv, own in _by_first(batches):
            sha, audit, counts, lines = hashlib.sha256(), [], None, 0
            for _, edit, times, role, text, *counts in own:
                if edit is None:
                    break
                audit.append(edit * times)
                if edit != "D":
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    lines += 1
            out.append((conv, *counts, "".join(audit), sha.hexdigest()))
            if len(out) >= 4096:
                yield _batch(out, kinds, names)
                out = []
        if out:
            yield _batch(out, kinds, names)

    names = [x.split()[0] for x in REPORT.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    return edits(rows, times).mapInArrow(read, REPORT)


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with the faults that their place decides, and how often each stands: one in twenty each is dropped, emptied, robbed of its
    end marks, repeated, or given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    told = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    return told.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times")), F.col("times")


@query("op12_conversation_repair")
def op12(spark, folder):
    return report(*damaged(table(spark, folder, "conversations")))
