"""Repair of conversations: a generalised LR parse of roles with weighted edits.

The role grammar is compiled to SLR tables. A parse runs over the rows of a conversation with
all stacks at once: stacks are nodes that share what lies below them, equal stacks are one node.
Before a row any roles may be inserted; the row is kept, given another role or deleted. Of the
parses that reach one node only the least (cost, audit) goes on, since all of them have the same
future. Audits that reach one row end with that row's letter, so none is the beginning of
another; their order is kept as a rank and strings are never compared as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed by the contract: the grammar (s?(ua)+)? and the costs of edits.
START = "Talk"
GRAMMAR: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Talk", ()), ("Talk", ("Pairs",)), ("Talk", ("s", "Pairs")),
    ("Pairs", ("Pairs", "Pair")), ("Pairs", ("Pair",)), ("Pair", ("u", "a")),
)
ROLES = {"u": "user", "a": "assistant"}  # what may be inserted or given
RULES = {"su", "ua", "au"}
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
SPACE = " \t\n\x0b\x0c\r"
_END = "$"
_COMPACT = 4096
_KEPT, _BLANK, _DUPLICATE, _CUT = range(4)


class Stacks:
    """SLR tables of a grammar, and its stacks as interned nodes ``(state, node below)``."""

    def __init__(self, start: str, grammar: tuple[tuple[str, tuple[str, ...]], ...]):
        self.rules = (("", (start,)), *grammar)
        self.names = {head for head, _ in self.rules}
        self._follow = self._follows()
        self.states: list[frozenset] = []
        self._numbers: dict[frozenset, int] = {}
        self.root = self._node(self._state(frozenset({(0, 0)})), None)
        self._after: dict = {}

    def _follows(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {n: set() for n in self.names}
        follow: dict[str, set[str]] = {n: set() for n in self.names}
        follow[""].add(_END)
        begins = lambda symbol: first[symbol] if symbol in self.names else {symbol}
        size = -1
        while size != (size := sum(map(len, first.values())) + sum(map(len, follow.values())) + len(empty)):
            for head, body in self.rules:
                if all(s in empty for s in body):
                    empty.add(head)
                tail = set(follow[head])
                for symbol in reversed(body):
                    if symbol in self.names:
                        follow[symbol] |= tail
                    tail = begins(symbol) | (tail if symbol in empty else set())
                for symbol in body:
                    first[head] |= begins(symbol)
                    if symbol not in empty:
                        break
        return follow

    def _state(self, kernel: frozenset) -> int:
        items, waiting = set(kernel), list(kernel)
        while waiting:
            rule, dot = waiting.pop()
            body = self.rules[rule][1]
            if dot < len(body):
                for i, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (i, 0) not in items:
                        items.add((i, 0))
                        waiting.append((i, 0))
        whole = frozenset(items)
        if whole not in self._numbers:
            self._numbers[whole] = len(self.states)
            self.states.append(whole)
        return self._numbers[whole]

    @cache
    def _node(self, state: int, below: tuple | None) -> tuple:
        return (state, below)

    def _shift(self, node: tuple, symbol: str) -> tuple | None:
        kernel = frozenset((r, d + 1) for r, d in self.states[node[0]] if self.rules[r][1][d:d + 1] == (symbol,))
        return self._node(self._state(kernel), node) if kernel else None

    def after(self, node: tuple, terminal: str) -> list[tuple]:
        """Nodes after all reductions that ``terminal`` allows and its shift; for the end, the accepted ones."""
        if (node, terminal) not in self._after:
            found, waiting, seen = [], [node], {node}
            while waiting:
                top = waiting.pop()
                if terminal == _END:
                    found += [top] if (0, 1) in self.states[top[0]] else []
                elif (shifted := self._shift(top, terminal)) is not None:
                    found.append(shifted)
                for rule, dot in self.states[top[0]]:
                    head, body = self.rules[rule]
                    if rule and dot == len(body) and terminal in self._follow[head]:
                        below = top
                        for _ in body:
                            below = below[1]
                        reduced = self._shift(below, head)
                        if reduced is not None and reduced not in seen:
                            seen.add(reduced)
                            waiting.append(reduced)
            self._after[node, terminal] = found
        return self._after[node, terminal]


class _Text:
    """Running digest of newline-joined lines."""

    __slots__ = ("digest", "empty")

    def __init__(self, digest=None, empty: bool = True):
        self.digest, self.empty = digest or hashlib.sha256(), empty

    def extended(self, lines: list[str]) -> _Text:
        if not lines:
            return self
        out = _Text(self.digest.copy(), False)
        out.digest.update((("" if self.empty else "\n") + "\n".join(lines)).encode())
        return out


class Repair:
    """The parses of one conversation, fed row by row; memory is a few bytes a row."""

    def __init__(self, stacks: Stacks):
        self.stacks = stacks
        # Entries: node, cost, rank, audit (chunk of older letters, letters since), text.
        self.frontier = [(stacks.root, 0, 0, (None, ""), _Text())]

    def _inserted(self) -> dict:
        """Least (cost, rank, inserted roles) by node, with the entry it comes from."""
        best = {e[0]: (e[1], e[2], "", e) for e in self.frontier}
        waiting = list(best)
        while waiting:
            node = waiting.pop()
            cost, rank, roles, entry = best[node]
            for role in ROLES:
                for reached in self.stacks.after(node, role):
                    made = (cost + INSERT, rank, roles + role, entry)
                    if reached not in best or (made[:2], len(made[2])) < (best[reached][:2], len(best[reached][2])):
                        best[reached] = made
                        waiting.append(reached)
        return best

    @staticmethod
    def _grown(audit: tuple, letters: str) -> tuple:
        older, recent = audit
        recent += letters
        return ((older, recent), "") if len(recent) >= _COMPACT else (older, recent)

    def row(self, role: str, text: str, fault: int) -> None:
        more = TRUNCATED if fault == _CUT else 0
        best: dict = {}

        def offer(node, cost, rank, suffix, entry, roles, line):
            if node not in best or (cost, rank, suffix) < best[node][:3]:
                best[node] = (cost, rank, suffix, entry, roles, line)

        for node, (cost, rank, roles, entry) in self._inserted().items():
            made = "I" * len(roles)
            offer(node, cost + DELETE, rank, made + "D", entry, roles, None)
            if fault not in (_BLANK, _DUPLICATE):
                for reached in self.stacks.after(node, role[:1]) if role else ():
                    offer(reached, cost + more, rank, made + "K", entry, roles, role)
                for given, name in ROLES.items():
                    for reached in self.stacks.after(node, given):
                        offer(reached, cost + REROLE + more, rank, made + "R", entry, roles, name)
        self.frontier = []
        for rank, (node, (cost, _, suffix, entry, roles, line)) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3])):
            lines = [f"{ROLES[r]}:" for r in roles] + ([] if line is None else [f"{line}:{text}"])
            self.frontier.append((node, cost, rank, self._grown(entry[3], suffix), entry[4].extended(lines)))

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest repair."""
        done = [(c, r, len(roles), roles, e) for n, (c, r, roles, e) in self._inserted().items() if self.stacks.after(n, _END)]
        cost, _, count, roles, entry = min(done, key=lambda x: x[:3])
        (older, recent), parts = entry[3], []
        while older is not None:
            older, letters = older
            parts.append(letters)
        audit = "".join(reversed(parts)) + recent + "I" * count
        return cost, audit, entry[4].extended([f"{ROLES[r]}:" for r in roles]).digest.hexdigest()


_STACKS: Stacks | None = None


def _stacks() -> Stacks:
    global _STACKS
    if _STACKS is None:
        _STACKS = Stacks(START, GRAMMAR)
    return _STACKS


class _Summary:
    """Counts and repair of one conversation."""

    def __init__(self):
        self.parse, self.faults = Repair(_stacks()), [0] * 4
        self.illegal, self.before = 0, None
        self.first = self.turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        self.faults[fault] += 1
        if self.before is not None and self.before[:1] + role[:1] not in RULES:
            self.illegal += 1
        self.before = role
        self.parse.row(role, text, fault)

    def values(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        cost, audit, digest = self.parse.result()
        return gaps, self.faults[_BLANK], self.faults[_DUPLICATE], self.faults[_CUT], self.illegal, cost, audit, digest


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_NEW = object()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from rows in the order of (conv_id, turn)."""
    conv, now, done = _NEW, _Summary(), []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[i], pa.int64()) for i in range(7)] + [pa.array(columns[i], pa.string()) for i in (7, 8)],
            names=["conv_id", *_COUNTS, "audit", "repaired_sha256"],
        )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "gone", "turn", "role", "text", "fault")), strict=True):
            if row[0] != conv:
                if conv is not _NEW:
                    done.append((conv, *now.values()))
                conv, now = row[0], _Summary()
            if not row[1]:
                now.add(*row[2:])
        if done:
            yield flush()
    if conv is not _NEW:
        done.append((conv, *now.values()))
        yield flush()


def _with_faults(turns: DataFrame, gone: Column | None) -> DataFrame:
    """``conv_id, turn, role, text, gone, seen, fault``: the first fault of each row, after one shuffle."""
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    ).repartition("conv_id")
    same = W.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(bare == "", _BLANK).when(F.col("seen") > 1, _DUPLICATE)
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), _CUT).otherwise(_KEPT)
    )
    return plain.withColumn("seen", F.row_number().over(same)).withColumn("fault", fault)


_ORDER = ("turn", "role", "text", "seen")


def repair(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row a conversation of ``turns(conv_id, turn, role, text)``: faults and cheapest repair.

    ``gaps, blank, duplicate, truncated, illegal, cost`` are longs; ``audit`` has a letter an
    edit: Keep, Rerole, Delete, Insert; ``repaired_sha256`` is the digest of the repaired lines
    ``role:text``. Rows for which ``gone`` is true take no part, but their conversation stays in
    the result.

    Defined for every input: nulls in role and text read as one space, so that such a text is
    blank and such a role fits nowhere; null turns come first and leave no gap; null is a
    conversation of its own; rows of one turn are ordered by role and text; repeated rows are
    duplicates; a role without a character is only given another or deleted; an empty table
    gives an empty result; other columns are not read.

    Faults are found by Spark. The digest of a conversation is one sequential sum, so its rows
    stream in order through one task, which holds a handful of parses and a few bytes a row
    for their audits, never its texts; all conversations of a task share its batches.
    """
    rows = _with_faults(turns, gone).sortWithinPartitions("conv_id", "gone", *_ORDER)
    schema = "conv_id bigint, " + "".join(f"{c} bigint, " for c in _COUNTS) + "audit string, repaired_sha256 string"
    return rows.select("conv_id", "gone", "turn", "role", "text", "fault").mapInArrow(_summaries, schema)


def repaired_rows(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)`` of the repaired conversations, deleted rows left out.

    The letters of each audit are dealt to the rows they belong to, a row's insertions before
    it; given and inserted roles follow from the number of turns before. Inputs as for
    :func:`repair`.
    """
    audits = repair(turns).select("conv_id", F.posexplode(F.regexp_extract_all("audit", F.lit("(I*[DKR]|I+$)"), F.lit(1))).alias("row", "letters"))
    order = W.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    rows = _with_faults(turns, None).select("conv_id", (F.row_number().over(order) - 1).alias("at"), "role", "text")
    named = audits.withColumnRenamed("conv_id", "conv")
    dealt = named.join(rows, F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("row") == F.col("at")), "left")
    each = dealt.select("conv", "row", "role", "text", F.posexplode(F.split("letters", "")).alias("step", "edit")).filter("edit not in ('D', '')")
    system = (F.col("edit") == "K") & (F.substring("role", 1, 1) == "s")
    place = W.partitionBy("conv").orderBy("row", "step")
    before = F.sum(F.when(system, 0).otherwise(1)).over(place.rowsBetween(W.unboundedPreceding, -1))
    given = F.when(F.coalesce(before, F.lit(0)) % 2 == 0, "user").otherwise("assistant")
    return each.select(
        F.col("conv").alias("conv_id"), (F.row_number().over(place) - 1).alias("place"), "edit",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"),
    )


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by the hash of ``conv_id:turn``: what the registered query repairs.

    Of twenty remainders 0 marks the row as ``gone``, 1 empties its text, 2 takes its full stops,
    exclamation and question marks, 3 repeats it, 4 makes it a user's. Nulls read as one space.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
