"""Repairs against every possible sequence of edits, and against SQL."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from pathwake.llm import conversations, queries
from tests import compare

DIRECTORY = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) over all edits with at most two insertions in one place."""
    faults, best = faults_of(rows), None
    inserts = [list(p) for n in range(3) for p in itertools.product("ua", repeat=n)]
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in faults]
    names = {"u": "user", "a": "assistant"}
    for chosen in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, initials, lines = 0, "", "", []
            for i, edit in enumerate([*chosen, None]):
                for role in gaps[i]:
                    cost, audit, initials = cost + 3, audit + "I", initials + role
                    lines.append(f"{names[role]}:")
                if edit is None:
                    continue
                audit += edit[0]
                if edit == "D":
                    cost += 4
                    continue
                role, text = rows[i]
                role = role if edit == "K" else names[edit[1]]
                cost += (0 if edit == "K" else 3) + (3 if faults[i] == "truncated" else 0)
                initials += role[:1] or "?"
                lines.append(f"{role}:{text}")
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def digest(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def cases():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "cut", "", " \t", "So?  "]
    roles = ["user", "assistant", "system", "tool", "", "supervisor"]
    return {i: [(rng.choice(roles[:3] if i % 3 else roles), rng.choice(texts)) for _ in range(i % 4)] for i in range(1, 60) if i % 4}


def test_repairs_are_the_cheapest_of_all(spark):
    wanted = cases()
    rows = [(i, t, role, text) for i, talk in wanted.items() for t, (role, text) in enumerate(talk)]
    found = {r.conv_id: r for r in conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(found) == set(wanted)
    for i, talk in wanted.items():
        cost, audit, lines = cheapest(talk)
        faults = faults_of(talk)
        initials = [role[:1] for role, _ in talk]
        r = found[i]
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, digest(lines)), talk
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def test_repaired_rows_give_the_digest(spark):
    rows = [(i, t, role, text) for i, talk in cases().items() for t, (role, text) in enumerate(talk)]
    table = spark.createDataFrame(rows, SCHEMA)
    lines = {}
    for r in conversations.repaired_rows(table).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversations.repair(table).collect():
        assert digest(lines.get(r.conv_id, [])) == r.repaired_sha256
        assert LEGAL.fullmatch("".join(x[0] for x in lines.get(r.conv_id, [])))


def test_sql(spark):
    for name in ("sf0.001", "sf0.01"):
        directory = f"/root/testdata/{name}"
        left = compare.spark_rows(queries.QUERIES["op13_conversation_repair"](spark, directory))
        right = compare.sql_rows(compare.connect(directory), queries.ORACLE_SQL["op13_conversation_repair"])
        assert compare.differences(left, right) is None


def test_nulls_ties_gaps_and_dropped_rows(spark):
    rows = [
        (1, None, None, None), (1, 3, "user", "Hi."), (1, 3, "assistant", "Ha."), (1, 9, "assistant", None),
        (None, None, "user", "Hi."), (None, None, "user", "Hi."), (2, 5, "user", "gone"), (3, None, "user", "x"),
    ]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as fault", "2 as seen", "3 as copy", "conv_id = 2 as gone")
    found = {r.conv_id: r for r in conversations.repair(table, F.col("gone")).collect()}
    assert set(found) == {1, None, 2, 3}
    assert (found[1].gaps, found[1].blank, found[1].duplicate) == (5, 2, 0)
    assert (found[None].duplicate, found[None].audit, found[None].gaps) == (1, "KDI", 0)
    none = found[2]
    assert (none.gaps, none.blank, none.cost, none.audit, none.repaired_sha256) == (0, 0, 0, "", digest([]))
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_conversation_streams(spark):
    n = 20_000
    table = spark.range(n).selectExpr(
        "1L as conv_id", "id as turn", "case when id % 2 = 0 then 'user' else 'assistant' end as role", "concat('Turn ', id, '.') as text"
    )
    row = conversations.repair(table.filter("turn <> 7001")).first()
    assert (row.cost, row.gaps, row.illegal) == (3, 1, 1)
    assert row.audit == "K" * 7001 + "I" + "K" * (n - 7002)


def test_tables_of_another_grammar():
    stacks = conversations.Stacks("E", (("E", ("E", "+", "T")), ("E", ("T",)), ("T", ("(", "E", ")")), ("T", ("x",))))

    def accepts(text):
        tops = [stacks.root]
        for symbol in text:
            tops = [n for t in tops for n in stacks.after(t, symbol)]
        return any(stacks.after(t, "$") for t in tops)

    assert all(map(accepts, ["x", "x+x", "(x+x)+x", "((x))"]))
    assert not any(map(accepts, ["", "+x", "x+", "(x", "x)", "xx"]))
