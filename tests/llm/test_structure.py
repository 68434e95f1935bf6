import hashlib
import random

import duckdb
import pytest

from gaffer.llm import structure

SCHEMA = "conv_id long, turn long, role string, text string, position string, copies int, fault string, part int, seq int, audit int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3, 4) for r in rows], SCHEMA)


def brute(turns):
    """Least (cost, audit, repaired) over every edit sequence; turns are (role, text)."""
    faults, seen = [], set()
    for role, text in turns:
        solid = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else
                      "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {}

    def rec(i, last, cost, audit, out, run):
        if i == len(turns) and last in ("", "a"):
            if "" not in best or (cost, audit) < best[""][:2]:
                best[""] = cost, audit, "\n".join(out)
        if run < 2:
            for letter, role in (("u", "user"), ("a", "assistant")):
                if (last != "u") == (letter == "u"):
                    rec(i, letter, cost + 2, audit + "I", [*out, role + ":"], run + 1)
        if i == len(turns):
            return
        role, text = turns[i]
        rec(i + 1, last, cost + 3, audit + "D", out, 0)
        if faults[i] in ("blank", "duplicate"):
            return
        extra = faults[i] == "truncated"
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if role[:1] and role[:1] in follows:
            rec(i + 1, role[:1], cost + extra, audit + "K", [*out, f"{role}:{text}"], 0)
        for new in ("user", "assistant"):
            if new[0] in follows:
                rec(i + 1, new[0], cost + 2 + extra, audit + "R", [*out, f"{new}:{text}"], 0)
    rec(0, "", 0, "", [], 0)
    return best[""], faults


def random_turns(rnd, n):
    return [(rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "umpire"]),
             rnd.choice(["Yes.", "no", " ", "", "Why?", "so\n", "Go! ", f"t{rnd.random()}."])) for _ in range(n)]


def leaf_of(turn, fault):
    return turn[0][:1], fault in ("blank", "duplicate"), fault == "truncated"


def test_chart_equals_brute_force_however_runs_are_cut():
    rnd = random.Random(5)
    for _ in range(120):
        turns = random_turns(rnd, rnd.randint(1, 5))
        (cost, audit, _), faults = brute(turns)
        cuts = sorted(rnd.sample(range(1, len(turns)), rnd.randint(0, len(turns) - 1)))
        runs = []
        for a, b in zip([0, *cuts], [*cuts, len(turns)]):
            parser = structure.Parser()
            for t, f in zip(turns[a:b], faults[a:b]):
                parser.add(*leaf_of(t, f))
            runs.append(parser.cells())
        got, parts = structure.join_runs(runs)
        assert (got, "".join(a for _, a in parts)) == (cost, audit), turns


def test_blocks_of_blocks_equal_one_chart():
    rnd = random.Random(6)
    for n in (1, 7, 8, 9, 20, 64, 70):
        turns = [(rnd.choice("suat"), rnd.random() < .2, rnd.random() < .3) for _ in range(n)]
        parser = structure.Parser()
        for t in turns:
            parser.add(*t)
        assert list(parser.cells()) == list(structure.chart([structure.leaf(*t) for t in turns]))


@pytest.mark.parametrize("parts", [1, 13])
def test_repair_equals_brute_force(llm, parts):
    rnd = random.Random(8)
    talks = {c: random_turns(rnd, rnd.randint(1, 5)) for c in range(25)}
    rows = [(c, t, *turn) for c, turns in talks.items() for t, turn in enumerate(turns)]
    llm.conf.set("spark.sql.shuffle.partitions", str(parts))
    figures, turns = structure.repair(table(llm, rows))
    got = {r.conv_id: r for r in figures.collect()}
    digests = {r.conv_id: r.digest for r in structure.digests(turns).collect()}
    llm.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == 25
    for c, t in talks.items():
        (cost, audit, text), faults = brute(t)
        r = got[c]
        assert (r.cost, r.audit) == (cost, audit)
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert digests.get(c, hashlib.sha256().hexdigest()) == hashlib.sha256(text.encode()).hexdigest()


def test_long_conversation_over_many_partitions_agrees_with_one(llm):
    rnd = random.Random(9)
    rows = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", f"b{t}.", f"c{t}", " "])) for t in range(900)]
    outs = []
    for parts in (1, 23):
        llm.conf.set("spark.sql.shuffle.partitions", str(parts))
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        figures, turns = structure.repair(table(llm, rows))
        outs.append((figures.collect(), structure.digests(turns).collect(), sorted(map(tuple, turns.collect()), key=str)))
    llm.conf.set("spark.sql.shuffle.partitions", "8")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert outs[0] == outs[1]
    assert len(outs[0][0][0].audit) >= 900


def test_edge_cases(llm):
    long = "word " * 200_000 + "end."
    rows = [(None, 0, "user", "Hi."), (None, None, None, None), (1, None, "user", "A."), (1, 5, "user", "A."), (1, 9, None, "B."),
            (2, 3, "assistant", long), (3, 1, "user", "Q?"), (3, 1, "user", "Q?"), (3, 1, "user", "Q?"), (3, 2, "assistant", "R."),
            (4, None, "user", ""), (4, None, "user", "")]
    figures, turns = structure.repair(table(llm, rows))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in figures.collect()}
    assert got[None] == (0, 1, 0, 0, 1, 5, "DKI")      # the null text is one space, before turn 0
    assert got[1] == (3, 0, 1, 0, 2, 5, "KDR")         # nulls first; " " as a role fits nothing
    assert got[2] == (0, 0, 0, 0, 0, 2, "IK")
    assert got[3] == (0, 0, 2, 0, 2, 6, "KDDK")
    assert got[4] == (0, 2, 0, 0, 1, 6, "DD")
    kept = {(r.conv_id, r.position): (r.edit, r.new_role, r.text) for r in turns.collect()}
    assert kept[2, 0] == ("I", "user", "") and kept[2, 1] == ("K", "assistant", long)
    assert [x for x in kept if x[0] == 4] == []
    empty, none = structure.repair(table(llm, rows).limit(0))
    assert empty.count() == 0 and none.count() == 0


def test_query_equals_sql_with_nulls_and_copies(llm):
    rnd = random.Random(11)
    roles = ["system", "user", "assistant", None]
    rows = [(rnd.randint(0, 60), t, rnd.choice(roles), rnd.choice([None, "A.", f"b{t}!", f"c{t}", "Why? "])) for t in range(400)]
    rows += rows[:20] + [(99, 3, "user", None), (None, 4, "user", "x.")]
    got = structure.damaged_and_repaired(table(llm, rows)).toPandas()
    con = duckdb.connect()
    con.register("conversations", table(llm, rows).select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64"}))
    want = con.sql(structure.ORACLE_SQL).df()
    order = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).replace({"nan": "None", "<NA>": "None"}).values.tolist()))
    key = lambda rows: [tuple(str(x).replace(".0", "") for x in r) for r in rows]
    assert key(order(got)) == key(order(want))
