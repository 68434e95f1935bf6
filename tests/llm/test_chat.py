import random
import re

from gaffer.llm import chat

CODE = {"system": 1, "user": 2, "assistant": 3}


def brute(roles):
    """Cheapest repair by trying every role and up to three insertions a turn."""
    best = [10 ** 9]

    def end(state):
        front, k = {state}, 0
        while not front & set(chat.FINAL):
            front, k = {t for x in front for t in chat.LEGAL_NEXT[x]}, k + 1
        return chat.COST["insert"] * k

    def rec(i, state, cost):
        if cost >= best[0]:
            return
        if i == len(roles):
            best[0] = min(best[0], cost + end(state))
            return
        for a in (1, 2, 3):
            base = cost + (0 if a == roles[i] else chat.COST["relabel"])
            if a == state:
                rec(i + 1, a, base + chat.COST["merge"])
            front = [(state, 0)]
            for s, k in front:
                if a in chat.LEGAL_NEXT[s]:
                    rec(i + 1, a, base + chat.COST["insert"] * k)
                if k < 3:
                    front += [(t, k + 1) for t in chat.LEGAL_NEXT[s]]
    rec(0, 0, 0)
    return best[0]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, position string")


def test_costs_equal_brute_force_however_runs_are_cut():
    rnd = random.Random(3)
    for _ in range(250):
        roles = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 6))]
        cuts = sorted(rnd.sample(range(1, len(roles)), rnd.randint(0, len(roles) - 1)))
        turns = [(r, rnd.getrandbits(63)) for r in roles]
        runs = [turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)])]
        matrices = []
        for run in runs:
            m = chat.step(*run[0])
            for r in run[1:]:
                m = chat.min_plus(m, chat.step(*r))
            matrices.append(m)
        states, cost = chat.plan_runs(matrices)
        assert cost == brute(roles)
        for run, a, b in zip(runs, states, states[1:]):
            assert chat.decode(run, a, b)[-1] == b


def check(rows, out):
    by = {}
    for r in out:
        by.setdefault(r.conv_id, []).append(r)
    src = {}
    for c, turn, role, text in set(rows):
        src.setdefault(c, []).append((turn is None, turn or 0, role or "", text or ""))
    assert set(by) == set(src)
    for c, turns in by.items():
        turns.sort(key=lambda r: r.position)
        assert [r.position for r in turns] == list(range(len(src[c])))
        whole = "".join(r.rendered for r in turns)
        names = re.findall(r"<\|im_start\|>(\w+)\n", whole)
        state = 0
        for n in names:
            assert CODE[n] in chat.LEGAL_NEXT[state]
            state = CODE[n]
        assert state in chat.FINAL and whole.count("<|im_end|>") == len(names)
        assert sum(r.cost for r in turns) == turns[0].total_cost
        assert sorted(t for *_, t in src[c]) == sorted(re.sub(r"<\|im_\w+\|>(\w+)?\n?|^\n\n", "", r.rendered).rstrip("\n") for r in turns)
        if len(turns) <= 6:
            assert turns[0].total_cost == brute([CODE.get((r.role or "").strip().lower(), 0) for r in turns])


def test_repaired_conversations(llm):
    rnd = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["system", "user", "assistant", "User", " tool", None]), rnd.choice(["hi", "", None, "é x"]) or None))
    rows = [(c, t, r, x or "") for c, t, r, x in rows]
    check(rows, chat.repair(table(llm, rows)).collect())


def test_edge_cases(llm):
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (1, None, "assistant", "late"), (1, 0, "user", "q"),
            (2, 5, "user", "tie b"), (2, 5, "user", "tie a"), (2, 5, "assistant", "tie c"), (3, 0, "assistant", "only"),
            (4, 0, "user", "twice"), (4, 0, "user", "twice"), (5, 1, "system", "x" * 200_000)]
    out = chat.repair(table(llm, rows)).collect()
    check(rows, out)
    assert len(out) == len(rows) - 1
    assert chat.repair(table(llm, rows).limit(0)).count() == 0


def test_one_conversation_over_many_partitions(llm):
    """A conversation that holds nearly all rows is cut into runs, not gathered."""
    rnd = random.Random(5)
    roles = [rnd.choice(["user", "assistant", "system", None]) for _ in range(3000)]
    rows = [(7, t, r, f"t{t}") for t, r in enumerate(roles)] + [(8, 0, "user", "z")]
    out = chat.repair(table(llm, rows)).collect()
    check(rows, out)
    m = chat.step(CODE.get(roles[0], 0), 1)
    for r in roles[1:]:
        m = chat.min_plus(m, chat.step(CODE.get(r, 0), 1))
    assert next(r.total_cost for r in out if r.conv_id == 7) == chat.plan_runs([m])[1]


def test_decisions_do_not_depend_on_partitions(llm):
    rnd = random.Random(6)
    rows = [(7, t, rnd.choice(["user", "assistant", "system", None]), f"t{t % 7}") for t in range(400)]
    rows += [(c, t, rnd.choice(["user", "assistant", None]), "x") for c in range(20) for t in range(5)]
    outs = []
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for parts in (1, 37):
        llm.conf.set("spark.sql.shuffle.partitions", str(parts))
        outs.append(sorted(map(tuple, chat.repair(table(llm, rows)).collect()), key=str))
    llm.conf.set("spark.sql.shuffle.partitions", "8")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert outs[0] == outs[1]


def test_a_turn_keeps_its_role_where_that_costs_no_more(llm):
    rows = [(1, 0, "user", "a"), (1, 1, "?", "b"), (1, 2, "assistant", "c"), (1, 3, "?", "d")]
    out = sorted(chat.repair(table(llm, rows)).collect(), key=lambda r: r.position)
    assert out[0].total_cost == 6
    assert [r.new_role for r in out][0] == "user" and out[2].new_role == "assistant"
