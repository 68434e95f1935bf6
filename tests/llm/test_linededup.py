import random

import duckdb
import pytest

from gaffer.llm import linededup as L

SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """Every window of three lines with a word, in order of (doc_id, position)."""
    first, gone = {}, {}
    worded = []
    for i, t in rows:
        lines = (t or "").split("\n")
        worded.append([(k, x.strip(SPACES)) for k, x in enumerate(lines) if x.strip(SPACES)])
    for n in sorted(range(len(rows)), key=lambda n: rows[n][0]):
        w = worded[n]
        for at in range(len(w) - 2):
            key = tuple(x for _, x in w[at:at + 3])
            seen = first.setdefault(key, (n, at))
            if seen != (n, at) and (seen[0] != n or at - seen[1] >= 3):
                gone.setdefault(n, set()).update(k for k, _ in w[at:at + 3])
    out = {}
    for n, (i, t) in enumerate(rows):
        lost = gone.get(n, set())
        text = "" if lost and len(lost) == len(worded[n]) else \
            "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in lost)
        out[i] = (len(worded[n]), len(lost), text)
    return out


def random_rows(seed, n=80):
    rnd = random.Random(seed)
    passage = ["p%d" % k for k in range(6)]
    rows = []
    for i in rnd.sample(range(1000), n):
        lines = [rnd.choice(["", " ", "a", "b", " a ", "c%d" % rnd.randrange(30)]) for _ in range(rnd.randint(0, 12))]
        if rnd.random() < 0.4:
            k = rnd.randint(0, len(lines))
            lines[k:k] = passage[rnd.randint(0, 2):rnd.randint(3, 6)]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(make_docs, seed):
    rows = random_rows(seed)
    want = brute(rows)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got == want


def test_equals_the_sql(llm, make_docs):
    rows = random_rows(9) + [(2000, None), (2001, "")]
    documents = make_docs(rows).select("doc_id", "text").toPandas()  # noqa: F841 (read by name below)
    con = duckdb.connect()
    con.register("documents", documents)
    sql = {r[0]: tuple(r[1:3]) for r in con.execute(L.ORACLE_SQL).fetchall()}
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got == sql


def test_cases_with_a_defined_result(make_docs):
    rows = [(1, "a\nb\nc"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nc"), (4, "a\nb"), (5, None), (6, ""), (7, "r\n" * 9),
            (8, "q\n" * 5), (9, "k\n" * 30_000 + "a\n\nb\n c "), (10, "m\nn\no"), (10, "m\nn\no"), (None, "a\nb\nc")]
    out = {}
    for r in L.dedup_lines(make_docs(rows)).collect():
        out.setdefault(r.doc_id, []).append((r.n_lines, r.n_removed, r.text))
    assert out[None] == [(3, 0, "a\nb\nc")]            # a null id comes first and keeps its lines
    assert out[1] == [(3, 3, "")] and out[3] == [(3, 3, "")]
    assert out[2] == [(5, 3, "x\ny")]
    assert out[4] == [(2, 0, "a\nb")] and out[5] == [(0, 0, "")] and out[6] == [(0, 0, "")]
    assert out[7] == [(9, 6, "r\nr\nr\n")] and out[8] == [(5, 0, "q\n" * 5)]
    assert out[9][0][1] == 30_000 - 3 + 3 and out[9][0][2] == "k\nk\nk\n"
    assert out[10] == [(3, 0, "m\nn\no")] * 2          # one document, twice
    empty = make_docs(rows).limit(0)
    assert L.dedup_lines(empty).count() == 0


def test_other_columns_stay(make_docs):
    df = make_docs([(1, "a")])
    assert L.dedup_lines(df).columns == [*df.columns, "n_lines", "n_removed"]
    assert L.dedup_lines(L.dedup_lines(df)).columns == [*df.columns, "n_lines", "n_removed"]
