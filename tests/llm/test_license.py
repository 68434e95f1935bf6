import random

from gaffer.llm import license as L


def brute(text, threshold=0.8):
    best = {}
    for first, last, passage in L.passages(text or ""):
        grams = L.bigrams(passage)
        for name, texts in L.TEMPLATES.items():
            for t in texts:
                value = L.dice(grams, L.bigrams(t)) if grams else 0.0
                if value >= threshold and value > best.get(name, 0.0):
                    best[name] = value
    return best


def test_pruned_scan_equals_every_comparison(llm):
    scanner = L.Scanner(L.TEMPLATES, 0.8)
    texts = [r.text for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    mit = L.TEMPLATES["MIT"][1]
    texts += [mit, mit.replace(" ", "\n"), "intro\n\n" + mit[:200] + "\n" + mit[200:] + "\n\nend", mit.upper() + " x y z"]
    found = 0
    for t in texts:
        got = {m["license"]: m["dice"] for m in scanner.scan(t)}
        assert got == brute(t)
        found += bool(got)
    assert found >= 20 and scanner.scan(texts[-2])[0]["license"] == "MIT" and scanner.scan(texts[-3])[0]["dice"] == 1.0


def test_operator_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "Released under the MIT License."), (5, "a\nreleased UNDER the mit license\nb"),
            (6, "word " * 50_000), (4, "Released under the MIT License."), (None, "All rights reserved.")]
    out = sorted(((r.doc_id is None, r.doc_id or 0, r.license, r.dice) for r in L.scan(make_docs(rows)).collect()), key=str)
    assert out == sorted([(False, 1, None, None), (False, 2, None, None), (False, 3, None, None), (False, 4, "MIT", 1.0),
                          (False, 4, "MIT", 1.0), (False, 5, "MIT", 1.0), (False, 6, None, None), (True, 0, "reserved", 1.0)], key=str)
    assert L.scan(make_docs(rows).limit(0)).count() == 0


def every_window(text, threshold=0.8):
    """Best coefficient by licence over all runs of words."""
    words, best = L.WORD.findall(text.lower()), {}
    sets = [(name, L.bigrams(t)) for name, texts in L.TEMPLATES.items() for t in texts]
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + 160) + 1):
            grams = L.bigrams(" ".join(words[i:j]))
            for name, s in sets:
                value = L.dice(grams, s)
                if value >= threshold:
                    best[name] = max(value, best.get(name, 0.0))
    return best


def test_notices_inside_lines_and_over_paragraphs():
    scanner = L.Scanner(L.TEMPLATES, 0.8)
    prose = "The river ran past the old mill and the children of the village played there until dark. " * 20
    gpl = "This work is licensed under the GNU General Public License, version 3."
    got = scanner.scan("Some file header here. " + gpl + " See COPYING for details and write to us.")[0]
    assert (got["license"], got["dice"]) == ("GPL-3.0", 1.0)
    bsd = L.TEMPLATES["BSD-3-Clause"][1]
    items = bsd.replace("met: ", "met:\n\n").replace(". Redis", ".\n\nRedis").replace(". Neither", ".\n\nNeither")
    assert items.count("\n\n") == 3
    got = scanner.scan(f"{prose}\n\n{items}\n\n{prose}")[0]
    assert got == {"license": "BSD-3-Clause", "dice": 1.0, "first_line": 2, "last_line": 8}
    words = L.TEMPLATES["MIT"][1].split()
    wrapped = "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
    got = scanner.scan(f"{prose}\nCopyright 2020 A. Nobody {wrapped} and so on.\n{prose}")[0]
    assert (got["license"], got["dice"], got["first_line"]) == ("MIT", 1.0, 1)
    text = "a b Licensed under CC the BY 4.0 and all rights all rights x reserved. " + gpl.replace("is", "was") + " " + gpl
    assert {m["license"]: m["dice"] for m in scanner.scan(text)} == every_window(text)


def test_windows_equal_every_window_of_words():
    rnd = random.Random(1)
    scanner = L.Scanner(L.TEMPLATES, 0.8)
    short = [t for texts in L.TEMPLATES.values() for t in texts if len(t) < 90]
    for _ in range(15):
        words = " ".join(rnd.choice(short) for _ in range(2)).split()
        for _ in range(rnd.randrange(6)):
            words.insert(rnd.randrange(len(words)), rnd.choice(["the", "license", "x", rnd.choice(words)]))
        text = " ".join(words)
        assert {m["license"]: m["dice"] for m in scanner.scan(text)} == every_window(text)
    repeated = scanner.scan("All rights reserved. " * 20_000)
    assert repeated[0] == {"license": "reserved", "dice": 1.0, "first_line": 0, "last_line": 0}
    assert L.Scanner({"m": ["MIT"]}, 0.8).scan("a\nb mit c") == [{"license": "m", "dice": 1.0, "first_line": 1, "last_line": 1}]
