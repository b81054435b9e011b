import hashlib
import random
from collections import defaultdict

import pytest

from punctual.llm import line_copies

SCHEMA = "doc_id long, text string, dropped string, lines long, key string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    keeper = {
        k: max((d for d in ids if d is not None), default=None)
        for k, ids in holders.items()
        if len(ids) >= min_docs
    }
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc_id]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=str)


def digests(spark, rows, **knobs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in line_copies.line_digests(df, **knobs).collect()), key=str)


def corpus(n=150, seed=4):
    rng = random.Random(seed)
    stock = [f"Shared line {i} Über ÄÖ " + "x" * rng.randrange(15, 40) for i in range(12)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(8)):
            line = rng.choice(stock) if rng.random() < 0.5 else f"own {i} {rng.random()} " * 2
            line = line.upper() if rng.random() < 0.1 else line
            lines.append(rng.choice(["", " ", "\t", "\r"]) + line + rng.choice(["", " ", "\r", " "]))
        rows.append((i, "\n".join(lines), "d", 7, "k"))
    return rows


@pytest.mark.parametrize("knobs", [{}, {"min_chars": 1, "min_docs": 2}, {"min_docs": 1}])
def test_against_brute_force(spark, knobs):
    rows = corpus()
    # repeated rows, other texts of an id, rows without id
    rows += rows[:5] + [(3, rows[9][1], "", 0, ""), (None, rows[10][1], "", 0, ""), (None, rows[11][1], "", 0, "")]
    assert digests(spark, rows, **knobs) == brute(rows, **knobs)


def test_edges(spark):
    line = "This line is long enough to be looked for in others."
    rows = [(1, None, "", 0, ""), (2, "", "", 0, ""), (3, "\n\n", "", 0, ""), (4, "   \n" * 3, "", 0, "")]
    rows += [(i, f"{line}\nown {i}\n{line}", "", 0, "") for i in range(10, 15)]
    got = digests(spark, rows)
    assert got == brute(rows)
    assert [r[2] for r in got if r[0] >= 10] == [2, 2, 2, 2, 0]
    assert digests(spark, rows[:-1]) == brute(rows[:-1])
    assert digests(spark, []) == []


def test_long_text_and_hot_line(spark):
    line = "a line that stands in every single document of this table"
    rows = [(i, f"{line}\ntext {i}", "", 0, "") for i in range(3000)]
    rows.append((9000, "\n".join([line, "other"] * 20000), "", 0, ""))
    rows.append((1, "\n".join([line, "other"] * 20000), "", 0, ""))
    assert digests(spark, rows) == brute(rows)


def test_texts_and_columns_stay(spark):
    line = "the very same footer at the end of all the documents"
    rows = [(i, f"body {i}\n{line}", f"d{i}", i, "k") for i in range(6)] + [(9, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = line_copies.without_shared_lines(df)
    assert got.schema == df.schema
    texts = {r.doc_id: (r.text, r.dropped, r.lines) for r in got.collect()}
    assert texts[0] == ("body 0", "d0", 0)
    assert texts[5] == (f"body 5\n{line}", "d5", 5)
    assert texts[9] == (None, None, None)


def test_no_python_in_the_plan(spark, capsys):
    line_copies.line_digests(spark.createDataFrame([], SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
