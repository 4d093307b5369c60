"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from larder.llm import periodic_runs
from larder.llm.periodic_runs import run_report, with_cycles

SPLIT = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPLIT:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_runs(words):
    """Maximal stretches of every period; those of equal extent keep the smallest."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if length >= max(6, 4 * q):
                found.setdefault((at, length), q)
            at = end
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text):
    words = words_of(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *longest, 1000 * longest[1] // longest[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def ours(words):
    runs = periodic_runs.repetitions(np.array(words, np.int64), np.zeros(len(words), np.int64))
    return sorted((s, e - s, q) for s, e, q in runs.tolist() if e - s >= 6)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(40))
def test_runs_match_force(seed):
    draw = random.Random(seed)
    for _ in range(40):
        words = []
        for _ in range(draw.randrange(1, 8)):
            unit = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.choice([1, 2, 3, 5, 8, 13, 30]))]
            words += (unit * draw.randrange(1, 12))[: draw.randrange(1, 200)]
        assert ours(words) == brute_runs(words)


def test_famous_words():
    thue_morse = [bin(i).count("1") % 2 for i in range(1024)]
    ruler = [(i & -i).bit_length() for i in range(1, 700)]
    nested = (([1, 1, 1, 1, 2] * 5 + [3]) * 5 + [4]) * 5
    for words in (thue_morse, ruler, nested, fibonacci(900), fibonacci(60) * 6, [0] * 500, [], [1], [1] * 5, [1] * 6):
        assert ours(words) == brute_runs(words)


def test_sets_are_sparse_and_consistent():
    draw = random.Random(5)
    words = np.array([draw.randrange(50) for _ in range(400)] * 2, np.int64)
    names = periodic_runs._repeated_names(words, np.arange(len(words)), len(words))
    tau = 1
    while tau < 8:
        names, tau = periodic_runs._doubled(names, tau), 2 * tau
    contexts = periodic_runs._doubled(names, tau)
    chosen = periodic_runs.synchronising_set(names, contexts, tau, np.zeros(len(words), bool))
    first = [int(i) for i in chosen if i <= 400 - 2 * tau]
    assert [i + 400 for i in first] == [int(i) for i in chosen if i >= 400]
    assert max(np.diff(first)) <= tau and len(first) <= 6 * 400 / tau


@pytest.fixture(scope="module")
def looped(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        words = [f"w{draw.randrange(40)}" for _ in range(draw.randrange(0, 120))]
        if i % 3 == 0:
            words[10:10] = [f"u{j}" for j in range(draw.randrange(1, 12))] * draw.randrange(3, 9)
        rows.append((i, draw.choice([" ", "\n", "\t ", "\r\n"]).join(words)))
    rows += [(None, "a b " * 9), (None, None), (7, "a\x0bb\x0ca\rb a b a b"), (7, "a\x0bb\x0ca\rb a b a b"), (8, ""), (9, "　 　 x\xa0x")]
    return rows


def test_report_matches_force(spark, looped):
    docs = spark.createDataFrame(looped, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, run_report(with_cycles(docs)).collect()), key=repr)
    assert got == sorted((brute_row(*r) for r in looped), key=repr)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in looped)


def test_edges(edge_docs, no_docs):
    got = sorted(map(tuple, run_report(with_cycles(edge_docs)).collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    short = [r for r in rows if len(r[1] or "") < 20000]
    assert len(got) == len(rows)
    assert [g for g in got if g in {brute_row(*r) for r in short}].__len__() == len(short)
    assert run_report(with_cycles(no_docs)).collect() == []


def test_runs_and_collapsed_columns(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y"), (2, None)], "doc_id long, text string")
    rows = docs.select(periodic_runs.runs_of().alias("runs"), periodic_runs.collapsed().alias("text")).collect()
    assert [tuple(r) for r in rows[0].runs] == [(1, 15, 3)] and rows[0].text == "x a b c y"
    assert rows[1].runs == [] and rows[1].text == ""


def test_one_very_long_text(spark):
    words = ["a", "b", "c"] * 30000 + [f"w{i}" for i in range(200000)] + ["d"] * 100000
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = run_report(docs).collect()[0]
    assert (row.n_runs, row.start, row.length, row.period) == (2, 290000, 100000, 1)
