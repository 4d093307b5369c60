"""Collocations against plain counting, and against the oracle SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from larder.llm import oracle
from larder.llm.collocations import collocations, count_tiled

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=30, inside=80, best=2000):
    counts = {}
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            for m in range(1, 5):
                f.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                held |= {q for i in range(len(p) - m + 1) if 100 * a >= inside * f[q := p[i : i + m]]}
        lines = []
        for p, a in candidates.items():
            if p not in held:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                lines.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, rest) in enumerate(sorted(lines)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, rest, n, -score))
    return sorted(out)


def texts(seed, n):
    draw = random.Random(seed)
    common = [f"w{i}" for i in range(12)] + ["é", "日本", "x\x00y", "a\xa0b"]
    phrases = ["New York City Hall", "new york", "of the", "in the end", "a b c d e", "rare find"]
    rows = []
    for i in range(n):
        parts = [draw.choice(phrases) if draw.random() < 0.3 else draw.choice(common) for _ in range(draw.randrange(60))]
        text = "".join(p + draw.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  ", "\x0b"]) for p in parts)
        rows.append((draw.choice(["en", "en", "de", None]), text))
    return [*rows, ("en", None), ("fr", ""), ("fr", " .,"), (None, None), ("es", "z z z z z " * 30), ("es", "Z z")]


@pytest.mark.parametrize("block", [200, 1 << 24])
def test_phrases_match_force(spark, block):
    rows = texts(1, 400)
    docs = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, lang string, text string").repartition(3)
    got = sorted(map(tuple, collocations(docs, block=block).collect()))
    assert got == brute(rows) and len(got) > 20
    few = sorted(map(tuple, collocations(docs, least=4, inside=60, best=300, block=block).collect()))
    assert few == brute(rows, 4, 60, 300) and len(few) > 600


@pytest.mark.parametrize("top, n", [(3, 50), (700, 200_000), (40_000, 300_000), (1, 0)])
def test_tiles_count_every_pair(top, n):
    draw = np.random.default_rng(top)
    x, y = (np.minimum((draw.pareto(0.7, n) * 3).astype(np.int64), top - 1) for _ in range(2))
    got = {(a, b): c for a, b, c in zip(*(v.tolist() for v in count_tiled(x, y)))}
    assert got == Counter(zip(x.tolist(), y.tolist()))


def test_phrases_match_sql(spark):
    rows = [(i, *r) for i, r in enumerate(texts(3, 300))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    ids, langs, bodies = zip(*rows)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": ids, "lang": pa.array(langs, pa.string()), "text": pa.array(bodies, pa.string())}))
    answer = con.sql(oracle.COLLOCATIONS)
    columns = answer.columns
    expected = sorted(tuple(int(v) if isinstance(v, (int, float)) else v for v in r) for r in answer.fetchall())
    assert sorted(map(tuple, collocations(docs).select(*columns).collect())) == expected


def test_edges(edge_docs, no_docs, spark):
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    assert sorted(map(tuple, collocations(edge_docs).collect())) == brute(rows)
    assert collocations(no_docs).collect() == []
    huge = spark.createDataFrame([("en", "a b c, " * 200_000), ("en", "q")], "lang string, text string")
    assert [tuple(r) for r in collocations(huge).collect()] == [("en", 1, "a b c", 200000, 200000, 200000, 600001, 1000000)]
