"""Toxicity, quality, language, licences, encoding and mixing against plain recomputation."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import tiktoken

from larder.llm import bpe, language, licenses, mixing, quality, toxicity
from larder.llm.nptext import Hasher, chunks, words
from larder.llm.queries import RANKS
from larder.llm.tables import bounded_sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def gibberish(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(n))


# --- helpers -------------------------------------------------------------------------


def test_words_and_hashes_of_chunks():
    texts = ["one  two", None, "", " x ", "two", "é two three\x0b\x0cfour"]
    for limit in (1, 4, 1 << 20):
        found = []
        for chunk in chunks(pa.array(texts), limit):
            starts, ends, firsts = words(chunk)
            made = [bytes(chunk.data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
            hashes = Hasher(chunk.data).stretches(starts, ends).tolist()
            for i in range(len(firsts) - 1):
                found.append(list(zip(made, hashes, strict=True))[firsts[i] : firsts[i + 1]])
        assert [[w for w, _ in text] for text in found] == [WORD.findall(t or "") for t in texts]
        names = [pair for text in found for pair in text]
        assert len({h for w, h in names if w == "two"}) == 1
        assert len({h for _, h in names}) == len({w for w, _ in names})


def test_bounded_sample_is_exact_in_size_and_repeats(spark):
    rows = spark.range(10_000)
    first = [r.id for r in bounded_sample(rows, ["id"], 50, 10_000).collect()]
    assert len(first) == 50
    assert [r.id for r in bounded_sample(rows.repartition(7), ["id"], 50, 10_000).collect()] == first
    assert bounded_sample(rows, ["id"], 20_000, 10_000).count() == 10_000
    assert bounded_sample(rows.limit(0), ["id"], 5, 0).count() == 0


# --- toxicity ------------------------------------------------------------------------

BAD = ["grumblewort", "snivelbag", "wretchling"]


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        text = gibberish(rng, ["ta", "ro", "mi", "le", "son", "ke"], 40)
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(text.split()))
            parts = text.split()
            bad = rng.choice(BAD)
            if i % 8 == 0:
                cut = rng.randrange(2, len(bad) - 2)
                bad = bad[:cut] + rng.choice([".", "x", "-"]) + bad[cut:]
            parts.insert(at, bad)
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_held_out_rows_are_found(edge_docs, marked):
    docs, labels = marked
    found = by_id(toxicity.toxicity_report(docs, labels))
    assert all(r["held_out"] == held_out(i) for i, r in found.items())
    unseen = [(i % 4 == 0, r["predicted"]) for i, r in found.items() if r["held_out"]]
    assert sum(t for t, p in unseen if p) >= 0.95 * sum(t for t, _ in unseen)
    assert sum(p for t, p in unseen if not t) <= 0.02 * len(unseen)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, r in found.items() if not r["predicted"]}


def test_repeated_rows_leave_the_machine_as_it_is(marked):
    """Ten thousand copies of a clean labelled row of low id push no other row out of the sample."""
    docs, labels = marked
    copied = next(i for i in range(600) if i % 4 and not held_out(i))
    copies = docs.filter(F.col("doc_id") == copied).crossJoin(docs.sparkSession.range(10_000)).drop("id")
    before = by_id(toxicity.toxicity_report(docs, labels))
    after = by_id(toxicity.toxicity_report(docs.union(copies), labels).dropDuplicates(["doc_id"]))
    assert {i: r["score"] for i, r in after.items()} == pytest.approx({i: r["score"] for i, r in before.items()})


def test_subsequences_match_plain_kernel():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(30)]

    def plain(word):
        out = Counter()
        n = len(word)
        for offsets in toxicity._PATTERNS:
            for i in range(n - offsets[-1]):
                out["".join(word[i + o] for o in offsets)] += toxicity.DECAY ** (offsets[-1] + 1)
        return out

    landmarks = [w for w in dict.fromkeys(vocabulary) if len(w) > 3][:10]
    kernel = toxicity.Kernel([w.encode() for w in landmarks])
    found = kernel.of([w.encode() for w in vocabulary])
    norm = lambda w: float(toxicity._norms(np.array([len(w)]))[0])
    for i, w in enumerate(vocabulary):
        for j, l in enumerate(landmarks):
            a, b = plain(w), plain(l)
            assert found[i, j] == pytest.approx(sum(a[u] * b[u] for u in a) / norm(w) / norm(l), abs=1e-4)


def test_collapsed_machine_scores_as_the_features_do():
    kernel = toxicity.Kernel([b"grumblewort", b"takeson", b"milero"])
    weights = np.array([0.7, -0.4, 0.2])
    model = toxicity.Model(kernel.per_subsequence(weights), 0.1)
    vocabulary = [b"grumble", b"take.son", b"xyz", b"a"]
    letters, word = toxicity._laid_out(vocabulary)
    direct = kernel.features(vocabulary) @ weights + 0.1
    assert model.word_scores(letters, word, 4) == pytest.approx(direct, abs=1e-4)


def test_toxicity_edges(edge_docs, no_docs, no_labels, marked):
    found = toxicity.toxicity_report(edge_docs, marked[1]).collect()
    assert len(found) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == 0 for r in toxicity.toxicity_report(edge_docs, no_labels).collect())
    assert toxicity.toxicity_report(no_docs, no_labels).collect() == []


def test_insults_late_in_long_rows_are_learnt(spark):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(200):
        text = gibberish(rng, ["ta", "ro", "mi", "le", "son", "ke"], 40)
        toxic = i % 4 == 0
        if not held_out(i):
            text = "tarole mison " * 1300 + text
        rows.append((i, f"{text} {rng.choice(BAD)}" if toxic else text))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = by_id(toxicity.toxicity_report(docs, marks))
    unseen = [(i % 4 == 0, r["predicted"]) for i, r in found.items() if r["held_out"]]
    assert sum(t for t, p in unseen if p) >= 0.9 * sum(t for t, _ in unseen)
    assert not any(p for t, p in unseen if not t)


# --- quality -------------------------------------------------------------------------


def base_by_force(text):
    found = WORD.findall(text or "")
    grams = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {i + j for i in range(len(found) - 2) if grams[tuple(found[i : i + 3])] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(found),
        sum(map(len, found)),
        sum(c in quality.SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_match_force(spark, edge_docs):
    rng = random.Random(2)
    extra = [
        (100 + i, "".join(rng.choice(["a ", "b ", "é# ", "\n", "c\n", " $\t"]) for _ in range(rng.randrange(60))))
        for i in range(150)
    ]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    for row in docs.select("text", quality.statistics().alias("m")).collect():
        assert tuple(row["m"][n] for n in quality.BASE) == base_by_force(row["text"]), row["text"]


def test_anomalies_are_rejected_and_good_rows_kept(spark, no_labels):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(500):
        bad = i % 20 == 0
        text = gibberish(rng, ["ta", "ro", "mi", "le"], 90)
        # Anomalies are few and unlike each other; a forest cannot tell a dense group of them.
        junk = f" {'#' * rng.randrange(1, 9)} {'$' * rng.randrange(1, 5)} "
        rows.append((i, text.replace(" ", junk) if bad else text))
        labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = by_id(quality.quality_report(docs, marks))
    assert sum(found[i]["kept"] for i, q, _ in labels if q) >= 0.99 * 475
    assert sum(not found[i]["kept"] for i, q, _ in labels if not q) >= 0.9 * 25
    without = by_id(quality.quality_report(docs, no_labels))
    assert all(r["kept"] != r["base_failed"] for r in without.values())


def test_equal_junk_rows_are_rejected(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(500):
        bad = i % 5 == 0
        text = gibberish(rng, ["ta", "ro", "mi", "le"], 90)
        rows.append((i, text.replace(" ", " ## $ ") if bad else text))
        labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = by_id(quality.quality_report(docs, marks))
    assert sum(found[i]["kept"] for i, q, _ in labels if q) >= 0.99 * 400
    assert not any(found[i]["kept"] for i, q, _ in labels if not q)


def test_threshold_rejects_tied_bad_rows():
    def rejected(good, *bad):
        scores = np.array([*good, *bad])
        kind = np.arange(len(scores)) < len(good)
        return (scores > quality.threshold(scores, kind)).tolist()

    assert rejected([0.45] * 500, *[0.7] * 100) == [False] * 500 + [True] * 100
    assert rejected([0.45] * 500, *[0.7] * 60, *[0.8] * 40) == [False] * 500 + [True] * 100
    assert not any(rejected([0.7] * 500, *[0.7] * 100))
    assert not any(rejected([0.7] * 500, *[0.4] * 100))
    close = np.nextafter(0.5, 1)
    assert rejected([0.5] * 500, *[close] * 10) == [False] * 500 + [True] * 10


def test_path_lengths_match_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 3))
    forest = quality.Forest(rows)
    scores = forest.score(rows[:20])
    for row, score in zip(rows[:20], scores, strict=True):
        total = 0.0
        for feature, cut, child, length in forest.trees:
            node = 0
            while feature[node] >= 0:
                node = child[node] + int(row[feature[node]] > cut[node])
            total += length[node]
        assert score == pytest.approx(2 ** (-total / (quality.TREES * forest.usual)))


def test_quality_edges(edge_docs, no_docs, no_labels):
    found = quality.quality_report(edge_docs, no_labels).collect()
    assert len(found) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in found if r["n_words"] == 0)
    assert quality.quality_report(no_docs, no_labels).collect() == []


# --- mixing --------------------------------------------------------------------------


def targets_by_force(sizes):
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, free, left = {}, list(sources), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mix_meets_its_targets_and_reruns_agree(spark):
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        source = None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, " ".join(["w"] * rng.randrange(0, 60)) or None, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = by_id(mixing.mix_report(docs))
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    target = targets_by_force(size)
    taken = Counter()
    for i, t, s in rows:
        r = found[i]
        assert r["size"] == len((t or "").split()) and r["source_size"] == size[s]
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 3 for s in size)
    assert by_id(mixing.mix_report(docs.repartition(13))) == found
    mixed = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert all(mixed[i] * r["size"] == r["taken"] for i, r in found.items())


def test_tree_deals_out_every_quota(spark):
    quotas = {1: 700, 2: 0, 3: 41, 4: 1}
    table = spark.createDataFrame(list(quotas.items()), "sid int, quota long")
    dealt = mixing.shard_quotas(table, 3).collect()
    assert {s: sum(r.quota for r in dealt if r.sid == s) for s in quotas} == quotas
    per_shard = [sum(r.quota for r in dealt if r.shard == h) for h in range(8)]
    assert max(per_shard) - min(per_shard) <= 1
    big = [r.quota for r in dealt if r.sid == 1]
    assert min(big) > 0.8 * 700 / 8 and max(big) < 1.2 * 700 / 8


def test_mix_meets_its_targets_with_half_of_the_ids_null(spark):
    rng = random.Random(8)
    rows = []
    for i in range(6000):
        text = " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(1, 12))) + f" t{i}"
        rows.append((None if i % 2 else i, "abc"[i % 3], text))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    by_source = F.first("target").alias("target"), F.sum("taken").alias("taken")
    found = mixing.mix_report(docs).groupBy("source_size").agg(*by_source).collect()
    assert len(found) == 3
    assert all(abs(r.taken - r.target) <= 0.01 * r.target for r in found)
    mixed = mixing.mix(docs)
    assert mixed.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == sum(r.taken for r in found)


def test_mix_edges(edge_docs, no_docs):
    found = mixing.mix_report(edge_docs).collect()
    assert len(found) == edge_docs.count()
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    assert mixing.mix(edge_docs).columns == edge_docs.columns
    assert mixing.mix_report(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


# --- encoding ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoder():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_ids_match_the_library(reference_encoder):
    vocabulary = bpe.Vocabulary(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(8)
    texts = [
        "",
        " \n\t  x",
        "aaaaaaaaaaaaaaaaa" * 40,
        "abab" * 500,
        "it's we'll I'M",
        "<|endoftext|>",
        "é ñ 你好 \u0000 \U0001f600" * 20,
    ] + ["".join(rng.choice("abcdeéñ你 .,!0123\n'") for _ in range(rng.randrange(200))) for _ in range(300)]
    for text in texts:
        ids = vocabulary.encode(text)
        assert ids.tolist() == reference_encoder.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_encoding_report_and_round_trip(edge_docs, no_docs, reference_encoder):
    args = (RANKS, public_tokenizers.PATTERN)
    texts = Counter((r.doc_id, r.text) for r in edge_docs.collect())
    found = Counter(
        (r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
        for r in bpe.encoding_report(edge_docs, *args).collect()
    )
    expected = Counter()
    for (doc_id, text), n in texts.items():
        ids = reference_encoder.encode_ordinary(text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        digests = hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        expected[doc_id, len(ids), *digests] += n
    assert found == expected
    assert bpe.encoding_report(no_docs, *args).collect() == []
    back = edge_docs.withColumn("ids", bpe.token_ids(*args)).withColumn(
        "back", bpe.decoded_text("ids", *args)
    )
    assert all((r.text or "") == r.back for r in back.collect())


# --- licences ------------------------------------------------------------------------


def test_base_labels_match_force(spark, edge_docs):
    rng = random.Random(9)
    parts = ["MIT", "license", "apache", "License,", "cc-by", "GNU", "general", "public", "é", "mit license mit license"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(200)]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in docs.select("text", licenses.scanned().alias("s")).collect():
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = sorted(
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(found))
            if found[i : i + len(phrase.split())] == phrase.split()
        )
        s = r["s"]
        assert (s["n_words"], s["n_base"]) == (len(found), len(places))
        assert s["first_word"] == (places[0][0] if places else None)
        assert s["last_word"] == (places[-1][0] if places else None)
        assert s["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(s["base_labels"].split(",")) - {""} <= set(s["labels"].split(","))
        assert 0 <= s["score"] <= 1


def test_notices_with_errors_are_found_with_their_span():
    scanner = licenses.Scanner()
    found = scanner.scan(b"word Permision is herby granted, free of charge to any persn obtaining a copy end")
    assert found["base_labels"] == "" and found["labels"] == "mit"
    assert found["spans"] == [{"label": "mit", "first": 1, "last": 13, "edits": 3}]
    assert 0.9 < found["score"] < 1
    assert scanner.scan(b"permission was granted by a person")["labels"] == ""


def test_edited_notices_before_a_better_copy_are_found():
    scanner = licenses.Scanner()
    found = scanner.scan(b"all rihgts reserved and all rights reserved then all rights resrved")["spans"]
    assert [(s["first"], s["last"]) for s in found] == [(0, 2), (4, 6), (8, 10)]
    assert found[0]["edits"] > 0 == found[1]["edits"] < found[2]["edits"]
    notice = b"redistribution and use in source and binary forms"
    found = scanner.scan(notice.replace(b"source", b"sourcx") + b" " + notice)["spans"]
    assert [(s["first"], s["last"], s["edits"]) for s in found] == [(0, 7, 1), (8, 15, 0)]
    near = b"all rights resrved "
    assert len(scanner.scan(near * 2000)["spans"]) == 2000


def test_license_edges(edge_docs, no_docs):
    found = licenses.license_report(edge_docs).collect()
    assert len(found) == edge_docs.count()
    assert all(r["labels"] == "" and r["score"] == 0 for r in found)
    assert licenses.license_report(no_docs).collect() == []


# --- language ------------------------------------------------------------------------

SYLLABLES = {"en": ["the", "ing", "and", "wh", "st"], "de": ["sch", "ein", "ung", "ich", "ö"], "fr": ["eau", "oi", "que", "é", "lle"]}


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(10)
    names = sorted(SYLLABLES)
    rows = [(i, gibberish(rng, SYLLABLES[names[i % 3]], 60), names[i % 3]) for i in range(300)]
    rows.append((301, gibberish(rng, SYLLABLES["de"], 300) + " " + gibberish(rng, SYLLABLES["fr"], 150), None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_rows(edge_docs, spoken):
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    found = by_id(language.language_report(spoken))
    assert all(r["lang_pred"] == truth[i] for i, r in found.items() if truth[i])
    assert all(r["held_out"] == held_out(i) for i, r in found.items())
    assert found[301]["languages"] == "de,fr" and found[301]["lang_pred"] == "de"
    assert found[301]["score"] == pytest.approx(2 / 3, abs=0.05)


def test_languages_are_learnt_from_whole_texts(spark):
    rng = random.Random(12)
    rows = []
    for i in range(120):
        lang = sorted(SYLLABLES)[i % 3]
        own = gibberish(rng, SYLLABLES[lang], 60)
        # All languages begin alike; what tells them apart stands behind the first 4,000 bytes.
        rows.append((i, own if held_out(i) else "mumu " * 1000 + own, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = by_id(language.language_report(docs))
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows if held_out(i))


def test_all_languages_and_grams_are_learnt(spark, no_docs):
    texts = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} é", f"l{i % 250}") for i in range(2000)] + [(5, "", "none")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    models = language.trained(docs.repartition(5))
    kept = [(t, lang) for i, t, lang in texts if t and not held_out(i)]
    assert models.languages == sorted({lang for _, lang in kept}) and len(models.languages) > 200
    plain = {lang: np.zeros(language._GRAMS, np.int64) for lang in models.languages}
    for text, lang in kept:
        np.add.at(plain[lang], language.gram_codes(np.frombuffer(text.encode(), np.uint8)), 1)
    expected = language.Models({m: (np.flatnonzero(c), c[c > 0]) for m, c in plain.items()})
    assert (models.table == expected.table).all()


def test_mixture_finds_the_likeliest_proportions():
    likelihood = np.array([[0.9, 0.1], [0.8, 0.2], [0.1, 0.9], [0.3, 0.7]])
    share, _ = language._mixture(likelihood, np.zeros(4, int), 1, np.array([[True, True]]))
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([np.log(likelihood @ np.array([p, 1 - p])).sum() for p in grid])]
    assert share[0, 0] == pytest.approx(best, abs=0.02)


def test_language_edges(edge_docs, no_docs):
    found = language.language_report(edge_docs).collect()
    assert len(found) == edge_docs.count()
    assert {r["lang_pred"] for r in found if r["doc_id"] in (4, 5, 6)} == {"und"}
    assert language.language_report(no_docs).collect() == []


def test_the_driver_does_not_learn_toxicity(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("learnt in the driver")

    rows = [(i, f"{'you vile grumblefrack' if i % 2 else 'a kind neighbour'} said word{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, toxic int")
    monkeypatch.setattr(toxicity, "learn", refuse)
    model = toxicity.trained(docs, labels)
    margins = model.scores_of([b"grumblefrack", b"neighbour"])
    assert model.probability(margins)[0] > 0.5 > model.probability(margins)[1]
    assert toxicity.trained(docs, labels.where("toxic = 1")) is None


def test_threshold_of_all_labelled_rows_is_that_of_one_machine(spark):
    rng = np.random.default_rng(7)
    for kind in ((rng.random(25_000) < 0.9), np.ones(50, bool)):
        scores = np.round(rng.random(len(kind)) * 0.4 + 0.4 * ~kind, 3)
        rows = spark.createDataFrame(list(zip(scores.tolist(), kind.astype(int).tolist())), "anomaly double, quality int")
        assert quality.threshold_of(rows.repartition(6)) == quality.threshold(scores, kind)


def test_trees_draw_from_all_rows(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(quality.Forest, "of", lambda trees, n: drawn.append((len(trees), n)))
    names = [*quality.BASE, *quality.EXTRA]
    rows = spark.range(60_000).select(
        F.col("id").alias("doc_id"), *(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(900)).alias(n) for n in names)
    )
    quality.grown(rows)
    quality.grown(rows.limit(40).repartition(3))
    assert drawn == [(quality.TREES, quality.TREE_ROWS), (quality.TREES, 40)]
