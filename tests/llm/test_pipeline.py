"""The pipeline's stages one by one against brute force, over the smallest tables."""

import base64
import hashlib
import re
from collections import Counter
from itertools import combinations

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from larder.llm import mixing, toxicity
from larder.llm.queries import RANKS
from larder.llm.tables import read_table, stored

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into the first stage and what comes out of each."""
    docs = read_table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near dedup", "mixing", "encoding",
    ]
    assert all(df.schema.names == stages[0].schema.names for df in stages[:-1])


def test_toxicity_drops_what_it_rejects(spark, stages):
    report = toxicity.toxicity_report(stages[0], read_table(spark, SF, "labels"))
    clean = {r.doc_id for r in report.collect() if r.predicted == 0}
    assert set(rows(stages[1])) == clean
    # Only labelled rows are known to be clean; the others may be toxic.
    known = {r.doc_id for r in read_table(spark, SF, "labels").collect() if r.toxic == 0}
    dropped = set(rows(stages[0])) - clean
    assert len(dropped & known) <= 0.02 * len(known)


def test_line_dedup_deletes_later_runs(stages):
    before, after = rows(stages[1]), rows(stages[2])
    seen = set()
    for doc_id in sorted(before):
        lines = before[doc_id].text.split("\n")
        worded = [i for i, line in enumerate(lines) if WORD.search(line)]
        gone = set()
        for at in range(len(worded)):
            for size in (1, 2, 3):
                places = worded[at : at + size]
                run = tuple(lines[i] for i in places)
                wordy = len(WORD.findall("\n".join(run))) > 50
                if len(run) < size or (size < 3 and not wordy):
                    continue
                if run in seen:
                    gone |= set(places)
                seen.add(run)
        text = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        if gone and not WORD.search(text):
            assert doc_id not in after
        else:
            assert (after[doc_id].text, after[doc_id].n_chars) == (text, len(text))


def test_near_dedup_keeps_one_of_each_group(stages):
    before = rows(stages[2])
    sets = {}
    for doc_id, row in before.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), row.text or ""))
        whole = [tuple(words)] if words else []
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or set(whole)
    group = {d: d for d in sets}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            group[high] = low
    assert set(rows(stages[3])) == {d for d in sets if top(d) == d}


def test_mixing_repeats_rows_as_its_report_says(stages):
    report = {r.doc_id: r for r in mixing.mix_report(stages[3]).collect()}
    times = Counter(r.doc_id for r in stages[4].collect())
    assert all(times[d] * r["size"] == r["taken"] for d, r in report.items())
    assert set(times) <= set(report)


def test_encoding_matches_the_library(stages):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = Counter()
    for r in stages[4].collect():
        ids = encoder.encode_ordinary(r.text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        text = hashlib.sha256((r.text or "").encode()).hexdigest()
        expected[r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), text] += 1
    found = Counter(
        (r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[5].collect()
    )
    assert found == expected


def test_run_returns_the_last_stage(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(stages[5].collect())
