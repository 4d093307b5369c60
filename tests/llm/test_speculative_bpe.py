"""Speculative BPE against the tokenizers library, and against toy merges with many ties."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import speculative_bpe
from larder.llm.queries import TOKENIZER

sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def ours():
    return speculative_bpe.Merges(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def check(ours, library, texts):
    for text, (ids, decimals) in zip(texts, ours.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text[:200]
        assert decimals == ",".join(map(str, expected)).encode()
        assert ours.decode(ids) == library.decode(expected, skip_special_tokens=False) == text


def test_every_code_point(ours, library):
    points = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x110000)) if c < 0x3100 or c % 37 == 0]
    check(ours, library, [f"a{c} {c}1{c}{c} !{c}  x" for c in points])


def test_odd_texts(ours, library):
    texts = ["", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endof", "  a  \n\n b\t\t", "'re we'Re 'll"]
    texts += [unit * 4000 for unit in ("a", "-", " ", "ab", "é", "0", "日本")] + ["\x00\x1c\x85 ﻿"]
    check(ours, library, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(ours, library, texts):
    check(ours, library, texts)


@pytest.mark.parametrize("seed", range(30))
def test_toy_merges(seed, tmp_path, ours):
    """Merges that overlap, tie and make tokens that merging never reaches."""
    draw = random.Random(seed)
    letters = "abc"[: draw.choice([1, 2, 3])]
    with open(TOKENIZER, encoding="utf-8") as file:
        spec = json.load(file)
    ids = {c: i for i, c in enumerate(speculative_bpe._byte_characters())}
    tokens, merges = list(letters), []
    for _ in range(draw.randrange(1, 25)):
        left, right = draw.choice(tokens), draw.choice(tokens)
        if left + right not in ids and len(left + right) <= 12:
            ids[left + right] = len(ids)
            merges.append([left, right])
            tokens.append(left + right)
    spec["model"] |= {"vocab": ids, "merges": merges}
    spec["added_tokens"] = []
    path = str(tmp_path / "toy.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(150)]
    check(speculative_bpe.Merges(path), Tokenizer.from_file(path), texts)


def test_failing_words_are_merged(ours):
    words = [b" onheretionshon", b" the", b"athawh"]
    ids, stands = ours.speculate(words)
    for word, proposed, fine in zip(words, ids, stands, strict=True):
        assert (proposed.tolist() == ours.merge(word)) == fine
    assert set(stands.tolist()) == {True, False}


def test_report_and_round_trip(edge_docs, no_docs, library):
    rows = Counter((r.doc_id, r.text) for r in edge_docs.collect())
    expected = Counter()
    for (doc_id, text), n in rows.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected[doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(back.encode())] += n
    got = speculative_bpe.encoding_report(edge_docs, TOKENIZER)
    assert Counter(map(tuple, got.collect())) == expected
    assert speculative_bpe.encoding_report(no_docs, TOKENIZER).collect() == []
    back = edge_docs.withColumn("ids", speculative_bpe.token_ids(TOKENIZER)).withColumn(
        "back", speculative_bpe.decoded_text("ids", TOKENIZER)
    )
    assert all((r.text or "") == r.back for r in back.collect())


def test_other_kinds_of_file_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        speculative_bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))


def test_words_merged_together_are_merged_as_one_by_one(ours):
    rng = random.Random(5)
    words = [bytes(rng.choice(b"aeinrst \xc3\xa9") for _ in range(rng.randint(1, 64))) for _ in range(2_000)]
    words += [b"a" * n for n in (1, 2, 3, 7, 64)]
    ids, bounds = ours.merge_all(words)
    for word, first, last in zip(words, bounds, bounds[1:]):
        assert ids[first:last].tolist() == ours.merge(word)
    assert [len(part) for part in ours.merge_all([])] == [0, 1]
