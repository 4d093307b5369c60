"""BPE encoding and decoding by a tokenizer file: speculate on longest matches, then verify.

Text is cut at added tokens, then into words by the byte-level pattern.  For all words of a
group of texts that are new to the worker, the longest token at each place proposes a
sequence.  A sequence is the one that the merges give if no merge bridges any two of its
neighbours, so all distinct pairs of neighbours are checked at once; a word with a failing
pair is merged step by step instead, lowest rank first and leftmost among equals.

A pair is checked by going back in time: the token formed later is undone, until a merge is
found that would have joined the two sides earlier, or single bytes are left.

* The file must hold a byte-level BPE without normaliser, dropout or unknown token; added
  tokens in a text become their ids.  Anything else raises ``ValueError``.
* Null and empty texts have no ids; their digests are those of nothing.
* Any length of text and of word is encoded whole; repeated rows give repeated results, an
  empty table none.  Extra columns are not looked at.
* The cache of words (``WORDS`` of at most ``CACHED`` characters in each of two generations) and
  the grouping of texts affect speed only.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.tables import ship_package

#: Words in each generation of the cache, longest word cached, characters encoded together.
WORDS, CACHED, GROUP = 120_000, 64, 1 << 20
#: Bytes of the longest word that is merged together with others.
SHORT = 64
_NEVER = 1 << 40

#: Fixed value: how byte-level tokenizers cut text into words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a token file: itself if it is visible."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


@functools.cache
def _unknown_letters() -> re.Pattern:
    """Letters and digits newer than the Unicode version of Python, which tokenizers do not know.

    They are cut as symbols are.  Python's own engine finds them ten times as fast.
    """
    every = "".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))))
    new = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    firsts = [c for c, last in zip(new, [-1, *new]) if c != last + 1]
    lasts = [c for c, first in zip(new, [*new[1:], -1]) if first != c + 1]
    ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts))
    return re.compile(f"[{ranges}]" if ranges else r"(?!)")


class Merges:
    """The tokens and merges of a tokenizer file and what encoding needs to know of them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and before["type"] == "ByteLevel" and before.get("use_regex")
        odd = [model.get("dropout"), spec["normalizer"], before.get("add_prefix_space"), model.get("byte_fallback")]
        odd += [model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        added = spec["added_tokens"]
        odd += [t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")]
        if not plain or any(odd):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        raw = {c: b for b, c in enumerate(_byte_characters())}
        ids = model["vocab"]
        self._bytes = {i: bytes(raw[c] for c in token) for token, i in ids.items()}
        self._bytes |= {t["id"]: t["content"].encode() for t in added}
        self._added = {t["content"]: t["id"] for t in added}
        contents = sorted(self._added, key=len, reverse=True)
        self._find_added = regex.compile("|".join(map(regex.escape, contents)) if contents else r"(?!)")
        self._find_words = regex.compile(_PATTERN)
        self._unknown = _unknown_letters()
        self._byte_ids = [ids[c] for c in _byte_characters()]

        self._size = max(self._bytes) + 1
        self._made = np.full(self._size, -1)
        self._left, self._right = np.full(self._size, -1), np.full(self._size, -1)
        self._joined: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made, parts = ids[left + right], (ids[left], ids[right])
            pair = parts[0] * self._size + parts[1]
            if self._made[made] >= 0 or any(len(self._bytes[p]) > 1 and self._made[p] < 0 for p in parts):
                raise ValueError(f"{path} merges a token twice or before its parts")
            self._joined[pair] = (rank, made)
            self._made[made], self._left[made], self._right[made] = rank, *parts
        pairs = sorted(self._joined)
        self._pairs = np.array([*pairs, np.iinfo(np.int64).max])
        self._ranks = np.array([*(self._joined[p][0] for p in pairs), _NEVER])
        self._results = np.array([*(self._joined[p][1] for p in pairs), -1])
        self._decimals = [str(i).encode() for i in range(self._size)]

        merged = np.flatnonzero(self._made >= 0)
        merged = merged[np.argsort(self._made[merged])]
        whole = self.unbridged(self._left[merged], self._right[merged], joining=True)
        reached = set(self._byte_ids)
        rows = np.column_stack([merged, self._left[merged], self._right[merged]])[whole]
        for token, left, right in rows.tolist():
            if left in reached and right in reached:
                reached.add(token)
        self._plant(sorted(reached))
        lengths = [len(self._bytes.get(i, b"")) for i in range(self._size)]
        self._lengths = np.array(lengths)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._all_bytes = np.frombuffer(b"".join(self._bytes.get(i, b"") for i in range(self._size)), np.uint8)
        self._young: dict[str, tuple[bytes, bytes]] = {}
        self._old: dict[str, tuple[bytes, bytes]] = {}

    def _plant(self, tokens: list[int]) -> None:
        """A trie of the tokens that merging their own bytes can give, as sorted edges."""
        nodes, ends = {b"": 0}, {}
        for token in tokens:
            text = self._bytes[token]
            for end in range(1, len(text) + 1):
                nodes.setdefault(text[:end], len(nodes))
            ends[nodes[text]] = token
        edges = sorted((nodes[text[:-1]] * 256 + text[-1], node) for text, node in nodes.items() if node)
        self._edges = np.array([*(key for key, _ in edges), np.iinfo(np.int64).max])
        self._below = np.array([*(node for _, node in edges), 0])
        self._token_at = np.full(len(nodes), -1)
        self._token_at[list(ends)] = list(ends.values())

    def unbridged(self, x: np.ndarray, y: np.ndarray, joining: bool = False) -> np.ndarray:
        """Whether no merge bridges the boundary between tokens ``x`` and ``y``, for each pair.

        ``x`` and ``y`` end at the ranks of the merges that take them away from the boundary.
        With ``joining`` the merge of the two themselves does not count: is it reached?
        """
        fine = np.ones(len(x), bool)
        alive = np.arange(len(x))
        x_ends, y_ends = np.full(len(x), _NEVER), np.full(len(x), _NEVER)
        while len(alive):
            pairs = x * self._size + y
            at = np.searchsorted(self._pairs, pairs)
            bridge = np.where(self._pairs[at] == pairs, self._ranks[at], _NEVER)
            cut = (bridge < x_ends) & (bridge <= y_ends) & (not joining)
            joining = False
            fine[alive[cut]] = False
            x_made, y_made = self._made[x], self._made[y]
            go = ~cut & ((x_made >= 0) | (y_made >= 0))
            alive, x, y, x_made, y_made = alive[go], x[go], y[go], x_made[go], y_made[go]
            undo = x_made > y_made
            x_ends, y_ends = np.where(undo, x_made, x_ends[go]), np.where(undo, y_ends[go], y_made)
            x, y = np.where(undo, self._right[x], x), np.where(undo, y, self._left[y])
        return fine

    def _longest(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and id of the longest token at each place of ``data``, of at most ``room`` bytes."""
        length, token = np.zeros(len(data), np.int64), np.full(len(data), -1)
        at, node, depth = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(at):
            keys = node * 256 + data[at + depth]
            edge = np.searchsorted(self._edges, keys)
            hit = self._edges[edge] == keys
            depth += 1
            at, node = at[hit], self._below[edge[hit]]
            found = self._token_at[node]
            ends = found >= 0
            length[at[ends]], token[at[ends]] = depth, found[ends]
            more = room[at] > depth
            at, node = at[more], node[more]
        return length, token

    def merge(self, word: bytes) -> list[int]:
        """The ids of ``word`` by its merges one by one: the lowest rank first, then the leftmost."""
        ids = [self._byte_ids[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids):
                rank, _ = self._joined.get(ids[at] * self._size + ids[after[at]], (None, None))
                if rank is not None:
                    heapq.heappush(heap, (rank, at))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            rank, at = heapq.heappop(heap)
            if ids[at] < 0 or after[at] >= len(ids):
                continue
            other = after[at]
            now, made = self._joined.get(ids[at] * self._size + ids[other], (None, None))
            if now != rank:
                continue
            ids[at], ids[other] = made, -1
            after[at] = after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words`` one after another and the first place of each word, one more at the end.

        Each round joins one pair in every word that still has one: that of lowest rank, the
        leftmost among equals.  The rounds are as many as the merges of a word, so words should
        be short.
        """
        byte_ids = np.array(self._byte_ids)
        ids = byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done_ids, done_words = [], []
        found = self._pair_at(ids[:-1], ids[1:], word[:-1] == word[1:])
        while len(ids):
            # The pair of a place is that with the next place; the last one of a word has none.
            at = np.append(found, len(self._pairs) - 1)
            rank = self._ranks[at]
            firsts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.append(firsts, len(ids)))
            going = np.repeat(least < _NEVER, sizes)
            done_ids.append(ids[~going]), done_words.append(word[~going])
            lowest = np.flatnonzero(going & (rank == np.repeat(least, sizes)))
            lowest = lowest[np.append(True, word[lowest[1:]] != word[lowest[:-1]])[: len(lowest)]]
            ids[lowest] = self._results[at[lowest]]
            kept = going.copy()
            kept[lowest + 1] = False
            place = (np.cumsum(kept) - 1)[lowest]
            ids, word, at = ids[kept], word[kept], at[kept]
            near = np.concatenate([place, place[place > 0] - 1])
            near = near[near < len(ids) - 1]
            at[near] = self._pair_at(ids[near], ids[near + 1], word[near] == word[near + 1])
            at[place[place == len(ids) - 1]] = len(self._pairs) - 1
            found = at[:-1]
        all_words = np.concatenate([*done_words, np.zeros(0, np.int64)])
        order = np.argsort(all_words, kind="stable")
        bounds = np.searchsorted(all_words[order], np.arange(len(words) + 1))
        return np.concatenate([*done_ids, np.zeros(0, np.int64)])[order], bounds

    def _pair_at(self, left: np.ndarray, right: np.ndarray, together: np.ndarray) -> np.ndarray:
        """Where each pair is in the list of merges; the last entry, of no rank, where it is no merge."""
        pairs = left * self._size + right
        at = np.searchsorted(self._pairs, pairs)
        return np.where(together & (self._pairs[at] == pairs), at, len(self._pairs) - 1)

    def speculate(self, words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """The proposed ids of each word, and whether they stand."""
        tokens, bounds, stands = self._propose(words)
        return np.split(tokens, bounds[1:-1]), stands

    def _propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The proposed ids one after another, the first place of each word and one more, and whether they stand."""
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        sizes = np.array([len(w) for w in words])
        word_ends = np.cumsum(sizes)
        word_at = np.repeat(np.arange(len(words)), sizes)
        length, token = self._longest(data, word_ends[word_at] - np.arange(len(data)))
        steps, starts, at = length.tolist(), [], 0
        while at < len(steps):
            starts.append(at)
            at += steps[at]
        starts = np.array(starts, np.int64)
        tokens, words_of = token[starts], word_at[starts]
        inside = words_of[1:] == words_of[:-1]
        pairs, which = np.unique((tokens[:-1] * self._size + tokens[1:])[inside], return_inverse=True)
        fine = self.unbridged(pairs // self._size, pairs % self._size)
        stands = np.ones(len(words), bool)
        stands[words_of[1:][inside][~fine[which]]] = False
        return tokens, np.searchsorted(words_of, np.arange(len(words) + 1)), stands

    def _learn(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of ``words`` as little-endian 32-bit integers and as decimals with commas."""
        if not words:
            return {}
        raw = [w.encode("utf-8") for w in words]
        tokens, bounds, stands = self._propose(raw)
        found = self._forms(words, tokens, bounds)
        fallen = np.flatnonzero(~stands).tolist()
        short = [i for i in fallen if len(raw[i]) <= SHORT]
        found.update(self._forms([words[i] for i in short], *self.merge_all([raw[i] for i in short])))
        for i in fallen:
            if len(raw[i]) > SHORT:
                ids = np.array(self.merge(raw[i]))
                found.update(self._forms([words[i]], ids, np.array([0, len(ids)])))
        return found

    def _forms(self, words: list[str], ids: np.ndarray, bounds: np.ndarray) -> dict[str, tuple[bytes, bytes]]:
        """Both forms of the ids of each word, which lie between its bounds."""
        raw = ids.astype("<u4").tobytes()
        decimals = [self._decimals[i] for i in ids.tolist()]
        ends = bounds.tolist()
        return {
            word: (raw[4 * first : 4 * last], b",".join(decimals[first:last]))
            for word, first, last in zip(words, ends, ends[1:], strict=False)
        }

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not self._unknown.search(text):
            return self._find_words.findall(text)
        as_symbols = self._unknown.sub("", text)
        return [text[slice(*m.span())] for m in self._find_words.finditer(as_symbols)]

    def _parts(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """(whether these are added tokens, words) of ``text`` in order."""
        at = 0
        for match in self._find_added.finditer(text):
            yield False, self._words(text[at : match.start()])
            yield True, [match[0]]
            at = match.end()
        yield False, self._words(text[at:])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        """For each text its ids, and these as decimals with commas; new words go together."""
        parts = [list(self._parts(text)) for text in texts]
        young, old = self._young, self._old
        added = {w: (np.array([i], "<u4").tobytes(), str(i).encode()) for w, i in self._added.items()}
        new, here = {}, {}
        for is_added, words in (part for text in parts for part in text):
            for word in () if is_added else set(words).difference(young):
                if word not in here:
                    if word in old:
                        here[word] = old[word]
                    else:
                        new[word] = None
        here |= self._learn(list(new))
        for text in parts:
            found = []
            for is_added, words in text:
                found += [added[w] for w in words] if is_added else [young.get(w) or here[w] for w in words]
            yield np.frombuffer(b"".join([f[0] for f in found]), "<u4"), b",".join([f[1] for f in found])
        for word, ids in here.items():
            if len(word) <= CACHED:
                if len(self._young) >= WORDS:
                    self._old, self._young = self._young, {}
                self._young[word] = ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become the replacement character."""
        ids = ids.astype(np.int64)
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self._starts[ids] - (ends - lengths), lengths) + np.arange(total)
        return self._all_bytes[source].tobytes().decode("utf-8", "replace")


_loaded: dict[str, Merges] = {}


def merges(path: str) -> Merges:
    """One per Python worker; ``path`` is read there, from its own disk or by SparkFiles' name."""
    if path not in _loaded:
        try:
            _loaded[path] = Merges(path)
        except FileNotFoundError:
            _loaded[path] = Merges(SparkFiles.get(path.rsplit("/", 1)[-1]))
    return _loaded[path]


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoded(path: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of the column ``text``."""

    @arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = merges(path)
        for texts in batches:
            counts, sums, back = [], [], []
            for group in _groups(texts):
                for ids, decimals in tokens.encode(group):
                    counts.append(len(ids))
                    sums.append(hashlib.sha256(decimals).hexdigest())
                    back.append(hashlib.sha256(tokens.decode(ids).encode("utf-8")).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest(F.col("text"))


def token_ids(path: str) -> Column:
    """The ids of the column ``text`` as array<int>."""

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = merges(path)
        for texts in batches:
            found = [i.astype(np.int32) for group in _groups(texts) for i, _ in tokens.encode(group)]
            yield pa.array(found, pa.list_(pa.int32()))

    return ids(F.col("text"))


def decoded_text(ids: str, path: str) -> Column:
    """The text of a column of ids."""

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = merges(path)
        for lists in batches:
            found = [tokens.decode(np.array(x.as_py() or [], np.int64)) for x in lists]
            yield pa.array(found, pa.string())

    return text(F.col(ids))


def encoding_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", encoded(path).alias("e")).select("doc_id", "e.*")
