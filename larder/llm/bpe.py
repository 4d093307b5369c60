"""Byte-level BPE encoding by longest matches, backtracking and adjacent-token compatibility.

Two adjacent tokens are compatible when applying the merges to their joined bytes yields
just the two of them.  A token sequence in which all neighbours are compatible is the
sequence that the merges give, and it is unique.  So an encoder may take the longest token
at each place and fall back to shorter ones, or to the token before, where two neighbours
are not compatible; every place is given up at most once, so the time is linear in the
piece.  Compatibility is memoised by token pair.

Longest matches come from an Aho-Corasick automaton over the vocabulary, with every byte
as the Latin-1 character of its value.  Text is cut by the tokenizer's pattern first; a piece
that is a token itself is that token.  Special tokens' strings are ordinary text.

* Null and empty texts have no ids; their digests are those of no bytes.
* Any length of text and of piece is encoded whole; repeated rows give repeated results.
* The caches hold ``PIECES`` pieces and ``PAIRS`` pairs at most for each Python worker;
  they affect speed only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Entries in each of the two generations of the piece cache, longest cached piece, pairs.
PIECES, CACHED_BYTES, PAIRS = 120_000, 64, 300_000
_NEVER = 1 << 40


class Vocabulary:
    """The tokens of a rank file and what encoding needs to know of them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._find_pieces = regex.compile(pattern).findall
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._merged: dict[tuple[int, int], int] = {}
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._memo: dict[int, bool] = {}
        for rank in sorted(self._bytes):
            self._find_parts(rank)
        size = max(self._bytes) + 1
        self._shorter = [self._longest_proper_prefix(self._bytes.get(i, b"")) for i in range(size)]
        self._sizes = [len(self._bytes.get(i, b"")) for i in range(size)]
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self._automaton.make_automaton()
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._lengths = np.array(self._sizes)
        self._starts = np.cumsum(self._lengths) - self._lengths
        joined = b"".join(self._bytes.get(i, b"") for i in range(size))
        self._joined = np.frombuffer(joined, np.uint8)

    def _longest_proper_prefix(self, token: bytes) -> int:
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in self._ranks:
                return self._ranks[token[:end]]
        return -1

    def _find_parts(self, rank: int) -> None:
        """The two tokens whose merge makes this one; single bytes have none."""
        token = self._bytes[rank]
        for cut in range(1, len(token)):
            left, right = self._ranks.get(token[:cut]), self._ranks.get(token[cut:])
            if left is None or right is None or left >= rank or right >= rank:
                continue
            if self._unmerged(left, right):
                self._left[rank], self._right[rank] = left, right
                self._merged[left, right] = rank
                return

    def _unmerged(self, x: int, y: int) -> bool:
        """Whether no merge bridges the boundary between the tokens ``x`` and ``y``.

        Goes back in time: the token formed later is undone first, down to single bytes.
        ``x`` ends when the merge ``x_ends`` takes it into the token on its left, ``y``
        likewise.  A bridge of equal rank comes after one on its left, before one on its right.
        """
        x_ends = y_ends = _NEVER
        while True:
            bridge = self._merged.get((x, y), _NEVER)
            if bridge < x_ends and bridge <= y_ends and bridge != _NEVER:
                return False
            formed_x = x if x in self._right else -1
            formed_y = y if y in self._left else -1
            if formed_x < 0 and formed_y < 0:
                return True
            if formed_x > formed_y:
                x_ends, x = x, self._right[x]
            else:
                y_ends, y = y, self._left[y]

    def _encode_bytes(self, piece: bytes) -> list[int]:
        if piece in self._ranks:
            return [self._ranks[piece]]
        size = len(piece)
        longest = [-1] * size
        for end, (rank, length) in self._automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length] = rank
        sizes, shorter, memo = self._sizes, self._shorter, self._memo
        if len(memo) >= PAIRS:
            memo.clear()
        given_up = bytearray(size + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < size:
            while token >= 0:
                end = at + sizes[token]
                if not given_up[end]:
                    if last < 0:
                        break
                    pair = last << 32 | token
                    fits = memo.get(pair)
                    if fits is None:
                        fits = memo[pair] = self._unmerged(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < size else -1
            else:
                given_up[at] = 1
                gone = out.pop()
                at -= sizes[gone]
                last = out[-1] if out else -1
                token = shorter[gone]
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` as unsigned 32-bit integers."""
        young, old = self._young, self._old
        parts = []
        for piece in self._find_pieces(text):
            ids = young.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    raw = piece.encode("utf-8")
                    ids = np.array(self._encode_bytes(raw), "<u4").tobytes()
                if len(piece) <= CACHED_BYTES:
                    if len(young) >= PIECES:
                        self._old, self._young = young, {}
                        young, old = self._young, self._old
                    young[piece] = ids
            parts.append(ids)
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens ``ids``."""
        ids = ids.astype(np.int64)
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self._starts[ids] - (ends - lengths), lengths) + np.arange(total)
        return self._joined[source].tobytes()


_loaded: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per Python worker; ``path`` is read there, from its own disk or by SparkFiles' name."""
    key = (path, pattern)
    if key not in _loaded:
        try:
            _loaded[key] = Vocabulary(path, pattern)
        except FileNotFoundError:
            _loaded[key] = Vocabulary(SparkFiles.get(path.rsplit("/", 1)[-1]), pattern)
    return _loaded[key]


def encoded(path: str, pattern: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of the column ``text``."""

    @arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path, pattern)
        for texts in batches:
            counts, sums, back = [], [], []
            for text in texts:
                ids = tokens.encode(text.as_py() or "")
                counts.append(len(ids))
                sums.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(tokens.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest(F.col("text"))


def token_ids(path: str, pattern: str) -> Column:
    """The ids of the column ``text`` as array<int>."""

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path, pattern)
        for texts in batches:
            found = [tokens.encode(text.as_py() or "").astype(np.int32) for text in texts]
            yield pa.array(found, pa.list_(pa.int32()))

    return ids(F.col("text"))


def decoded_text(ids: str, path: str, pattern: str) -> Column:
    """The text of a column of ids; bytes that are no UTF-8 become the replacement character."""

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary(path, pattern)
        for lists in batches:
            found = [np.array(x.as_py() or [], np.int64) for x in lists]
            yield pa.array([tokens.decode(x).decode("utf-8", "replace") for x in found], pa.string())

    return text(F.col(ids))


def encoding_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return docs.select("doc_id", encoded(path, pattern).alias("e")).select("doc_id", "e.*")
