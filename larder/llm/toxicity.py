"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words compares their subsequences of ``LENGTHS`` letters that span at
most a few letters more, each weighted by ``DECAY`` to its span.  An insult with characters put
in, or left out of it, or with another ending still shares most of them.  Words near landmark
words get Nyström features; a document's score is that of its most telling word.

Training rows are labelled documents, each taken as one set of words.  Sentences play no
part in training or scoring, and no subsequence crosses a space: an insult split by spaces, or
made of several words that are harmless alone, is neither learnt nor found.  A linear machine
with squared hinge loss is fitted on the Nyström features: in a toxic document only the most
telling word need be on the toxic side (chosen again in each round), in others no word may be
(the worst ones found are added in each round).  As the machine is linear in the landmarks'
kernels, it comes down to one weight for each subsequence, which scores words without
computing kernels.

* Null and empty texts, and texts without a word of three letters, score near 0.
* Learning uses labelled rows whose crc32(doc_id) mod 5 is not 0, at most ``SAMPLE`` of each
  label, and their whole texts; a doc_id with several labels counts with its largest.
* Without labelled rows of both kinds every score is 0.
* Whole texts are scored; lang, source and doc_id are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.nptext import Chunk, Hasher, chunks, words
from larder.llm.tables import bounded_sample, release_memory

#: Letters of a subsequence and how many more it may span; weight for each letter spanned.
LENGTHS, DECAY = {3: 2, 4: 2, 6: 1}, 0.8
#: Labelled documents of either kind that are learnt from.
SAMPLE = 2_500
LANDMARKS, ROUNDS, STEPS = 240, 4, 30
NEGATIVES, WITNESSES, MARGIN_COST = 15_000, 12, 10.0

_BITS = 5
_PLACES = 1 << 20
_TABLE = _PLACES * len(LENGTHS)
_class = np.zeros(256, np.int64)
for _c in range(26):
    _class[[ord("a") + _c, ord("A") + _c]] = _c + 1
for _c in range(0x80, 0x100):
    _class[_c] = 27 + _c % 5


def _patterns() -> list[tuple[int, ...]]:
    """Offsets of the letters of every subsequence that starts at offset 0."""
    out = []
    for length, slack in LENGTHS.items():
        for inner in range(1, 1 << (length + slack - 1)):
            offsets = (0, *[i + 1 for i in range(length + slack - 1) if inner >> i & 1])
            if len(offsets) == length:
                out.append(offsets)
    return out


_PATTERNS = _patterns()


def _codes(letters: np.ndarray, word: np.ndarray, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(start, table place) of the subsequences of ``offsets`` within words."""
    span = offsets[-1]
    n = len(letters) - span
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fits = word[:n] == word[span:]
    code = np.zeros(n, np.int64)
    for offset in offsets:
        part = letters[offset : offset + n]
        code = (code << _BITS) | part
    starts = np.flatnonzero(fits)
    code = code[starts]
    if len(offsets) > 4:  # more letters than there are places for: hashed
        code = ((code * 0x9E3779B97F4A7C1) >> 24) % _PLACES
    return starts, code + _PLACES * list(LENGTHS).index(len(offsets))


def _letters_only(data: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters without the marks and digits between them, and the word of each."""
    letters = _class[data]
    kept = letters > 0
    return letters[kept], word[kept]


def _laid_out(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(vocabulary), np.uint8)
    return _letters_only(data, np.repeat(np.arange(len(vocabulary)), [len(w) for w in vocabulary]))


def _norms(lengths: np.ndarray) -> np.ndarray:
    """Of a word of so many letters, as if no subsequence occurred in it twice."""
    total = np.zeros(len(lengths))
    for offsets in _PATTERNS:
        span = offsets[-1]
        total += np.maximum(lengths - span, 0) * DECAY ** (2 * (span + 1))
    return np.sqrt(np.maximum(total, DECAY**6))


class Kernel:
    """Kernels of words with the landmarks, from a table of the landmarks' subsequences."""

    def __init__(self, landmarks: list[bytes]):
        letters, word = _laid_out(landmarks)
        places, owners, weights = [], [], []
        for offsets in _PATTERNS:
            starts, code = _codes(letters, word, offsets)
            places.append(code), owners.append(word[starts])
            weights.append(np.full(len(code), DECAY ** (offsets[-1] + 1)))
        places = np.concatenate(places)
        used, row = np.unique(places, return_inverse=True)
        self.row = np.full(_TABLE, len(used), np.int32)
        self.row[used] = np.arange(len(used))
        self.used = used
        self.weight = np.zeros((len(used) + 1, len(landmarks)), np.float32)
        np.add.at(self.weight, (row, np.concatenate(owners)), np.concatenate(weights))
        self.weight /= _norms(np.bincount(word, minlength=len(landmarks)))
        gram = self.of(landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        values = np.maximum(values, 1e-3 * values.max())
        self.whiten = (vectors / np.sqrt(values)) @ vectors.T

    def of(self, vocabulary: list[bytes]) -> np.ndarray:
        """A row for each word, a column for each landmark."""
        out = np.zeros((len(vocabulary), self.weight.shape[1]), np.float32)
        for first in range(0, len(vocabulary), 4096):
            part = vocabulary[first : first + 4096]
            letters, word = _laid_out(part)
            size = np.bincount(word, minlength=len(part))
            for offsets in _PATTERNS:
                starts, code = _codes(letters, word, offsets)
                row = self.row[code]
                known = row < len(self.used)
                np.add.at(
                    out[first : first + 4096],
                    word[starts[known]],
                    self.weight[row[known]] * DECAY ** (offsets[-1] + 1),
                )
            out[first : first + 4096] /= _norms(size)[:, None]
        return out

    def features(self, vocabulary: list[bytes]) -> np.ndarray:
        return self.of(vocabulary) @ self.whiten.astype(np.float32)

    def per_subsequence(self, weights: np.ndarray) -> np.ndarray:
        """The table that scores words as ``features`` times ``weights`` does."""
        table = np.zeros(_TABLE, np.float32)
        combined = self.whiten @ weights
        for first in range(0, len(self.used), 4096):
            places = self.used[first : first + 4096]
            table[places] = self.weight[first : first + len(places)] @ combined
        return table


def _fit_margin(x: np.ndarray, y: np.ndarray, cost: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias, as the last of ``x`` is 1) of least squared hinge loss, by Newton steps on the rows within the margin."""
    penalty = np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6

    def loss(w):
        return w @ penalty @ w + cost @ np.maximum(0, 1 - y * (x @ w)) ** 2

    w, best = start, loss(start)
    for _ in range(STEPS):
        within = y * (x @ w) < 1
        inside = x[within]
        weighted = inside * cost[within, None].astype(x.dtype)
        gram = (weighted.T @ inside).astype(np.float64)
        del inside
        new = np.linalg.solve(penalty + gram, weighted.T @ y[within])
        del weighted
        step, found = 1.0, loss(new)
        while found >= best and step > 1e-3:
            step /= 2
            found = loss(w + step * (new - w))
        if found >= best * (1 - 1e-9):
            break
        w, best = w + step * (new - w), found
    return w


class Model:
    """The weight of each subsequence, the bias, and the slope and offset of the probability."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.slope, self.offset = 2.0, 0.0

    def __getstate__(self) -> dict:
        used = np.flatnonzero(self.table)
        return {**self.__dict__, "table": (used.astype(np.int32), self.table[used], len(self.table))}

    def __setstate__(self, state: dict) -> None:
        used, weights, size = state["table"]
        self.__dict__.update(state, table=np.zeros(size, np.float32))
        self.table[used] = weights

    def word_scores(self, letters: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        total = np.zeros(n)
        for offsets in _PATTERNS:
            starts, code = _codes(letters, word, offsets)
            total += np.bincount(
                word[starts], self.table[code] * DECAY ** (offsets[-1] + 1), minlength=n
            )
        return total / _norms(np.bincount(word, minlength=n)) + self.bias

    def scores_of(self, vocabulary: list[bytes]) -> np.ndarray:
        parts = [np.zeros(0)]
        for first in range(0, len(vocabulary), 4096):
            part = vocabulary[first : first + 4096]
            parts.append(self.word_scores(*_laid_out(part), len(part)))
        return np.concatenate(parts)

    def margins(self, chunk: Chunk) -> np.ndarray:
        """Of each text the largest score of a word; texts without words get -2."""
        out = np.full(len(chunk.bounds) - 1, -2.0)
        starts, ends, firsts = words(chunk)
        if not len(starts):
            return out
        keys = Hasher(chunk.data, fold=True).stretches(starts, ends)
        _, one, which = np.unique(keys, return_index=True, return_inverse=True)
        lengths = (ends - starts)[one]
        word = np.repeat(np.arange(len(one)), lengths)
        source = np.arange(len(word)) + np.repeat(starts[one] - np.cumsum(lengths) + lengths, lengths)
        scores = self.word_scores(*_letters_only(chunk.data[source], word), len(one))
        present = np.flatnonzero(np.diff(firsts))
        out[present] = np.maximum.reduceat(scores[which], firsts[:-1][present])
        return np.maximum(out, -2.0)

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -50, 50)))

    def calibrate(self, margins: np.ndarray, toxic: np.ndarray) -> None:
        """Score 0.5 where the sample's labels are told apart best; the slope follows the spread."""
        order = np.argsort(margins)
        m, t = margins[order], toxic[order]
        wrong = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum(~t[::-1])[::-1], [0]])
        best = np.flatnonzero(wrong == wrong.min())
        at = best[len(best) // 2]
        low = m[at - 1] if at > 0 else m[0] - 1
        high = m[at] if at < len(m) else m[-1] + 1
        self.slope = 4.0
        self.offset = -self.slope * (low + high) / 2


def _sentences(text: bytes) -> list[list[bytes]]:
    """The words of each sentence, in lower case, without marks at their ends."""
    out = []
    for sentence in text.replace(b"\n", b". ").split(b". "):
        found = [w.strip(b".,;:!?()\"'#*$%&|") for w in sentence.lower().split()]
        if found := [w for w in found if len(w) >= 3]:
            out.append(found)
    return out


def learn(texts: list[bytes], toxic: np.ndarray) -> Model | None:
    """A model of the labelled texts; None without both labels."""
    if not toxic.any() or toxic.all():
        return None
    number: dict[bytes, int] = {}
    documents = [
        np.array(sorted({number.setdefault(w, len(number)) for s in _sentences(t) for w in s}), np.int32)
        for t in texts
    ]
    names = list(number)
    counts = {}
    for label in (True, False):
        chosen = [d for d, t in zip(documents, toxic.tolist(), strict=True) if t is label]
        counts[label] = np.bincount(np.concatenate(chosen), minlength=len(names))
    clean = {names[i]: int(counts[False][i]) for i in np.flatnonzero(counts[False])}
    told = counts[True] / (1 + 4 * counts[False])
    odds = {names[i]: float(told[i]) for i in np.flatnonzero(counts[True])}
    telling = sorted(odds, key=lambda w: (-odds[w], w))[: LANDMARKS // 2]
    common = sorted(clean, key=lambda w: (-clean[w], w))[: LANDMARKS // 4]
    # Clean words that look like telling ones are landmarks too, so that the two can be told apart.
    usual = [w for w in sorted(clean) if clean[w] >= 2]
    alike = Kernel(telling[: LANDMARKS // 4]).of(usual).max(1) if usual else np.zeros(0)
    near = [usual[i] for i in np.argsort(-alike, kind="stable")[: LANDMARKS // 4]]
    kernel = Kernel(list(dict.fromkeys(telling + common + near)))

    rng = np.random.default_rng(20240601)
    n_clean = int((~toxic).sum())
    clean_words = sorted(clean, key=lambda w: (-clean[w], w))
    some = rng.choice(len(clean_words), min(NEGATIVES, len(clean_words)), replace=False)
    negatives = [clean_words[i] for i in sorted({*range(min(NEGATIVES // 10, len(clean_words))), *some})]
    bags = []
    for document, label in zip(documents, toxic.tolist(), strict=True):
        if label and len(document):
            words_ = [names[i] for i in document[np.argsort(-told[document], kind="stable")[: 4 * WITNESSES]]]
            bag = sorted(words_, key=lambda w: (-odds[w], w))[:WITNESSES]
            bags.append([w for w in bag if odds[w] >= odds[bag[0]] / 2])
    pool = sorted({w for bag in bags for w in bag})
    place = {w: i for i, w in enumerate(pool)}
    pool_features = kernel.features(pool)
    witness = [bag[0] for bag in bags]
    weights = np.zeros(pool_features.shape[1] + 1)
    negative_features = kernel.features(negatives)
    for _ in range(ROUNDS):
        chosen, times = np.unique([place[w] for w in witness], return_counts=True)
        x = np.ones((len(chosen) + len(negatives), len(weights)), np.float32)
        x[: len(chosen), :-1] = pool_features[chosen]
        x[len(chosen) :, :-1] = negative_features
        y = np.concatenate([np.ones(len(chosen)), -np.ones(len(negatives))])
        # A word counts by the documents that it speaks for, both kinds of documents alike.
        spoken = np.array([clean[w] for w in negatives]) * (len(bags) / n_clean)
        cost = MARGIN_COST * np.concatenate([times, spoken])
        weights = _fit_margin(x, y, cost, weights)
        del x
        scores = pool_features @ weights[:-1]
        witness = [max(bag, key=lambda w: (scores[place[w]], w)) for bag in bags]
        model = Model(kernel.per_subsequence(weights[:-1]), float(weights[-1]))
        worst = np.argsort(-model.scores_of(clean_words))[: NEGATIVES // 10]
        fresh = sorted({clean_words[i] for i in worst} - set(negatives))
        if fresh:
            negatives += fresh
            negative_features = np.concatenate([negative_features, kernel.features(fresh)])
    # Small chunks: several numbers are held for each byte of one.
    parts = chunks(pa.array(texts, pa.binary()), 1 << 18)
    margins = np.concatenate([model.margins(c) for c in parts])
    model.calibrate(margins, toxic)
    return model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def trained(docs: DataFrame, labels: DataFrame) -> Model | None:
    marked = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.filter(~held_out())
    chosen = None
    for label in (0, 1):  # chosen by id first, so that only the chosen texts are moved
        some = marked.filter(F.col("toxic") == label)
        some = bounded_sample(some, ["doc_id"], SAMPLE, some.count())
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = (
        docs.filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")  # 2 * SAMPLE ids at most
        .groupBy("doc_id", "toxic")  # rows that repeat an id are learnt once, by their smallest text
        .agg(F.min(F.encode("text", "utf-8")).alias("raw"))
    )
    # One task learns from the chosen rows, so that the driver sees the model alone.
    found = rows.repartition(1).mapInArrow(_learnt, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of rows (doc_id, toxic, raw), if there is one."""
    rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
    rows.sort(key=lambda row: row[0])
    texts, toxic = [row[2] for row in rows], np.array([row[1] == 1 for row in rows], bool)
    del rows
    model = learn(texts, toxic)
    del texts
    if model is not None:
        packed = pickle.dumps(model)
        del model
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["model"])
    release_memory()  # the worker stays alive for later stages


def toxicity(model: Model | None) -> Column:
    """The score of the column ``text``."""

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [np.zeros(0)]
            for chunk in chunks(texts):
                n = len(chunk.bounds) - 1
                parts.append(model.probability(model.margins(chunk)) if model else np.zeros(n))
            yield pa.array(np.concatenate(parts))

    return score(F.col("text"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", toxicity(trained(docs, labels)).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that score 0.5 or more; all columns as they are."""
    return docs.filter(toxicity(trained(docs, labels)) < 0.5)
