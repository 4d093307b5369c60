"""Language identification by a mixture over each document's passages.

Byte n-gram models are trained per language on the whole texts of all labelled documents that
are not held out; their n-grams are counted in tasks, and only sums go to the driver.  A
document is cut into passages of ``PASSAGE`` words; each has a likelihood under each language.
Expectation-maximisation estimates the proportions of the languages in the document.  The
set of languages is selected by penalised likelihood: from the single best language on,
the language that adds most is admitted while it adds more than ``PENALTY`` per parameter and
per log of the number of passages (twice that is the Bayesian criterion).  The prediction
is the language of largest proportion, and its proportion is the score.

* Null texts and texts without a letter are ``und`` with score 0.
* Ties go to the language that sorts first.  Whole texts are read.
* Without any labelled row all texts are ``und``.
* Learning uses documents with a language whose crc32(doc_id) mod 5 is not 0; a null doc_id
  is held out.  A language whose learning documents are all empty is not learnt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.nptext import Chunk, chunks, text_of, words

PASSAGE, ROUNDS, SMOOTHING = 8, 12, 0.5
PENALTY = 3.0
#: Bits of the n-gram code: 3 bytes of 6 bits.
_BITS = 6
_GRAMS = 1 << (3 * _BITS)
#: n-grams that a task holds before it sums them.
_HELD = 1 << 21

_class = np.zeros(256, np.int64)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalpha():
        _class[_c] = ord(chr(_c).lower()) - ord("a") + 1
    elif _c >= 0x80:
        _class[_c] = 27 + _c % 36
_letter = regex.compile(r"\p{L}")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def gram_codes(data: np.ndarray) -> np.ndarray:
    """For every byte the code of it and the two before; other bytes than letters are class 0."""
    c = _class[data]
    code = c.copy()
    code[1:] += c[:-1] << _BITS
    code[2:] += c[:-2] << (2 * _BITS)
    return code


class Models:
    """Log probabilities of n-grams given their first two bytes, a column for each language."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``grams`` has the codes that occur in each language and their counts."""
        self.languages = sorted(grams)
        table = np.empty((_GRAMS, len(self.languages)), np.float32)
        for i, language in enumerate(self.languages):
            counts = np.zeros(_GRAMS)
            codes, times = grams[language]
            counts[codes] = times
            counts = counts.reshape(1 << (2 * _BITS), 1 << _BITS)
            before = counts.sum(1, keepdims=True)
            last = (counts.sum(0) + SMOOTHING) / (counts.sum() + SMOOTHING * (1 << _BITS))
            table[:, i] = np.log((counts + 4 * last) / (before + 4)).ravel()
        self.table = table

    def passages(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihoods of the chunk's passages, and the first passage of each text."""
        starts, ends, firsts = words(chunk)
        n_words = np.diff(firsts)
        per_text = -(-n_words // PASSAGE)
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        within = np.arange(bounds[-1]) - bounds[:-1][text_of(bounds)]
        first_word = firsts[:-1][text_of(bounds)] + within * PASSAGE
        if not len(first_word):
            return np.zeros((0, len(self.languages))), bounds
        last_word = np.minimum(first_word + PASSAGE, firsts[1:][text_of(bounds)]) - 1
        codes = gram_codes(chunk.data)
        low, high = starts[first_word], ends[last_word]
        out = np.empty((len(low), len(self.languages)))
        for i in range(len(self.languages)):
            total = np.zeros(len(codes) + 1)
            np.cumsum(self.table[:, i][codes], out=total[1:])
            out[:, i] = total[high] - total[low]
        return out, bounds


def _mixture(likelihood: np.ndarray, text: np.ndarray, n: int, allowed: np.ndarray):
    """Proportions and log likelihood of every text among its ``allowed`` languages."""
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    counts = np.maximum(np.bincount(text, minlength=n), 1)[:, None]
    for _ in range(ROUNDS):
        weighted = likelihood * share[text]
        mass = np.maximum(weighted.sum(1, keepdims=True), 1e-300)
        weighted /= mass
        share = np.stack(
            [np.bincount(text, weighted[:, i], minlength=n) for i in range(share.shape[1])], 1
        ) / counts
    mass = np.maximum((likelihood * share[text]).sum(1), 1e-300)
    return share, np.bincount(text, np.log(mass), minlength=n)


def proportions(loglik: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The proportions of the selected languages in each text; 0 for languages left out."""
    n, k = len(bounds) - 1, loglik.shape[1]
    result = np.zeros((n, k))
    sizes = np.diff(bounds)
    if not len(loglik) or not k:
        return result
    text = text_of(bounds)
    totals = np.stack([np.bincount(text, loglik[:, i], minlength=n) for i in range(k)], 1)
    single = totals.argmax(1)
    result[np.arange(n), single] = sizes > 0
    # Texts of which some passage prefers another language may be mixed.
    best = loglik.max(1)
    gain = np.bincount(text, best - loglik[np.arange(len(text)), single[text]], minlength=n)
    price = PENALTY * np.log(np.maximum(sizes, 2))
    mixed_ = np.flatnonzero((gain > price) & (sizes > 1))
    if not len(mixed_):
        return result
    new = np.full(n, -1)
    new[mixed_] = np.arange(len(mixed_))
    rows = np.flatnonzero(new[text] >= 0)
    sub, likelihood = new[text[rows]], np.exp(np.maximum(loglik[rows] - best[rows, None], -700))
    base = np.bincount(sub, best[rows], minlength=len(mixed_))
    allowed = np.zeros((len(mixed_), k), bool)
    allowed[np.arange(len(mixed_)), single[mixed_]] = True
    share, fit = result[mixed_], totals[mixed_, single[mixed_]] - base
    active = np.ones(len(mixed_), bool)
    for _ in range(k - 1):
        # The language that would explain most of what the set explains badly.
        now = np.maximum((likelihood * share[sub]).sum(1), 1e-300)
        worth = np.stack(
            [
                np.bincount(sub, np.log(np.maximum(likelihood[:, i] / now, 1)), minlength=len(mixed_))
                for i in range(k)
            ],
            1,
        )
        worth[allowed] = -1
        candidate = worth.argmax(1)
        active &= worth[np.arange(len(mixed_)), candidate] > price[mixed_]
        if not active.any():
            break
        trial = allowed.copy()
        trial[active, candidate[active]] = True
        new_share, new_fit = _mixture(likelihood, sub, len(mixed_), trial)
        active &= new_fit - fit > price[mixed_]
        allowed[active] = trial[active]
        share[active], fit[active] = new_share[active], new_fit[active]
    result[mixed_] = share
    return result


def _summed(held: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    names, codes, times = [], [], []
    for language, parts in held.items():
        counts = np.bincount(np.concatenate(parts), minlength=_GRAMS)
        codes.append(np.flatnonzero(counts))
        times.append(counts[codes[-1]])
        names += [language] * len(codes[-1])
    columns = [pa.array(names, pa.string()), pa.array(np.concatenate(codes), pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(times), pa.int64())], ["lang", "code", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums (lang, code, n) of the n-grams of rows (lang, text)."""
    held: dict[str, list[np.ndarray]] = {}
    size = 0
    for batch in batches:
        for language, text in zip(batch.column(0), batch.column(1), strict=True):
            codes = gram_codes(np.frombuffer(text.as_buffer(), np.uint8)).astype(np.int32)
            held.setdefault(language.as_py(), []).append(codes)
            size += len(codes)
            if size >= _HELD:
                yield _summed(held)
                held, size = {}, 0
    if held:
        yield _summed(held)


def trained(docs: DataFrame) -> Models | None:
    """Models of all languages of the learning documents, from all of their texts."""
    learning = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.col("text") != ""))
    sums = (
        learning.select("lang", "text")
        .mapInArrow(_counted, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    grams: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    names = sums["lang"].combine_chunks().dictionary_encode()
    of, codes, times = (c.to_numpy() for c in (names.indices, sums["code"], sums["n"]))
    for i, language in enumerate(names.dictionary.to_pylist()):
        grams[language] = (codes[of == i], times[of == i])
    return Models(grams) if grams else None


def identified(models: Models | None) -> Column:
    """Struct (lang_pred, score, languages) of the column ``text``."""

    @arrow_udf("struct<lang_pred:string,score:double,languages:string>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores, sets = [], [], []
            for chunk in chunks(texts):
                n = len(chunk.bounds) - 1
                share = (
                    proportions(*models.passages(chunk)) if models is not None else np.zeros((n, 0))
                )
                for i in range(n):
                    raw = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]].tobytes()
                    if not share.shape[1] or not _letter.search(raw.decode()):
                        names.append("und"), scores.append(0.0), sets.append("")
                        continue
                    best = int(share[i].argmax())
                    names.append(models.languages[best])
                    scores.append(float(min(share[i, best], 1.0)))
                    sets.append(",".join(m for m, s in zip(models.languages, share[i], strict=True) if s > 0.01))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())],
                ["lang_pred", "score", "languages"],
            )

    return identify(F.col("text"))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (of the selected set)."""
    models = trained(docs)
    return docs.select(
        "doc_id", held_out().alias("held_out"), identified(models).alias("found")
    ).select("doc_id", "held_out", "found.*")
