"""License scan: exact phrases, and short notices found with a bounded number of errors.

Text is taken as words of lower-cased ASCII letters, digits and all non-ASCII characters,
joined by single spaces.  A notice that occurs with at most ``e`` edits has one of its
``e + 1`` pieces unchanged (pigeonhole), so an automaton over all pieces of all notices finds
candidates; there the regex library looks for the notice with at most ``e`` edits.  The best
match of a stretch, and those of what it leaves before and after it, are reported with their
spans in words.

* Null and empty texts have no words, no labels and score 0.
* Score: 1 with a base phrase, else the largest 1 - edits / length over the matches, else 0.
* Overlapping candidates of a notice are searched once; whole texts are searched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Fixed phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices of the method, normalised, with their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("creative commons attribution", "cc-by"),
    ("licensed under a creative commons", "cc"),
    ("mozilla public license", "mpl"),
    ("dedicated to the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
)
#: One edit allowed for so many characters of a notice.
CHARS_PER_EDIT = 9

_WORDS = bytes(
    ord(chr(c).lower()) if chr(c).isascii() and chr(c).isalnum() else c if c >= 0x80 else 0x20
    for c in range(256)
)


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, notices=NOTICES):
        self._phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self._seeds = ahocorasick.Automaton()
        self._notices = []
        owners = defaultdict(list)
        for number, (notice, label) in enumerate(notices):
            edits = len(notice) // CHARS_PER_EDIT
            pattern = regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={edits}}}")
            self._notices.append((notice, label, edits, pattern))
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                owners[notice[begin:end]].append((number, begin))
        for seed, where in owners.items():
            self._seeds.add_word(seed, (len(seed), where))
        self._seeds.make_automaton()

    def _stretches(self, text: str) -> dict[int, list[list[int]]]:
        """Per notice the stretches of ``text`` that may hold it, merged where they overlap."""
        found: dict[int, list[list[int]]] = {}
        for end, (length, where) in self._seeds.iter(text):
            for number, begin in where:
                notice, _, edits, _ = self._notices[number]
                start = end + 1 - length - begin
                low, high = max(0, start - edits), min(len(text), start + len(notice) + edits)
                spans = found.setdefault(number, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                else:
                    spans.append([low, high])
        return found

    @staticmethod
    def _matches(pattern: regex.Pattern, text: str, low: int, high: int) -> Iterator[regex.Match]:
        """The best match of a stretch, and in turn those of what it leaves on either side."""
        parts = [(low, high)]
        while parts:
            low, high = parts.pop()
            if match := pattern.search(text, low, high):
                yield match
                parts += [(low, match.start()), (match.end(), high)]

    def notices(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, last word, edits, likeness) of the notices in normalised text."""
        out = []
        for number, spans in self._stretches(text).items():
            notice, label, _, pattern = self._notices[number]
            for low, high in spans:
                for match in self._matches(pattern, text, low, high):
                    edits = sum(match.fuzzy_counts)
                    first = text.count(" ", 0, match.start() + (text[match.start()] == " "))
                    last = text.count(" ", 0, match.end())
                    out.append((label, first, last, edits, 1 - edits / len(notice)))
        return out

    def scan(self, raw: bytes) -> dict:
        words = raw.translate(_WORDS).split()
        joined = b" ".join(words)
        padded = b" " + joined + b" "
        n_base, first, last, base = 0, None, None, set()
        for phrase, label in self._phrases:
            at = padded.find(phrase)
            while at >= 0:
                place = padded.count(b" ", 0, at)
                n_base += 1
                base.add(label)
                first = place if first is None else min(first, place)
                last = place if last is None else max(last, place)
                at = padded.find(phrase, at + 1)
        near = self.notices(joined.decode("latin-1"))
        return {
            "n_words": len(words),
            "n_base": n_base,
            "first_word": first,
            "last_word": last,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {hit[0] for hit in near})),
            "score": 1.0 if base else max((hit[4] for hit in near), default=0.0),
            "spans": [dict(zip(("label", "first", "last", "edits"), hit, strict=False)) for hit in sorted(near)],
        }


_FIELDS = (
    "n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, "
    "labels: string, score: double, "
    "spans: array<struct<label: string, first: bigint, last: bigint, edits: bigint>>"
)
_span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int64())])
_ARROW = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(_span))]
)


def scanned() -> Column:
    """Struct of what the scan finds in the column ``text``."""

    @arrow_udf(f"struct<{_FIELDS}>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner()
        for texts in batches:
            rows = [scanner.scan((t.as_py() or "").encode()) for t in texts]
            yield pa.array(rows, _ARROW)

    return scan(F.col("text"))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    return docs.select("doc_id", scanned().alias("s")).select("doc_id", "s.*")
