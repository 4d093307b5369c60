"""Removal of runs of lines that stood earlier in the corpus, found by winnowing.

The lines of a document that hold a word form its sequence.  ``GRAM`` consecutive line
hashes make a gram, and the smallest gram of every ``WINDOW`` consecutive grams is a
fingerprint.  Two runs of ``RUN = WINDOW + GRAM - 1`` or more equal lines share a fingerprint
for certain.  Fingerprints that occur at two places are joined back to their positions,
each match is extended to the runs of ``RUN`` lines on both sides of it, and a run that
stood earlier (in order of doc_id, then place) is deleted.

Fewer than ``RUN`` consecutive lines are a run too if they hold more than ``words`` words
together (``WORDS`` unless given); each of them is its own fingerprint.  With ``None`` such
passages stay.  A line is therefore deleted exactly if it lies in a run, equal byte for byte
to one that began earlier.  Longer repeats are unions of such runs.

* Null and empty texts have no lines with a word; nothing is removed from them.
* Lines without a word are not part of a sequence and stay.
* Rows that repeat a doc_id and its text are one document and get the same result; a
  doc_id with two texts counts as two documents.  A null doc_id comes first.
* All intermediate rows are hashes; a frequent fingerprint or run is counted before the
  shuffle, and the joins back to it are left to adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import WORD, stored, text_or_empty, whole_row

#: Lines in a gram and grams in a window; runs of three lines or more are found.
GRAM, WINDOW = 2, 2
RUN = GRAM + WINDOW - 1
#: One or two lines are a run if they hold more words than this.
WORDS = 50


def _lines() -> F.Column:
    return F.split(text_or_empty(), "\n", -1)


def _sequences(docs: DataFrame, words: int | None) -> DataFrame:
    """Per document the hashes of its lines with a word and their places among all lines.

    With ``words`` given also the number of words of each of these lines.
    """
    numbered = F.transform(
        _lines(), lambda line, i: F.struct(i.alias("at"), line.alias("line"))
    )
    worded = F.filter(numbered, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))
    columns = ["at", "hash"] if words is None else ["at", "hash", "n"]

    def measured(x: F.Column) -> F.Column:
        fields = [x["at"].alias("at"), F.xxhash64(x["line"]).alias("hash")]
        if words is not None:
            fields.append(F.regexp_count(x["line"], F.lit(WORD)).alias("n"))
        return F.struct(*fields)

    return (
        docs.select(
            "doc_id",
            F.xxhash64(text_or_empty()).alias("text_hash"),
            F.transform(worded, measured).alias("seq"),
        )
        .filter(F.size("seq") >= (RUN if words is None else 1))
        .select("doc_id", "text_hash", *[F.col(f"seq.{c}").alias(c) for c in columns])
    )


def _fingerprints(sequences: DataFrame) -> DataFrame:
    """Window minima with the lines around them: (fingerprint, document, place, context)."""
    gram = ", ".join(f"element_at(hash, p + {i})" for i in range(1, GRAM + 1))
    minima = f"""array_distinct(transform(
        sequence(0, size(hash) - {RUN}),
        s -> array_min(transform(sequence(s, s + {WINDOW - 1}),
                                 p -> struct(xxhash64({gram}) as gram, p as place)))))"""
    around = f"greatest(minimum.place - {WINDOW - 1}, 0)"
    length = f"minimum.place + {RUN} - {around}"
    return sequences.filter(F.size("hash") >= RUN).select(
        "doc_id", "text_hash", "at", "hash", F.explode(F.expr(minima)).alias("minimum")
    ).selectExpr(
        "minimum.gram as fingerprint",
        "doc_id",
        "text_hash",
        f"slice(at, {around} + 1, {length}) as at",
        f"slice(hash, {around} + 1, {length}) as hash",
    )


def _wordy_runs(sequences: DataFrame, length: int, words: int) -> DataFrame:
    """The runs of ``length`` lines that hold more than ``words`` words: as in ``repeated_lines``."""
    run = f"""filter(transform(sequence(1, size(hash) - {length - 1}),
        s -> struct(slice(hash, s, {length}) as lines, slice(at, s, {length}) as at,
                    aggregate(slice(n, s, {length}), 0L, (a, b) -> a + b) as n)),
        run -> run.n > {words})"""
    return (
        sequences.filter(F.size("hash") >= length)
        .select("doc_id", "text_hash", F.explode(F.expr(run)).alias("run"))
        .select("doc_id", "text_hash", "run.lines", "run.at")
    )


def repeated_lines(docs: DataFrame, words: int | None = WORDS) -> DataFrame:
    """(doc_id, text_hash, removed): per document that has any, the line numbers to delete."""
    sequences = stored(_sequences(docs, words), "lines")
    prints = _fingerprints(sequences)
    frequent = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    matches = prints.join(frequent.select("fingerprint"), "fingerprint")
    runs = matches.selectExpr(
        "doc_id",
        "text_hash",
        f"explode(transform(sequence(1, size(hash) - {RUN - 1}), "
        f"s -> struct(slice(hash, s, {RUN}) as lines, slice(at, s, {RUN}) as at))) as run",
    ).select("doc_id", "text_hash", "run.lines", "run.at")
    if words is not None:
        for length in range(1, RUN):
            runs = runs.unionByName(_wordy_runs(sequences, length, words))
    runs = stored(runs, "line-runs")
    place = F.struct(
        F.col("doc_id").isNotNull().alias("known"),
        "doc_id",
        "text_hash",
        F.col("at")[0].alias("start"),
    )
    first = (
        runs.groupBy("lines")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .select("lines", "first")
    )
    later = runs.join(first, "lines").filter(place > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("removed")
    )


def _without(lines: str, removed: str) -> F.Column:
    """The stretches of ``lines`` between removed numbers."""
    return F.expr(
        f"""flatten(zip_with(
            concat(array(-1), {removed}), concat({removed}, array(size({lines}))),
            (before, after) -> slice({lines}, before + 2, after - before - 1)))"""
    )


def _joined(docs: DataFrame, words: int | None) -> DataFrame:
    removed = repeated_lines(docs, words)
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(text_or_empty()).alias("hash"),
        F.col("text").alias("old_text"),
    )
    same = rows["id"].eqNullSafe(removed["doc_id"]) & (rows["hash"] == removed["text_hash"])
    return rows.join(removed, same, "left").select("row", "id", "old_text", "removed")


def line_report(docs: DataFrame, words: int | None = WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (lowercase hex of the text that stays)."""
    lines = F.split(F.coalesce("old_text", F.lit("")), "\n", -1)
    kept = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(_without("lines", "removed"))
    return (
        _joined(docs, words)
        .select("id", "removed", lines.alias("lines"))
        .select(
            F.col("id").alias("doc_id"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.sha2(F.array_join(kept, "\n"), 256).alias("kept_sha256"),
        )
    )


def drop_repeated_lines(docs: DataFrame, words: int | None = WORDS) -> DataFrame:
    """``docs`` with the text that stays; ``n_chars`` follows it.  Untouched rows are unchanged.

    Documents of which no line with a word stays are dropped; those without any to begin
    with are kept.
    """
    rows = _joined(docs, words).withColumn("lines", F.split("old_text", "\n", -1))
    rows = rows.withColumn(
        "new_text",
        F.when(F.col("removed").isNull(), F.col("old_text")).otherwise(
            F.array_join(_without("lines", "removed"), "\n")
        ),
    )
    emptied = F.col("removed").isNotNull() & ~F.col("new_text").rlike(r"[^\x20\x09-\x0D]")
    fields = []
    for field in docs.schema:
        old = F.col("row")[field.name]
        if field.name == "text":
            old = F.col("new_text")
        elif field.name == "n_chars":
            length = F.length("new_text").cast(field.dataType)
            old = F.when(F.col("removed").isNull(), old).otherwise(length)
        fields.append(old.alias(field.name))
    return rows.filter(~emptied).select(*fields)
