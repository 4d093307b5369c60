"""Near-duplicate groups by an inverted join over MinHash coordinates.

1. The shingle set of every whole text is hashed, with a signature of ``COORDINATES`` minima.
   Equal sets become one node; copies are never paired.
2. Every node is posted under each (coordinate, value) pair.  Pairs of sets as similar as
   asked agree on ``m`` of the coordinates but for a chance of ``MISSED`` per link.
   Coordinate values are ordered from rare to frequent, so two such nodes share one among
   their first ``COORDINATES - m + 1`` (the prefix); the frequent rest is skipped.
3. In each posting list every node is paired with one hub, never with all others.  Collisions of
   the two signatures are counted, pairs of at least ``m`` go to the exact check on full
   shingle sets, and links merge groups.  Lists of one group are done.
   In the rest, members outside the list's largest group are compared with all others, block
   by block.  Odd sketches (Mitzenmacher, Pagh and Pham, 2014) bound from below how many
   shingles two sets do not share, so a pair that they refuse is no link for certain; long sets,
   which they tell apart less, must also agree on enough of ``SKETCH`` coordinates.  A pair is
   left to one list of those it shares.  Of the pairs that pass, a task gives a spanning forest
   of their groups to the exact check on full sets.  A task whose forest holds is done, as the
   pairs that it kept back lie in groups now joined; one with a refuted pair is compared once
   more and gives all pairs of groups still apart.  So every pair that shares a prefix value
   was compared or is connected.
4. A group is a connected component over nodes; documents look up that of their set.

* Null and empty texts, and texts without words, have no shingles and stay alone.
* Texts with fewer words than a shingle are one shingle.
* The smallest doc_id names a group.  Rows that repeat a doc_id count as the same document;
  a null doc_id is kept only in a group without any id.
* An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from larder.llm.components import components
from larder.llm.nptext import Chunk, Hasher, chunks, mixed, text_of, words
from larder.llm.tables import small_batches, stored, whole_row

COORDINATES = 32
#: Chance that a link at the threshold agrees on fewer coordinates than are asked for.
MISSED = 1e-6
#: Coordinates of the sketches of nodes in lists, bits of their odd sketches, nodes in a block.
SKETCH, ODD, BLOCK = 256, 4096, 512
SEED = 20240601

_rng = np.random.default_rng(SEED)
_FACTORS = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64)


def shingles(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin."""
    starts, ends, firsts = words(chunk)
    n = len(chunk.bounds) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    hashes = Hasher(chunk.data, fold=True).stretches(starts, ends)
    sizes = np.diff(firsts)
    # Position weights: the i-th word of a shingle is mixed with i.
    rolled = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for i in range(k):
        rolled += mixed(hashes[i : i + len(rolled)] + np.uint64(i + 1))
    text = text_of(firsts)
    full = np.flatnonzero(text[: len(rolled)] == text[k - 1 :][: len(rolled)])
    grams, owner = [mixed(rolled[full])], [text[full]]
    for length in range(1, k):
        short = np.flatnonzero(sizes == length)
        whole = np.zeros(len(short), np.uint64)
        for i in range(length):
            whole += mixed(hashes[firsts[short] + i] + np.uint64(i + 1))
        grams.append(mixed(whole + np.uint64(length * 0x9E37))), owner.append(short)
    gram, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[fresh], owner[fresh]
    return gram, np.searchsorted(owner, np.arange(n + 1))


def _set_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _digests(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each text's set digest."""
    sums = (_set_sums(x, bounds) for x in (mixed(grams), mixed(grams ^ np.uint64(SEED))))
    return tuple(x.view(np.int64) for x in sums)


def _minima(grams: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """The smallest hash of each text's shingles under each of ``n`` functions; 0 without shingles."""
    present = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, n), np.uint64)
    for c in range(n):
        if len(present):
            values = grams * _FACTORS[c]
            values ^= values >> np.uint64(29)
            values *= _SHIFTS[c] | np.uint64(1)
            out[present, c] = np.minimum.reduceat(values, bounds[:-1][present])
    return out


def _signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Tokens (coordinate << 32 | high half of the minimum), a row for each text."""
    least = (_minima(grams, bounds, COORDINATES) >> np.uint64(32)).astype(np.int64)
    tokens = least | (np.arange(COORDINATES) << 32)
    tokens[np.diff(bounds) == 0] = 0
    return tokens


def fingerprint(k: int) -> Column:
    """Struct (n, hi, lo, tokens) of the column ``text``: set size, set digest, signature."""

    @arrow_udf("struct<n:bigint,hi:bigint,lo:bigint,tokens:array<bigint>>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, hi, lo, tokens = [], [], [], []
            for chunk in chunks(texts):
                grams, bounds = shingles(chunk, k)
                n.append(np.diff(bounds))
                for digest, part in zip((hi, lo), _digests(grams, bounds), strict=True):
                    digest.append(part)
                tokens.append(_signatures(grams, bounds))
            flat = np.concatenate(tokens).ravel() if tokens else np.zeros(0, np.int64)
            offsets = np.arange(0, len(flat) + 1, COORDINATES, dtype=np.int32)
            parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, hi, lo)]
            yield pa.StructArray.from_arrays(
                [*map(pa.array, parts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["n", "hi", "lo", "tokens"],
            )

    return measure(F.col("text"))


def _odd_sketch(grams: np.ndarray) -> bytes:
    """For each of ``ODD`` buckets of hashes, whether it holds an odd number of ``grams``."""
    buckets = (grams >> np.uint64(64 - ODD.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(buckets, minlength=ODD).astype(np.uint8) & 1).tobytes()


def _shingle_set(k: int) -> Column:
    """Struct (hi, lo, set, sketch, odd) of the column ``text``: the set digest, the sorted shingle
    hashes, 8 bytes each, two bytes of each of ``SKETCH`` minima, and the odd sketch."""

    @arrow_udf("struct<hi:bigint,lo:bigint,set:binary,sketch:binary,odd:binary>")
    def collect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            hi, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            sets, sketches, odds = [], [], []
            for chunk in chunks(texts):
                grams, bounds = shingles(chunk, k)
                for digest, part in zip((hi, lo), _digests(grams, bounds), strict=True):
                    digest.append(part)
                each = [grams[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
                sets += [x.tobytes() for x in each]
                short = (_minima(grams, bounds, SKETCH) >> np.uint64(40)).astype(np.uint16)
                sketches += [row.tobytes() for row in short]
                odds += [_odd_sketch(x) for x in each]
            digests = [pa.array(np.concatenate(x)) for x in (hi, lo)]
            yield pa.StructArray.from_arrays(
                digests + [pa.array(x, pa.binary()) for x in (sets, sketches, odds)],
                ["hi", "lo", "set", "sketch", "odd"],
            )

    # Else the join on the digest puts a filter on it below the choice of texts, which would
    # measure every text once more.
    return collect.asNondeterministic()(F.col("text"))


def _matches(percent: int, n: int = COORDINATES) -> int:
    """How many of ``n`` coordinates a pair at the threshold agrees on, but for ``MISSED``."""
    share, below = percent / 100, 0.0
    for found in range(n):
        below += comb(n, found) * share**found * (1 - share) ** (n - found)
        if below > MISSED:
            return max(found, 1)
    return n


def _block_pairs(percent: int, forest: bool):
    """Pairs of different groups in the two blocks of a task that may be similar; with
    ``forest`` only as many as join the groups that all of them would join."""
    enough = _matches(percent, SKETCH)

    def compare(table: pa.Table) -> pa.Table:
        token, i, j = (table.column(c)[0].as_py() for c in ("token", "i", "j"))
        own, node, comp, n = (table.column(c).to_numpy() for c in ("own", "node", "comp", "n"))
        sketch = np.stack([np.frombuffer(x.as_buffer(), np.uint16) for x in table.column("sketch")])
        odd = np.stack([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("odd")])
        prefix = table.column("prefix").to_pylist()
        group = np.unique(comp, return_inverse=True)[1]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        for x in left:
            others = right[group[right] != group[x]]
            if i == j:
                others = others[node[others] > node[x]]
            # Of s shingles in two sets, a link leaves s * (100 - percent) / (100 + percent) unshared.
            apart = np.bitwise_count(odd[others] ^ odd[x]).sum(axis=1, dtype=np.int64)
            others = others[(100 + percent) * apart <= (100 - percent) * (n[others] + n[x])]
            agree = np.count_nonzero(sketch[others] == sketch[x], axis=1)
            for y in others[agree >= enough]:
                # Of the lists that the two share, the one of the smallest value takes the pair.
                if group[x] != group[y] and min(set(prefix[x]) & set(prefix[y])) == token:
                    low, high = sorted((int(node[x]), int(node[y])))
                    a.append(low), b.append(high)
                    if forest:
                        group[group == group[y]] = group[x]
        return pa.table(
            {
                "token": pa.array([token] * len(a), pa.int64()),
                "i": pa.array([i] * len(a), pa.int32()),
                "j": pa.array([j] * len(a), pa.int32()),
                "a": pa.array(a, pa.int64()),
                "b": pa.array(b, pa.int64()),
            }
        )

    return compare


def _blocks(lists: DataFrame) -> DataFrame:
    """(token, node, own, i, j): the pairs (i, j) of blocks to compare in lists (token, node, comp)
    that hold several groups, with the members of both."""
    groups = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"))
    largest = (
        groups.groupBy("token")
        .agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("all"))
        .filter("all > top.size")
        .selectExpr(
            "token",
            "top.comp as major",
            f"cast(ceil((all - top.size) / {BLOCK}) as int) as n_other",
            f"cast(ceil(top.size / {BLOCK}) as int) as n_major",
        )
    )
    dealt = lists.join(largest, "token").selectExpr(
        "token",
        "node",
        "comp = major as is_major",
        "n_other",
        "n_major",
        "pmod(xxhash64(node), n_other) as other_block",
        "pmod(xxhash64(node), n_major) + n_other as major_block",
    )
    paired = dealt.selectExpr(
        "token",
        "node",
        "if(is_major, major_block, other_block) as own",
        "explode(sequence(0, if(is_major, n_other, n_other + n_major) - 1)) as partner",
    )
    return paired.selectExpr(
        "token",
        "node",
        "cast(own as int) as own",
        "cast(least(own, partner) as int) as i",
        "cast(greatest(own, partner) as int) as j",
    )


def _rest_pairs(blocks: DataFrame, lists: DataFrame, sets: DataFrame, percent: int, forest: bool) -> DataFrame:
    """(token, i, j, a, b): candidate pairs of different groups in ``blocks``, groups as in ``lists``."""
    member = lists.groupBy("node").agg(F.max("comp").alias("comp"), F.collect_list("token").alias("prefix"))
    filled = blocks.join(sets.select("node", "n", "sketch", "odd"), "node").join(member, "node")
    return filled.groupBy("token", "i", "j").applyInArrow(
        _block_pairs(percent, forest), "token bigint, i int, j int, a bigint, b bigint"
    )


def _grouped(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """``lists`` with the groups of ``comps``."""
    found = lists.select("token", "node").join(comps, "node", "left")
    return stored(found.select("token", "node", F.coalesce("comp", "node").alias("comp")), "postings")


def _groups_of(links: DataFrame, lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, comp): the groups of ``links`` and of all other links between members of a list."""
    comps = components(links)
    lists = _grouped(lists, comps)
    blocks = _blocks(lists)
    pairs = stored(_rest_pairs(blocks, lists, sets, percent, forest=True), "candidates")
    if pairs.isEmpty():
        return comps
    found = stored(_linked(pairs.select("a", "b"), sets, percent), "links")
    links = links.unionByName(found)
    comps = components(links)
    refuted = stored(pairs.join(found, ["a", "b"], "left_anti"), "refuted")
    if refuted.isEmpty():
        return comps
    again = blocks.join(refuted.select("token", "i", "j").distinct(), ["token", "i", "j"], "left_semi")
    kept_back = _rest_pairs(again, _grouped(lists, comps), sets, percent, forest=False).select("a", "b")
    kept_back = stored(kept_back.join(refuted, ["a", "b"], "left_anti"), "candidates")
    found = stored(_linked(kept_back, sets, percent), "links")
    return comps if found.isEmpty() else components(links.unionByName(found))


def _similar(percent: int) -> Column:
    """Whether 100 * intersection >= percent * union, of the sets ``set_a`` and ``set_b``."""

    @arrow_udf("boolean")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right, strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            place = np.searchsorted(b, a)
            place[place == len(b)] = 0
            both = int(np.count_nonzero(b[place] == a)) if len(b) else 0
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    return compare(F.col("set_a"), F.col("set_b"))


def _posting_lists(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, node) for the rare values of each node that some other node has too."""
    posted = nodes.select("node", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    counted = posted.join(shared, "token", "left").select(
        "node", F.struct(F.coalesce("df", F.lit(1)).alias("df"), "token").alias("value")
    )
    prefix = counted.groupBy("node").agg(F.array_sort(F.collect_list("value")).alias("all"))
    return (
        prefix.select("node", F.explode(F.slice("all", 1, COORDINATES - _matches(percent) + 1)).alias("value"))
        .filter("value.df > 1")
        .select("value.token", "node")
    )


def _candidates(lists: DataFrame, hubs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list's node and a hub of another group that agree on enough coordinates."""
    pairs = (
        lists.join(hubs.select("token", F.col("node").alias("hub"), F.col("comp").alias("hub_comp")), "token")
        .filter("comp <> hub_comp")
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    collisions = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(
            (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            & (collisions >= _matches(percent))
        )
        .select("a", "b")
    )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(one, "a").join(two, "b").filter(_similar(percent)).select("a", "b")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    with small_batches(docs.sparkSession):  # all that runs Python is stored in here
        measured, named = _measured_and_named(docs, k, percent)
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    member = named.join(least, "comp").select("hi", "lo", "component_id")
    grouped = measured.filter("n > 0").join(member, ["hi", "lo"]).select("doc_id", "n", "component_id")
    alone = measured.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _measured_and_named(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Set size and digest (hi, lo) of every document, and the group (comp) of every distinct set."""
    measured = docs.select("doc_id", fingerprint(k).alias("m")).select("doc_id", "m.*")
    measured = stored(measured, "signatures")
    nodes = (
        measured.filter("n > 0")
        .groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("least_id"), F.min("n").alias("n"), F.first("tokens").alias("tokens"))
    )
    # Numbered once and written, so that the numbers stay the same for all later reads.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    lists = stored(_posting_lists(nodes, percent).withColumn("comp", F.col("node")), "postings")
    wanted = lists.select("node").distinct().join(nodes, "node").select("node", "least_id", "hi", "lo", "n")
    texts = docs.select("doc_id", "text").join(
        wanted.select("least_id").distinct(), F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi"
    )
    made = texts.select(_shingle_set(k).alias("s")).select("s.*")
    sets = made.join(wanted, ["hi", "lo"]).dropDuplicates(["node"])
    sets = stored(sets.select("node", "n", "set", "sketch", "odd"), "sets")

    hubs = lists.groupBy("token").agg(F.min(F.struct("node", "comp")).alias("hub")).select("token", "hub.*")
    links = stored(_linked(_candidates(lists, hubs, nodes, percent), sets, percent), "links")
    comps = _groups_of(links, lists, sets, percent)

    member = nodes.select("hi", "lo", "node", "least_id")
    named = member.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return measured, stored(named, "members")


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group; all columns as they are."""
    gone = near_groups(docs, k, percent).filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"))
    return rows.join(gone, rows["id"].eqNullSafe(gone["gone"]), "left_anti").select("row.*")
