"""SimHash fingerprints and the join of those that differ in few bits.

A fingerprint is the majority, bit by bit, of the hashes of a text's shingles. Links are
found by a self-join of the binary trie of all different fingerprints: pairs of nodes are
followed together from the root, differing bits add up, and a pair beyond the budget ends.
Spark follows the upper levels as tables of node pairs until the two nodes of a pair hold
few enough fingerprints; each such pair is then one task's work, carried on in arrays.

Edge cases: a text without words (also NULL or empty) has fingerprint zero and is linked
like any other; repeated rows share a fingerprint; a NULL doc_id keeps its row, and its
component is the smallest doc_id there is in it (NULL if none); an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.components import components
from leadspark.llm.shared import Workspace, unused
from leadspark.operators.joins import split_left_join

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
#: Fingerprints in the two nodes of a pair that one task takes, at most.
TASK_FINGERPRINTS = 1 << 17
#: Bits that one table of node pairs goes down.
STEP = 2
#: Node pairs followed at once, and pairs of fingerprints compared at once, in a task.
FRONT = 1 << 20
LEAF_PAIRS = 16


def text_fingerprint(text: bytes | None, words: int, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text, unsigned."""
    import xxhash

    found = (text or b"").lower().split()  # of bytes: A-Z only, and the white space asked for
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    number = len(found) - words + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, number)
    ones = np.zeros(64, np.int64)
    for at in range(0, number, 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > number).tolist())


def fingerprint(text: str | Column, words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint as a long; its bits are those of the unsigned value."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            made = (text_fingerprint(x, words) for x in batch)
            yield pd.Series(np.fromiter(made, np.uint64, len(batch)).view(np.int64))

    column = F.col(text) if isinstance(text, str) else text
    return of(column.cast("binary"))


def _levels(values: np.ndarray, depth: int):
    """Trie nodes below `depth` by level: start, end, and the two children (-1: none)."""
    levels = []
    starts = np.zeros(1, np.int64)
    for at in range(depth, 65):
        ends = np.append(starts[1:], len(values))
        if at == 64 or (ends - starts).max(initial=0) <= 1:
            levels.append((starts, ends, None, None))
            break
        prefix = values >> np.uint64(63 - at)
        below = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        first = np.searchsorted(below, starts)
        bit = (prefix[starts] & np.uint64(1)).astype(bool)
        two = np.append(below, len(values))[first + 1] < ends
        one = np.where(bit, first, np.where(two, first + 1, -1))
        levels.append((starts, ends, np.where(bit, -1, first), one))
        starts = below
    return levels


def _pairs(left: np.ndarray, right: np.ndarray | None, depth: int, apart: int, most: int):
    """Index pairs within `most` bits, in batches; right None: the left with itself."""
    same = right is None
    trees = [_levels(left, depth)]
    trees.append(trees[0] if same else _levels(right, depth))
    right = left if same else right
    one = np.zeros(1, np.int64)
    stack = [(0, one, one, np.full(1, apart, np.int8))]
    while stack:
        level, a, b, bits = stack.pop()
        if not len(a):
            continue
        if len(a) > FRONT:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half], bits[:half]), (level, a[half:], b[half:], bits[half:])]
            continue
        nodes = [tree[min(level, len(tree) - 1)] for tree in trees]
        (sa, ea, a0, a1), (sb, eb, b0, b1) = nodes
        sizes = (ea[a] - sa[a]) * (eb[b] - sb[b])
        leaf = np.ones(len(a), bool) if a0 is None and b0 is None else sizes <= LEAF_PAIRS
        if leaf.any():
            la, lb, n = a[leaf], b[leaf], sizes[leaf]
            for at in _cuts(n):
                ra, rb, rn = la[at], lb[at], n[at]
                which = np.repeat(np.arange(len(rn)), rn)
                step = np.arange(len(which)) - np.repeat(np.cumsum(rn) - rn, rn)
                width = (eb[rb] - sb[rb])[which]
                x, y = sa[ra][which] + step // width, sb[rb][which] + step % width
                near = np.bitwise_count(left[x] ^ right[y]) <= most
                near &= x < y if same else True
                if near.any():
                    yield x[near], y[near]
        keep = ~leaf
        if not keep.any():
            continue
        a, b, bits = a[keep], b[keep], bits[keep]
        # A tree that has reached single fingerprints ends early: their own bit leads on.
        ca = (a0[a], a1[a]) if a0 is not None else _single(left, sa[a], a, depth + level)
        cb = (b0[b], b1[b]) if b0 is not None else _single(right, sb[b], b, depth + level)
        grown = []
        for i in (0, 1):
            for j in (0, 1):
                go = (ca[i] >= 0) & (cb[j] >= 0) & (bits + (i != j) <= most)
                if same and (i, j) == (1, 0):
                    go &= a != b
                grown.append((ca[i][go], cb[j][go], (bits[go] + (i != j)).astype(np.int8)))
        stack.append((level + 1, *(np.concatenate(parts) for parts in zip(*grown, strict=True))))


def _single(values, starts, nodes, depth):
    bit = (values[starts] >> np.uint64(63 - depth) & np.uint64(1)).astype(bool)
    return np.where(bit, -1, nodes), np.where(bit, nodes, -1)


def _cuts(sizes: np.ndarray) -> Iterator[slice]:
    """Slices whose sizes add up to about FRONT."""
    marks = np.searchsorted(np.cumsum(sizes), np.arange(FRONT, sizes.sum() + FRONT, FRONT))
    last = 0
    for mark in [*np.minimum(marks + 1, len(sizes)).tolist(), len(sizes)]:
        if mark > last:
            yield slice(last, mark)
            last = mark


def _join_to(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after each x and y are put together; a label is the smallest index."""
    while True:
        lx, ly = labels[x], labels[y]
        differ = lx != ly
        if not differ.any():
            return labels
        x, y, lx, ly = x[differ], y[differ], lx[differ], ly[differ]
        low = np.minimum(lx, ly)
        np.minimum.at(labels, lx, low)
        np.minimum.at(labels, ly, low)
        while not np.array_equal(labels, onward := labels[labels]):
            labels = onward


def _linked(most: int):
    """Links of one pair of trie nodes, as few edges as hold its groups together."""

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        values = rows["fp"].to_numpy(np.int64).view(np.uint64)
        side = rows["side"].to_numpy()
        left = np.sort(values[side == 0])
        right = None if first["a"] == first["b"] else np.sort(values[side == 1])
        every = left if right is None else np.concatenate([left, right])
        labels = np.arange(len(every))
        for x, y in _pairs(left, right, int(first["depth"]), int(first["apart"]), most):
            labels = _join_to(labels, x, y if right is None else y + len(left))
        held = np.flatnonzero(labels != np.arange(len(every)))
        ids = every.view(np.int64)
        return pd.DataFrame({"u": ids[held], "v": ids[labels[held]]})

    return of


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def _node_pairs(prints: DataFrame, most: int, work: Workspace) -> DataFrame:
    """Node pairs (depth, a, b, apart) within the budget, each small enough for a task."""
    spark = prints.sparkSession
    front = spark.range(1).select(
        F.lit(0).alias("depth"),
        *(F.lit(0).cast("long").alias(x) for x in ("a", "b")),
        F.lit(0).alias("apart"),
        F.lit(False).alias("small"),  # the root is always split, so that tasks share the work
    )
    done = front.where("small")
    depth = 0
    while not (front := front.where("not small")).isEmpty():
        depth += STEP
        nodes = prints.groupBy(_prefix(depth).alias("p")).agg(F.count("*").alias("n"))
        nodes = nodes.withColumn("up", F.shiftrightunsigned("p", STEP))
        left, right = (nodes.select(*(F.col(c).alias(c + s) for c in nodes.columns)) for s in "ab")
        grown = front.join(left, F.col("upa") == F.col("a")).join(right, F.col("upb") == F.col("b"))
        apart = F.col("apart") + F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")).bitwiseAND((1 << STEP) - 1))
        grown = grown.where((F.col("a") != F.col("b")) | (F.col("pa") <= F.col("pb")))
        small = (F.col("na") + F.col("nb") <= TASK_FINGERPRINTS) | F.lit(depth + STEP > 64)
        grown = grown.select(
            F.lit(depth).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"),
            apart.cast("int").alias("apart"), small.alias("small"),
        ).where(F.col("apart") <= most)
        front = work.store(grown, f"pairs-{depth}")
        done = done.unionByName(front.where("small"))
    return work.store(done.drop("small"), "pairs")


def links(prints: DataFrame, most: int, work: Workspace) -> DataFrame:
    """Edges (u, v) that join every group of different fingerprints linked by `most` bits."""
    pairs = _node_pairs(prints, most, work)
    parts = None
    for (depth,) in pairs.select("depth").distinct().collect():  # at most 33 depths
        here = pairs.where(F.col("depth") == depth)
        sides = here.select("*", F.col("a").alias("p"), F.lit(0).alias("side"))
        sides = sides.unionByName(
            here.where("a <> b").select("*", F.col("b").alias("p"), F.lit(1).alias("side"))
        )
        part = prints.withColumn("p", _prefix(depth)).join(sides, "p").drop("p")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    return parts.groupBy("depth", "a", "b", "apart").applyInPandas(_linked(most), "u long, v long")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    most: int = MAX_BITS,
) -> DataFrame:
    """One row per document: key, text_hash, fp (long), root, component_id.

    root is the smallest fingerprint and component_id the smallest key of all documents reachable over links of at most
    `most` differing bits.
    """
    work = Workspace(docs.sparkSession, "simhash")
    thin = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), fingerprint(text, words).alias("fp")
    )
    thin = work.store(thin, "fingerprints")
    least = work.store(thin.groupBy("fp").agg(F.min("key").alias("least")), "different")
    roots = components(links(least.select("fp"), most, work), work)
    roots = roots.select(F.col("node").alias("fp"), "root")
    least = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = work.store(least, "rooted")
    groups = least.groupBy("root").agg(F.min("least").alias("component_id"))
    known = work.store(least.join(groups, "root").select("fp", "root", "component_id"), "known")
    work.keep("fingerprints", "known")
    return split_left_join(thin, known, ["fp"]).withColumnRenamed("key", key)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Documents without near copies: of each component the row with the smallest doc_id.

    Rows alike in doc_id and text count as one; among rows with that doc_id and different
    texts, the one with the smaller text hash stays. All columns are kept, whatever their names.
    """
    found = near_duplicates(docs, **options)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    (of,) = unused(docs.columns, "_of")
    chosen = found.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias(of))
    marked = docs.withColumn(of, F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    return marked.join(chosen.select(of), of, "left_semi").dropDuplicates([of]).drop(of)
