"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected by random rotations to a few dimensions, shifted, and put on Hilbert
curves. Each curve's order is range-partitioned by Spark into blocks of neighbouring keys.
A query looks at the blocks within its window on every curve; what the windows hold merges,
and the exact inner products of the original vectors decide.

Keys follow direction, and the largest inner product is not only a matter of direction. So
a vector x is projected with one more part, sqrt(M^2 - |x|^2) for the greatest length M, and
a query with a zero there: then the nearest direction is the largest inner product.

The width of the windows is not guessed: the recall of widths is measured for a stated set
of queries against all vectors, and the narrowest one that reaches the wanted recall is
taken. Vectors with structure need narrow windows; vectors spread evenly in many dimensions
have no near neighbours to speak of. Where windows of that width would hold as many blocks
as the table, they are opened to the whole of the first curve: that costs less and is exact.
Every table is searched by its windows, large or small. A pair that meets on several curves
is scored on the first of them only. Tasks hold stretches of blocks that grow with the width,
so that a query goes to few of them.

Equal vectors are one point with the smallest ids it has, as many as an answer can hold, so
that a vector that comes very often is one row.

Edge cases: vectors that are NULL, zero, or hold NULL, NaN or infinite parts take no part,
nor do rows without an id; a shorter vector counts as one with zeros behind; rows with equal
ids are rows of their own, each a candidate of the others and, if asked for, each with an
answer under its id; equal scores are ordered by the smaller id; with fewer candidates than
asked for all are given; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadspark.llm.shared import Workspace

NEAREST = 20
EVERY = 20
#: Curves, projected dimensions, bits of a dimension in a key.
CURVES = 12
DIMENSIONS = 6
BITS = 8
SEED = 7
#: Neighbouring vectors of a curve that one block holds, about.
BLOCK = 512
#: Queries that the recall of window widths is measured on, at most, and the recall wanted.
MEASURED = 96
RECALL = 0.95
#: Queries and points that meet in one task where windows are wide, about.
QUERY_PART = 1 << 12
POINT_PART = 1 << 14


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of `bits`-bit coordinates, as int64.

    Coordinates are turned into the curve's transposed form, level by level, for all rows
    together; its bits, interleaved, are the key.
    """
    x = cells.astype(np.int64).copy()
    rows, dims = x.shape
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(dims):
            set_ = (x[:, d] & level) != 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            if d:
                x[:, d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(rows, np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where(x[:, dims - 1] & level, level - 1, 0)
        level >>= 1
    x ^= turn[:, None]
    keys = np.zeros(rows, np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            keys = (keys << 1) | ((x[:, d] >> bit) & 1)
    return keys


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _projections(width: int, curves: int = CURVES, dims: int = DIMENSIONS, seed: int = SEED):
    """Orthogonal directions, all curves' together spreading over the space, and shifts."""
    random = np.random.default_rng(seed)
    needed, sets = curves * dims, []
    while sum(x.shape[1] for x in sets) < needed:
        sets.append(np.linalg.qr(random.normal(size=(width, width)))[0])
    directions = np.concatenate(sets, axis=1)[:, :needed].reshape(width, curves, dims).transpose(1, 0, 2)
    return directions, random.uniform(0, 1, size=(curves, dims))


def points(frame: DataFrame, work: Workspace, key: str, vector: str, keep: int, every: int):
    """(point, v, ids), different vectors with their `keep` smallest (id, row); (id, row,
    point) of the rows asked for; and the vectors' width and greatest length."""
    whole = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = frame.select(F.col(key).cast("long").alias("id"), whole.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    rows = work.store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda n, x: n + x * x))
    width, longest = rows.agg(F.max(F.size("v")), F.max(length)).first()
    missing = F.array_repeat(F.lit(0.0), F.lit(width or 0) - F.size("v"))
    rows = rows.withColumn("v", F.concat("v", missing))
    # Only the first rows of a vector leave a task; those of all tasks are few then.
    first = Window.partitionBy("v").orderBy("id", "row")
    some = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= keep)
    some = some.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("ids"))
    # Numbers of points follow their first ids, which settle ties.
    some = work.store(some.orderBy(F.col("ids")[0]).select(F.monotonically_increasing_id().alias("point"), "v", "ids"), "points")
    marks = some.select("point", F.xxhash64("v").alias("_h"), F.col("v").alias("_v"))
    asking = rows.where(F.col("id") % every == 0).withColumn("h", F.xxhash64("v"))
    asking = asking.join(marks, (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")))
    return some, work.store(asking.select("id", "row", "point"), "asking"), width or 0, longest or 0.0


def _placed(some: DataFrame, queries: DataFrame, width: int, longest: float, curves: int) -> DataFrame:
    """(curve, k, point, asks): every point on every curve, and every query."""
    directions, shifts = _projections(width + 1, curves)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["v"])
            asks = batch["asks"].to_numpy(bool)
            lengths = np.linalg.norm(x, axis=1)
            more = np.sqrt(np.maximum(longest**2 - lengths**2, 0))
            x = np.column_stack([x, np.where(asks, 0, more)]) / np.where(asks, lengths, longest)[:, None]
            for curve in range(curves):
                # One part of a unit vector in `width` dimensions is about normal.
                z = x @ directions[curve] * np.sqrt(width + 1)
                z = (np.clip(z, -4, 4) + 4 + shifts[curve]) / 9 * (1 << BITS)
                cells = np.clip(z.astype(np.int64), 0, (1 << BITS) - 1)
                keys = hilbert_keys(cells, BITS)
                yield pd.DataFrame({"curve": curve, "k": keys, "point": batch["point"], "asks": asks})

    both = some.select("point", "v", F.lit(False).alias("asks"))
    both = both.unionByName(queries.select(F.col("query").alias("point"), "v", F.lit(True).alias("asks")))
    return both.mapInPandas(place, "curve int, k long, point long, asks boolean")


def _blocks(placed: DataFrame, total: int, number: int, curves: int, work: Workspace) -> DataFrame:
    """(curve, block, point, asks): blocks of equal size, counted along each curve."""
    parts = max(1, min(4096, curves * number // 8))
    placed = work.store(placed, "keys")
    order = ["curve", "k", "point", "asks"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = work.store(ordered.withColumn("nth", F.monotonically_increasing_id()), "ordered")
    # Places along a curve: those within a partition, after the counts of earlier ones.
    part = F.shiftright("nth", 33)
    ordered = ordered.withColumn("part", part)
    sizes = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("curve", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = ordered.join(work.store(sizes, "sizes"), ["curve", "part"])
    place = F.col("before") + F.col("nth") - F.col("first")
    block = F.least((place * number / F.lit(max(total, 1))).cast("int"), F.lit(number - 1))
    return work.store(placed.select("curve", block.alias("block"), "point", "asks"), "blocks")


def _near(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` greatest scores, and of those that rounding may have kept out."""
    if len(scores) <= most:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - most)[len(scores) - most]
    return np.flatnonzero(scores >= edge - 1e-9 * max(1.0, abs(edge)))


FOUND = "query long, point long, score double"


def _scored(q: np.ndarray, names: np.ndarray, c: np.ndarray, points_: np.ndarray, most: int, open_=None) -> pd.DataFrame:
    """The best points of each query among some; `open_` says which may be looked at."""
    out = []
    for at in range(0, len(q), 256):
        scores = q[at : at + 256] @ c.T
        if open_ is not None:
            scores = np.where(open_(slice(at, at + 256)), scores, -np.inf)
        for row, mine in zip(range(at, at + 256), scores, strict=False):
            near = np.flatnonzero(mine > -np.inf)
            near = near[_near(mine[near], most)]
            # Summed in one order for all, so that a pair has one score wherever it meets.
            exact = (c[near] * q[row][None, :]).sum(axis=1)
            best = np.lexsort((points_[near], -exact))[:most]
            out.append((np.full(len(best), names[row]), points_[near[best]], exact[best]))
    if not out:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    query, point, score = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"query": query, "point": point, "score": score})


def _searched(queries: DataFrame, some: DataFrame, blocks: DataFrame, number: int, reach: int, most: int, asked: int) -> DataFrame:
    """(query, point, score): the best points in a query's windows, `reach` blocks to either
    side on each curve; at most `most` for a query and stretch of blocks."""
    stretch = max(1, min(reach, POINT_PART // BLOCK))
    parts = max(1, -(-asked * min(number, 2 * reach + stretch) // (number * QUERY_PART)))
    along = F.array_sort(F.collect_list(F.struct("curve", "block")))  # one for each curve
    # Windows as long as a curve hold every pair on the first one.
    if 2 * reach + 1 >= number:
        along = F.slice(along, 1, 1)
    homes = blocks.groupBy("point", "asks").agg(F.transform(along, lambda x: x["block"]).alias("homes"))
    low = F.greatest(F.lit(0), F.least(F.col("block") - reach, F.lit(number - 1 - 2 * reach)))
    high = F.least(low + 2 * reach, F.lit(number - 1))
    place = lambda block: F.floor(block / F.lit(stretch)).cast("int")
    left = queries.join(homes.where("asks").drop("asks"), F.col("query") == F.col("point"))
    left = left.select(F.col("query").alias("id"), "v", "homes", F.lit(True).alias("asks"), F.posexplode("homes").alias("curve", "block"))
    left = left.withColumn("place", F.explode(F.sequence(place(low), place(high)))).drop("block")
    left = left.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    right = some.join(homes.where("NOT asks").drop("asks"), "point")
    right = right.select(F.col("point").alias("id"), "v", "homes", F.lit(False).alias("asks"), F.posexplode("homes").alias("curve", "block"))
    right = right.withColumn("place", place(F.col("block"))).drop("block")
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        asks, ids = rows["asks"].to_numpy(bool), rows["id"].to_numpy(np.int64)
        x, homes_ = _matrix(rows["v"]), np.array(rows["homes"].tolist(), dtype=np.int64)
        here = int(rows["curve"].iloc[0])
        lows = np.maximum(0, np.minimum(homes_[asks] - reach, number - 1 - 2 * reach))
        theirs = homes_[~asks]

        def meet(at: slice, curve: int) -> np.ndarray:
            apart = theirs[None, :, curve] - lows[at][:, curve, None]
            return (apart >= 0) & (apart <= 2 * reach)

        def open_(at: slice) -> np.ndarray:
            """Pairs that meet on this curve and on no earlier one."""
            met = meet(at, here)
            for curve in range(here):
                met &= ~meet(at, curve)
            return met

        return _scored(x[asks], ids[asks], x[~asks], ids[~asks], most, open_)

    return left.unionByName(right).groupBy("curve", "place", "part").applyInPandas(search, FOUND)


def _reach(some: DataFrame, queries: DataFrame, blocks: DataFrame, most: int, recall: float, work: Workspace) -> int:
    """Blocks to either side that give the wanted recall on MEASURED queries."""
    sample = queries.orderBy(F.xxhash64("query", F.lit(SEED)), "query").limit(MEASURED)
    chosen = [(row["query"], row["v"]) for row in sample.collect()]  # at most MEASURED vectors
    if not chosen:
        return 0
    names = np.array([x for x, _ in chosen], np.int64)
    q = np.array([v for _, v in chosen], np.float64)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            found = _scored(q, names, _matrix(batch["v"]), batch["point"].to_numpy(np.int64), most)
            held = found if held is None else pd.concat([held, found])
            held = held.sort_values(["query", "score", "point"], ascending=[True, False, True]).groupby("query").head(most)
        if held is not None:
            yield held

    true = _ranked(some.select("point", "v").mapInPandas(nearest, FOUND), most)
    true = work.store(true.where(F.col("point") != F.col("query")).select("query", "point"), "measured")
    own = blocks.where("asks").select(F.col("point").alias("query"), "curve", F.col("block").alias("mine"))
    near = true.join(blocks.where("NOT asks"), "point").join(own, ["query", "curve"])
    apart = near.groupBy("query", "point").agg(F.min(F.abs(F.col("block") - F.col("mine"))).alias("apart"))
    needed = apart.agg(F.expr(f"percentile_disc({recall}) WITHIN GROUP (ORDER BY apart)")).first()[0]
    return int(needed or 0)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The `most` best points of each query; the rest leaves no task."""
    first = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    return found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most).drop("nth")


def width(number: int, reach: int, curves: int) -> int:
    """The reach of windows: as measured, or all blocks where so many are read anyway."""
    return reach if curves * (2 * reach + 1) < number else number - 1


def search(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    most: int = NEAREST,
    every: int = EVERY,
    curves: int = CURVES,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of rows whose key `every` divides."""
    work = Workspace(vectors.sparkSession, "ann")
    some, asking, parts, longest = points(vectors, work, key, vector, most + 1, every)
    queries = some.join(asking.select("point").distinct(), "point", "left_semi")
    queries = work.store(queries.select(F.col("point").alias("query"), "v"), "queries")
    total, asked = some.count(), queries.count()
    number = max(1, -(-total // BLOCK))
    placed = _placed(some, queries, max(parts, 1), longest, curves)
    blocks = _blocks(placed, total + asked, number, curves, work)
    reach = width(number, _reach(some, queries, blocks, most + 1, recall, work), curves)
    found = _searched(queries, some, blocks, number, reach, most + 1, asked)
    near = _ranked(found, most + 1)
    near = near.join(some.select("point", "ids"), "point").select("query", "score", F.inline("ids"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    near = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most + 1)
    lists = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "row", "score"))).alias("near"))
    answers = asking.select(F.col("id").alias("query_id"), F.col("row").alias("own"), F.col("point").alias("query"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, most)
    answers = answers.join(lists, "query").select("query_id", F.posexplode(others).alias("place", "x"))
    return answers.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), "x.score")
