"""Line deduplication by a suffix array over the sequence of line ids.

The documents, in the order of doc_id, are sequences of line ids. Prefix doubling ranks
the suffixes by their first 1, 2, 4, ... lines: the rank over twice the length comes from
the pair of ranks at a place and half-way on. Places of one rank are an interval of the
suffix array whose common prefix has that many lines; places alone in their interval drop
out. Each place then descends by halving steps to the deepest interval in which it is not
the first: that is the longest run of lines from there on that also occurs earlier. Runs
of at least `min_words` words are deleted, so the first copy of every passage stays.

A place need not descend if its doubled prefix has `min_words` words even without its first
line: every further line of its run then lies in a long enough run from a later start.

Everything is joins, groupings and one sort for each doubling. Places of a common line are
never gathered: a group yields its first place and its size only.

Edge cases: lines are compared without surrounding white space, blank lines are passed over
(and deleted between two deleted lines); runs end with their document; rows alike in doc_id
and text are ordered by a row number; NULL texts stay NULL and NULL doc_ids come last; an
empty table gives none. A document that loses all its lines keeps its row with an empty
text, unless `drop_emptied`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadspark.llm.shared import Workspace, unused
from leadspark.operators.joins import split_left_join

#: Runs with fewer words stay; 1: runs of any length go.
MIN_WORDS = 1
PLACE = ["ord", "idx"]
BLANKS = " \t\r\x0b\f"


def _numbered(docs: DataFrame, row: str, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Documents with a row number, and (_row, ord): numbers in the order of doc_id."""
    rows = work.store(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    keys = rows.select(F.col(row).alias("_row"), "doc_id", F.xxhash64("text").alias("_mark"))
    keys = keys.orderBy(F.col("doc_id").asc_nulls_last(), "_mark", "_row")
    order = work.store(keys.select("_row", F.monotonically_increasing_id().alias("ord")), "order")
    return rows, order


def _lines(rows: DataFrame, row: str, order: DataFrame) -> DataFrame:
    """(ord, idx, line, h, g, w): lines that are not blank with their words; idx counts them."""
    trimmed = F.transform(
        F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), F.trim(x, F.lit(BLANKS)).alias("t"))
    )
    lines = F.posexplode(F.filter(trimmed, lambda x: x["t"] != "")).alias("idx", "x")
    held = rows.select(F.col(row).alias("_row"), lines)
    held = held.select(
        "_row", "idx", F.col("x.line").alias("line"),
        F.xxhash64("x.t").alias("h"), F.xxhash64(F.lit(1), "x.t").alias("g"),
        F.regexp_count("x.t", F.lit(r"[^\x20\x09-\x0D]+")).alias("w"),
    )
    return held.join(order, "_row").drop("_row")


def _ranked(places: DataFrame, names: list[str], work: Workspace, level: int) -> DataFrame:
    """Places whose names occur more than once, with their rank r, which follows the order
    of the names, and whether the place is the first of its rank."""
    groups = places.groupBy(*names).agg(F.count("*").alias("_n"), F.min(F.struct(*PLACE)).alias("_first"))
    groups = groups.where("_n > 1").orderBy(*names)
    groups = groups.select(*names, F.monotonically_increasing_id().alias("r"), "_first")
    groups = work.store(groups, f"ranks-{level}")
    found = split_left_join(places, groups, names).where("r IS NOT NULL")
    head = (F.col("_first") == F.struct(*PLACE)).alias("head")
    found = work.store(found.select(*PLACE, "w", "w0", "r", head), f"level-{level}")
    work.drop(f"ranks-{level}")
    return found


def _doubled(lines: DataFrame, work: Workspace) -> list[DataFrame]:
    """Tables (ord, idx, w, w0, r, head) for prefixes of 1, 2, 4, ... lines; w: words of
    the prefix, w0: of its first line."""
    levels = [_ranked(lines.withColumn("w0", F.col("w")), ["h", "g"], work, 0)]
    while True:
        step = 1 << (len(levels) - 1)
        onward = Window.partitionBy("ord").orderBy("idx").rangeBetween(step, step)
        ahead = F.max(F.struct("r", "w")).over(onward)
        pairs = levels[-1].select(*PLACE, "w", "w0", "r", ahead.alias("next")).where("next IS NOT NULL")
        pairs = pairs.select(
            *PLACE, (F.col("w") + F.col("next.w")).alias("w"), "w0", F.col("r").alias("r1"), F.col("next.r").alias("r2")
        )
        found = _ranked(pairs, ["r1", "r2"], work, len(levels))
        if found.isEmpty():
            return levels
        levels.append(found)


def _runs(levels: list[DataFrame], min_words: int, work: Workspace) -> DataFrame:
    """(ord, idx, d): the d lines from a place on occur earlier too, with enough words.

    Groups are intervals of equal prefixes, named by their first place and length. A place
    sits in the group of the longest doubled prefix in which it is not first; with each
    shorter step, places of a group that also share the next lines go on to a longer group,
    but for the first of them, which stays and also stands for the longer group.
    """
    last = len(levels) - 1
    settled, state = None, None
    for level in range(last, -1, -1):
        size = 1 << level
        here = levels[level]
        heads = here.where("head").select("r", F.col("ord").alias("hord"), F.col("idx").alias("hidx"))
        late = here.where("NOT head")
        if level < last:
            late = late.join(levels[level + 1].where("NOT head").select(*PLACE), PLACE, "left_anti")
        far = F.col("w") - F.col("w0") >= min_words
        sure = late.where(far).select(*PLACE, F.lit(size).alias("d"))
        settled = sure if settled is None else settled.unionByName(sure)
        entry = split_left_join(late.where(~far), heads, ["r"])
        entry = entry.select(*PLACE, F.lit(size).alias("d"), "w", "hord", "hidx", F.lit(True).alias("own"))
        first = [F.col("hord").alias("ord"), F.col("hidx").alias("idx")]
        roots = entry.select(*first, "d", "w", "hord", "hidx", F.lit(False).alias("own")).distinct()
        entry = entry.unionByName(roots)
        if state is not None:
            entry = _descended(state, here, size, work).unionByName(entry)
        state = work.store(entry, f"state-{level}")
    return settled.unionByName(state.where(F.col("own") & (F.col("w") >= min_words)).select(*PLACE, "d"))


def _descended(state: DataFrame, ranks: DataFrame, size: int, work: Workspace) -> DataFrame:
    """Groups split by their next `size` lines."""
    group = ["hord", "hidx", "d"]
    ahead = ranks.select("ord", F.col("idx").alias("_at"), "r", F.col("w").alias("_w"))
    asked = state.withColumn("_at", F.col("idx") + F.col("d")).join(ahead, ["ord", "_at"], "left").drop("_at")
    asked = work.store(asked, f"asked-{size}")
    parts = asked.where("r IS NOT NULL").groupBy(*group, "r")
    parts = parts.agg(F.count("*").alias("_n"), F.min(F.struct(*PLACE)).alias("_first"), F.max("w").alias("w"), F.max("_w").alias("_w"))
    parts = work.store(parts.where("_n > 1"), f"split-{size}")
    longer = (F.col("d") + F.lit(size)).alias("d")
    words = (F.col("w") + F.col("_w")).alias("w")
    told = split_left_join(asked, parts.drop("w", "_w"), [*group, "r"])
    moves = F.col("own") & F.col("_first").isNotNull() & (F.col("_first") != F.struct(*PLACE))
    told = told.select(
        *PLACE,
        F.when(moves, longer).otherwise(F.col("d")).alias("d"),
        F.when(moves, words).otherwise(F.col("w")).alias("w"),
        F.when(moves, F.col("_first.ord")).otherwise(F.col("hord")).alias("hord"),
        F.when(moves, F.col("_first.idx")).otherwise(F.col("hidx")).alias("hidx"),
        "own",
    )
    first = [F.col(f"_first.{c}") for c in PLACE]
    roots = parts.select(
        *(c.alias(n) for c, n in zip(first, PLACE, strict=True)), longer, words,
        *(c.alias(f"h{n}") for c, n in zip(first, PLACE, strict=True)), F.lit(False).alias("own"),
    )
    return told.unionByName(roots)


def _deleted(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """(ord, gone): line numbers to delete, blank lines between them included."""
    within = Window.partitionBy("ord").orderBy("idx")
    reach = F.max(F.col("idx") + F.col("d") - 1).over(within.rowsBetween(Window.unboundedPreceding, 0))
    told = lines.select(*PLACE, "line").join(runs.select("ord").distinct(), "ord", "left_semi")
    told = told.join(runs, PLACE, "left").withColumn("cut", F.coalesce(F.col("idx") <= reach, F.lit(False)))
    start = F.when(F.lag("cut").over(within), F.lag("line").over(within) + 1).otherwise(F.col("line"))
    told = told.withColumn("start", start).where("cut")
    return told.groupBy("ord").agg(F.flatten(F.collect_list(F.sequence("start", "line"))).alias("gone"))


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """Documents without the later copies of repeated runs of lines.

    All columns are kept, whatever their names; n_chars follows the text where there is such
    a column, and n_deleted, which replaces a column of that name, counts the deleted lines.
    """
    work = Workspace(docs.sparkSession, "lines")
    row, cut = unused([*docs.columns, "n_deleted"], "_row", "_gone")
    rows, order = _numbered(docs, row, work)
    lines = work.store(_lines(rows, row, order), "lines")
    runs = work.store(_runs(_doubled(lines.drop("line"), work), min_words, work), "runs")
    gone = _deleted(lines, runs).join(order, "ord").select(F.col("_row").alias(row), F.col("gone").alias(cut))
    # Deletions grow with the corpus: never broadcast.
    joined = rows.join(work.store(gone, "deleted").hint("merge"), row, "left")
    work.keep("rows", "deleted")
    return _rebuilt(joined, cut, drop_emptied).drop(row, cut)


def _rebuilt(joined: DataFrame, gone: str, drop_emptied: bool) -> DataFrame:
    every = F.split("text", "\n")
    left = F.transform(  # the outer array names the lines, so that they are split once
        F.array(every),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: F.get(lines, i)
            ),
            "\n",
        ),
    )
    cut = joined.withColumn("text", F.when(F.col(gone).isNotNull(), left[0]).otherwise(F.col("text")))
    cut = cut.withColumn("n_deleted", F.coalesce(F.array_size(gone), F.lit(0)))
    if "n_chars" in joined.columns:
        kind = joined.schema["n_chars"].dataType
        length = F.when(F.col("n_deleted") > 0, F.length("text").cast(kind))
        cut = cut.withColumn("n_chars", length.otherwise(F.col("n_chars")))
    if drop_emptied:
        cut = cut.where((F.col("n_deleted") == 0) | (F.trim("text", F.lit(BLANKS + "\n")) != ""))
    return cut
