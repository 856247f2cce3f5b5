"""Best-fit packing of token sequences, planned on counts of lengths.

Documents become pieces of at most `size` tokens. How many pieces have each length is all
the plan needs: best-fit, longest first, runs over at most `size` counts, and whole ranges
of equal sequences are filled in one step. The plan says which ranks within a length go
where; pieces find their place by a join on length and rank. The work of the plan depends
on the number of lengths, not on that of documents.

Edge cases: NULL and empty texts are one end token; of equal rows any may take any of
their places; longer documents are cut into whole sequences but for the first piece, which
takes what is left over; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from leadspark.llm.shared import Workspace, unused

SIZE = 2048
END = 0
#: Chunks of text whose ids a task remembers; then it starts anew.
REMEMBERED = 600_000
#: Pieces of one length that one task ranks, about.
RANKED = 2_000

PIECES = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class Encoder:
    """Ids of texts as bytes, little-endian, four for an id.

    A text is cut before each space that a plainly visible character follows. The pattern
    that splits texts into words for the vocabulary always has a border there, so the ids
    of the chunks, which repeat, join to those of the text.
    """

    def __init__(self, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.raw = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return self.raw.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def encode(self, text: str) -> bytes:
        first, *chunks = text.split(" ")
        found = list(map(self.known.get, chunks))
        if None in found:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for at, chunk in enumerate(chunks):
                if found[at] is None:
                    if not ("!" <= chunk[:1] <= "~" or "\u00c0" <= chunk[:1] <= "\u024f"):
                        return self.ids(text)  # white space in a row, or a rare sign
                    found[at] = self.known.get(chunk)
                    if found[at] is None:
                        found[at] = self.known[chunk] = self.ids(" " + chunk)
        return self.ids(first) + b"".join(found)


def pieces(docs: DataFrame, ranks: str, size: int = SIZE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with their ids (bytes, four for an id): key, piece, start, length, ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks)
        end = END.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for of, whole in zip(batch["key"].astype("Int64"), batch["text"], strict=True):
                ids = (encoder.encode(whole) if whole else b"") + end
                number = len(ids) // 4
                start, piece = 0, 0
                stop = number % size or size
                while start < number:
                    rows.append((of, piece, start, stop - start, ids[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + size, piece + 1
            made = pd.DataFrame(rows, columns=PIECES.names)
            yield made.astype({"key": "Int64", "piece": "int32", "start": "int64", "length": "int64"})

    read = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return read.mapInPandas(cut, PIECES).withColumnRenamed("key", key)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit over counts, longest first.

    Rows (length, rank, until, sequence, each, offset): ranks [rank, until) of that length
    fill sequences from `sequence` on, `each` to one, from `offset` on.
    """
    rows, used = [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # space left -> ranges (first sequence, how many)
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            space = min((x for x in room if x >= length), default=None)
            if space is None:
                each = size // length
                space, first, number = size, used, -(-left // each)
                used += number
            else:
                first, number = room[space].pop()
                if not room[space]:
                    del room[space]
                each = space // length
            whole = min(number, left // each)
            if whole:
                rows.append((length, rank, rank + whole * each, first, each, size - space))
                rank, left = rank + whole * each, left - whole * each
                if space - each * length:
                    room.setdefault(space - each * length, []).append((first, whole))
            first, number = first + whole, number - whole
            if number and left:  # fewer than `each` are left: they go to one sequence
                rows.append((length, rank, rank + left, first, left, size - space))
                room.setdefault(space - left * length, []).append((first, 1))
                rank, left, first, number = rank + left, 0, first + 1, number - 1
            if number:
                room.setdefault(space, []).append((first, number))
    return rows


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Pieces (with a column `length` of 1 to `size`) with sequence_id and offset.

    All columns are kept, whatever their names; those two replace columns of their name. The
    pieces are written once, so wide columns are better derived before (or joined after).
    They are told apart by a number of their own, so rows that repeat, or have no id, are
    ranked by many tasks like others.
    """
    spark = found.sparkSession
    work = Workspace(spark, "packing")
    kept = [name for name in found.columns if name.lower() not in ("sequence_id", "offset")]
    taken = [*found.columns, "sequence_id", "offset"]
    row, parts, part, rank, nth, n, before = unused(
        taken, "_row", "_parts", "_part", "_rank", "_nth", "_n", "_before"
    )
    slot = unused(taken, "_length", "_from", "_until", "_sequence", "_each", "_at")
    found = work.store(found.select(*kept, F.monotonically_increasing_id().alias(row)), "pieces")
    counts = {x["length"]: x["n"] for x in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = T.StructType([T.StructField(name, T.LongType()) for name in slot])
    # A few rows for each of at most `size` lengths.
    slots = work.store(spark.createDataFrame(plan(counts, size), schema), "plan")
    # Ranks within a length: by parts of bounded size, after the parts' counts.
    numbers = [(length, -(-number // RANKED)) for length, number in counts.items()]  # at most `size`
    numbers = spark.createDataFrame(numbers, f"length long, {parts} long")
    found = found.join(F.broadcast(numbers), "length").withColumn(part, F.pmod(F.xxhash64(row), F.col(parts)))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("length", part).agg(F.count("*").alias(n))
    sizes = sizes.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    sizes = work.store(sizes.drop(n), "parts")
    within = Window.partitionBy("length", part).orderBy(row)
    ranked = found.withColumn(rank, F.row_number().over(within) - 1)
    ranked = ranked.join(sizes, ["length", part]).withColumn(rank, F.col(rank) + F.col(before))
    length_, from_, until, sequence, each, at = map(F.col, slot)
    here = (F.col("length") == length_) & (F.col(rank) >= from_) & (F.col(rank) < until)
    placed = ranked.join(slots, here).withColumn(nth, F.col(rank) - from_)
    return placed.select(
        *kept,
        (sequence + F.expr(f"{nth} div {slot[4]}")).alias("sequence_id"),
        (at + F.pmod(F.col(nth), each) * F.col("length")).alias("offset"),
    )
