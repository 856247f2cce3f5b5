"""Mixing of sources to target weights by Poisson replication.

Each source has a rate: how often one of its documents should appear on average so that
the sources come out in the target weights. A hash of the document, uniform in [0, 1), is
put through the inverse of the Poisson distribution with that mean, and the document is
repeated so often (also zero times). The copies go to partitions by a hash and are sorted
by it, which shuffles them globally. All steps are column expressions.

Edge cases: a NULL source is a source of its own; NULL and empty texts count like others;
rows alike in doc_id and text get the same count each; a source without weight is left
out, a weight without documents has no effect; an empty table gives none. Other columns
may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace, unused

#: Weight of a source is its number of documents to this power: below 1, small sources gain.
POWER = 0.5
SEED = "mix"
#: Documents put out, as a multiple of those put in.
SHARE = 1.0
#: The distribution is written out until its upper tail is below what a double can tell
#: from 1: this many standard deviations, and this many counts more.
TAIL_DEVIATIONS = 10
TAIL_COUNTS = 40
#: Hex digits of the hash that make the uniform number; 13 are 52 bits.
DIGITS = 13


def draw(*values: Column) -> Column:
    """Uniform number in [0, 1) from a hash of the values."""
    mark = F.md5(F.concat_ws(":", *values))
    return F.conv(F.substring(mark, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def distribution(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... of the Poisson distribution, as an array."""
    last = F.ceil(rate + TAIL_DEVIATIONS * F.sqrt(rate) + TAIL_COUNTS).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def onward(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(
            log.alias("log"),
            (state["sum"] + F.exp(log)).alias("sum"),
            F.concat(state["all"], F.array(state["sum"] + F.exp(log))).alias("all"),
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, onward, lambda state: state["all"])


def power_weights(docs: DataFrame, power: float = POWER) -> DataFrame:
    """(source, weight): each source's number of documents to a power."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, share: float = SHARE) -> DataFrame:
    """(source, rate): mean number of copies of a document of each source."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    both = sizes.join(weights, sizes["source"].eqNullSafe(weights["source"])).select(sizes["source"], "n", "weight")
    total = both.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_weight"))
    both = both.where("weight > 0").join(total)  # one row of totals
    rate = F.col("weight") / F.col("all_weight") * F.col("all_n") * F.lit(share) / F.col("n")
    return both.select("source", rate.alias("rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """Documents repeated to the target weights, globally shuffled.

    All columns are kept; copy_no counts the copies of a row from 0 to copies - 1, and
    shuffle_key is the order (columns of these three names are replaced). Rows alike have
    the same keys, and are dealt by a row number besides, so that a row that comes very
    often does not come to one task. Sources may be many: their rates are a written table,
    which Spark broadcasts or shuffles by its size.
    """
    work = Workspace(docs.sparkSession, "mixing")
    kept = [name for name in docs.columns if name.lower() not in ("copies", "copy_no", "shuffle_key")]
    source, upto, row = unused([*docs.columns, "copies", "copy_no", "shuffle_key"], "_source", "_upto", "_row")
    weights = power_weights(docs) if weights is None else weights
    known = rates(docs, weights, share)
    known = known.select(F.col("source").alias(source), distribution(F.col("rate")).alias(upto))
    known = work.store(known, "rates")
    joined = docs.join(known, docs["source"].eqNullSafe(known[source]))
    uniform = draw(F.lit(seed), F.col("doc_id").cast("string"), F.coalesce(F.md5("text"), F.lit("")))

    def counted(u: Column) -> Column:
        return F.aggregate(upto, F.lit(0), lambda n, p: n + F.when(p <= u, 1).otherwise(0))

    # The one-element array draws once for a document, and not once for each step.
    copies = F.get(F.transform(F.array(uniform), counted), F.lit(0))
    made = joined.select(*kept, F.monotonically_increasing_id().alias(row), copies.alias("copies"))
    each = made.where("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.md5("text"), F.col("copy_no")))
    dealt = each.withColumn("shuffle_key", order).repartition("shuffle_key", row)
    return dealt.sortWithinPartitions("shuffle_key").drop(row)
