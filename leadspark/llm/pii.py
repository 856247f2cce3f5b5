"""Personal data by patterns and by bootstrapped contextual extraction.

Base spans are e-mail and IP addresses, card and phone numbers, found by patterns and tests
on what they match. They are the seeds. Words with a digit or an at sign are instances, and
what stands around an instance is its patterns: one and two words before it, and after it.
Patterns and instances make a graph that Spark scores in rounds: a pattern is as good for a
kind as the share of its instances that are believed to be of it, an instance as good as its
best pattern, and seeds are believed from the start. Instances known to be of other kinds
count fully against a pattern, those that nothing is known of a little, if they look at all
like the kind: that is a loose test, an at sign or a number of digits. Patterns with enough
different seeds and a score near 1 then name instances no base pattern has found.

Everything is column expressions, groupings and joins. A text is split by a pattern, and
the lengths of the parts and of the matches, added up, are the places of the matches.

Edge cases: NULL texts count as empty, and their rows stay, with no spans; a text is
searched whole, in time that grows with its length (runs of signs are never tried from
within); places are code points, the end exclusive; rows that repeat get equal spans; an
empty table gives none. Added spans never overlap base spans or one another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace
from leadspark.operators.joins import split_left_join

# Kinds in their order, with their patterns. `(?:\G|(?<!...))` starts a match
# at the beginning of a run of signs or where the last match ended, as trying from within
# a run could only fail; possessive loops find what greedy ones do.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without a match of these have none of the kind; they are quick to look for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]|[0-9]|(?<=0))"
#: Words with a digit or an at sign, from their first sign that is no punctuation on.
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
EDGES = "\"'()[]{}<>,;:.!?"

ROUNDS = 3
#: A pattern is trusted with this many different seeds and this score.
SEEDS = 5
TRUSTED = 0.9
#: What an instance that nothing is known of counts against a pattern, beside a known one.
UNKNOWN = 0.1


def _matches(text: Column, pattern: str, passes: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, end, s, left, right): matches, and the text up to the next ones.

    Only those that pass are held: adding to a list costs as much as the list is long.
    """
    found, parts = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.split(text, pattern, -1)

    def located(both: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,s:string,left:string,right:string>>").alias("all"))

        def onward(state: Column, i: Column) -> Column:
            left, s = F.get(both["parts"], i), F.get(both["found"], i)
            start = state["at"] + F.length(left)
            end = start + F.length(s)
            row = F.struct(
                start.alias("start"), end.alias("end"), s.alias("s"),
                left.alias("left"), F.get(both["parts"], i + 1).alias("right"),
            )
            longer = F.array_append(state["all"], row)
            held = longer if passes is None else F.when(passes(s), longer).otherwise(state["all"])
            return F.struct(end.alias("at"), held.alias("all"))

        places = F.when(F.size(both["found"]) > 0, F.sequence(F.lit(0), F.size(both["found"]) - 1))
        return F.aggregate(F.coalesce(places, F.array().cast("array<int>")), begin, onward, lambda s: s["all"])

    both = F.struct(found.alias("found"), parts.alias("parts"))
    return F.transform(F.array(both), located)[0]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    numbers = F.transform(F.split(F.reverse(_digits(s)), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _passes(kind: str, s: Column) -> Column:
    size = F.length(_digits(s))
    if kind == "ip":
        return s.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return size.between(14, 19) & _luhn(s)
    if kind == "phone":
        return size.between(10, 15)
    return F.lit(True)


SPAN = "struct<start:int,kind_no:int,kind:string,end:int>"


def _spans(text: Column, number: int, kind: str) -> Column:
    def passes(s: Column) -> Column:
        return F.coalesce(_passes(kind, s), F.lit(False))

    def span(x: Column) -> Column:
        names = {"kind_no": F.lit(number), "kind": F.lit(kind)}
        return F.struct(x["start"].alias("start"), *(v.alias(k) for k, v in names.items()), x["end"].alias("end"))

    hint = F.contains(text, F.lit("@")) if HINTS[kind] == "@" else text.rlike(HINTS[kind])
    found = F.transform(_matches(text, KINDS[kind], passes), span).cast(f"array<{SPAN}>")
    return F.when(hint, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Array of (start, kind_no, kind, end), in that order."""
    return F.array_sort(F.concat(*(_spans(text, number, kind) for number, kind in enumerate(KINDS))))


def _instances(text: Column) -> Column:
    """Array of (start, end, s, patterns): words that may be identifiers, trimmed, and the
    words around them."""
    edges = F.lit(EDGES)

    def around(mark: str, part: Column, pattern: str) -> Column:
        words = F.trim(F.lower(F.regexp_extract(part, pattern, 1)), edges)
        plain = F.regexp_replace(words, r"\s+", " ")
        return F.when(words != "", F.concat(F.lit(mark), plain))

    def trimmed(x: Column) -> Column:
        cut = F.length(x["s"]) - F.length(F.ltrim(x["s"], edges))
        s = F.trim(x["s"], edges)
        start = x["start"] + cut
        patterns = F.array(
            around("<", x["left"], r"(\S+)\s*$"), around("<<", x["left"], r"(\S+\s+\S+)\s*$"),
            around(">", x["right"], r"^\s*(\S+)"), around(">>", x["right"], r"^\s*(\S+\s+\S+)"),
        )
        return F.struct(
            start.alias("start"), (start + F.length(s)).alias("end"), F.lower(s).alias("s"),
            F.array_compact(patterns).alias("patterns"),
        )

    found = F.when(text.rlike("[0-9@]"), F.transform(_matches(text, INSTANCE), trimmed))
    return F.filter(found, lambda x: x["s"] != "")


def looks_like(kind: str | Column, s: Column) -> Column:
    """Whether a word could be of a kind at all."""
    if isinstance(kind, Column):
        tests = [F.when(kind == name, looks_like(name, s)) for name in KINDS]
        return F.coalesce(*tests, F.lit(False))
    if kind == "email":
        return F.contains(s, F.lit("@"))
    if kind == "ip":
        return s.rlike("^[0-9a-f]*[0-9][.:][.:0-9a-f]*$")
    digits = F.length(_digits(s))
    plain = ~s.rlike("[^0-9().+-]")
    return plain & (digits >= 12 if kind == "card" else digits.between(7, 15))


def _mentions(found: DataFrame) -> DataFrame:
    """(row, start, end, s, kind, pattern): instances, a row for each pattern; kind is that
    of a base span the instance lies in."""
    each = found.select("row", "base", F.explode("instances").alias("x"))
    inside = F.filter("base", lambda b: (b["start"] < F.col("x.end")) & (b["end"] > F.col("x.start")))
    kind = F.get(inside, F.lit(0))["kind"]
    return each.select("row", "x.start", "x.end", "x.s", kind.alias("kind"), F.explode("x.patterns").alias("pattern"))


def score_graph(edges: DataFrame, work: Workspace, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, told, score): trusted patterns after the rounds, and the kind they tell.

    `edges` has (pattern, s, kind), each once; kind is NULL for what is no seed. Counts of
    a common pattern or instance are sums, made before rows are shuffled.
    """
    seeds = edges.where("kind IS NOT NULL").groupBy("s").agg(F.max("kind").alias("thought"))
    seeds = seeds.withColumn("believed", F.lit(1.0))
    known, turn = seeds, 0
    while True:
        told = split_left_join(edges, known, ["s"])
        unknown = F.col("kind").isNull()
        sums = []
        for kind in KINDS:
            of_kind = F.col("thought").eqNullSafe(F.lit(kind))
            sums += [
                F.sum(F.when(of_kind, F.col("believed")).otherwise(0.0)).alias(f"good_{kind}"),
                F.count_if(F.col("kind") != kind).alias(f"bad_{kind}"),
                F.count_if(unknown & ~of_kind & looks_like(kind, F.col("s"))).alias(f"open_{kind}"),
                F.count_if(F.col("kind") == kind).alias(f"seeds_{kind}"),
            ]
        patterns = told.groupBy("pattern").agg(*sums)
        scored = [
            F.struct(
                F.coalesce(
                    F.try_divide(
                        F.col(f"good_{kind}"),
                        F.col(f"good_{kind}") + F.col(f"bad_{kind}") + UNKNOWN * F.col(f"open_{kind}"),
                    ),
                    F.lit(0.0),
                ).alias("score"),
                F.col(f"seeds_{kind}").alias("seeds"),
                F.lit(kind).alias("told"),
            )
            for kind in KINDS
        ]
        trusted = patterns.select("pattern", F.greatest(*scored).alias("x")).select("pattern", "x.*")
        trusted = trusted.where((F.col("seeds") >= SEEDS) & (F.col("score") >= TRUSTED))
        trusted = work.store(trusted.select("pattern", "told", "score"), f"patterns-{turn}")
        turn += 1
        if turn == rounds:
            return trusted
        named = split_left_join(edges.where("kind IS NULL"), trusted, ["pattern"])
        named = named.where(looks_like(F.col("told"), F.col("s")))
        best = F.max(F.struct("score", "told")).alias("best")
        named = named.groupBy("s").agg(best).select("s", F.col("best.told").alias("thought"), F.col("best.score").alias("believed"))
        known = work.store(seeds.unionByName(named.join(seeds.select("s"), "s", "left_anti")), f"known-{turn}")


def _added(found: DataFrame, work: Workspace) -> DataFrame:
    """(row, added): spans that trusted patterns name."""
    mentions = work.store(_mentions(found), "mentions")
    edges = mentions.groupBy("pattern", "s").agg(F.max("kind").alias("kind"))
    trusted = score_graph(work.store(edges, "edges"), work)
    open_ = split_left_join(mentions.where("kind IS NULL"), trusted, ["pattern"])
    open_ = open_.where(looks_like(F.col("told"), F.col("s")))
    best = open_.groupBy("row", "start", "end").agg(F.max_by("told", F.struct("score", "told")).alias("kind"))
    names = F.array(*map(F.lit, KINDS))
    number = (F.array_position(names, F.col("kind")) - 1).cast("int")
    span = F.struct("start", number.alias("kind_no"), "kind", "end")
    return best.groupBy("row").agg(F.array_sort(F.collect_list(span)).cast(f"array<{SPAN}>").alias("added"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans): arrays of (start, kind_no, kind, end); spans holds base and more."""
    work = Workspace(docs.sparkSession, "pii")
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        base_spans(whole).alias("base"), _instances(whole).alias("instances"),
    )
    found = work.store(found, "found")
    joined = found.select("row", "key", "base").join(_added(found, work), "row", "left")
    spans = F.when(F.col("added").isNotNull(), F.array_sort(F.concat("base", "added"))).otherwise(F.col("base"))
    return joined.select(F.col("key").alias(key), "base", spans.alias("spans"))


def listed(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
