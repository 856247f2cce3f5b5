"""Quality rules as a decision list learned by sequential covering.

Statistics of each text come from column expressions. From labelled statistics one rule
after the other is grown, a conjunction of thresholds that covers bad texts and few good
ones, then pruned on texts held out of growing; texts it covers are set aside, and the next
rule is grown on the rest. The ordered list becomes one CASE expression in Spark: the first
rule that holds rejects the text, and texts that none covers are kept.

Edge cases: NULL and empty texts have no words, and all statistics are 0; they fail the base
rule of ten words. With no labels, or only one kind, the list is empty and only the base
rules decide. Repeated rows are judged alike, and one of them is learned from; whole texts
count, however long. Input columns named as the results are replaced, all others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace, one_text_each, unused

WINDOW_WORDS = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Labelled texts used for learning: those with the smallest hashes of their doc_id.
SAMPLE = 20_000
HELD_OUT = 3  # every third labelled text is for pruning
CONDITIONS = 4
RULES = 12
#: A rule must be right on at least this share of what it covers, in growing and pruning.
PRECISION = 0.9
#: and cover at least this many bad texts.
COVER = 8
CUTS = 64

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks", "n_bars",
)
#: Statistics that rules may look at: name -> expression over the counted columns.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "bar_share": "n_bars / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


def _held(value: Column, then) -> Column:
    """then(value) with the value computed once: a lambda names it."""
    return F.transform(F.array(value), then)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words found twice or more in the text."""
    number = F.size(words) - WINDOW_WORDS + 1
    marks = F.transform(
        F.sequence(F.lit(0), number - 1),
        lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW_WORDS))),
    )

    def counted(sorted_marks: Column) -> Column:
        last = F.size(sorted_marks) - 1
        same = F.filter(
            sorted_marks,
            lambda x, i: ((i > 0) & (F.get(sorted_marks, i - 1)["m"] == x["m"]))
            | ((i < last) & (F.get(sorted_marks, i + 1)["m"] == x["m"])),
        )
        places = F.array_sort(F.transform(same, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW_WORDS).alias("at"))
        return F.aggregate(
            places,
            start,
            lambda s, i: F.struct(
                (s["n"] + F.least(F.lit(WINDOW_WORDS), i - s["at"])).cast("int").alias("n"), i.alias("at")
            ),
            lambda s: s["n"],
        )

    def unless_different(found: Column) -> Column:
        pairs = F.transform(found, lambda x, i: F.struct(x.alias("m"), i.alias("i")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(
            _held(F.sort_array(pairs), counted)
        )

    return F.when(number < 2, 0).otherwise(_held(marks, unless_different))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with counts of words, characters, symbols, lines and repeats (long)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, SPACE), lambda x: x != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def left(chars: str) -> Column:
        return F.length(whole) - F.length(F.translate(whole, chars, ""))

    by_words = _held(
        words,
        lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")),
    )
    by_lines = _held(
        lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    )
    w, x = unused([*docs.columns, *COUNTS], "_w", "_l")
    counted = docs.withColumn(w, by_words).withColumn(x, by_lines)
    counts = {
        "n_words": F.col(f"{w}.n"),
        "word_chars": F.length(F.translate(whole, " \t\n\x0b\f\r", "")),
        "n_symbols": left(SYMBOLS),
        "n_dup_lines": F.col(f"{x}.dup"),
        "n_repeat_words": F.col(f"{w}.repeat"),
        "n_lines": F.col(f"{x}.n"),
        "n_capitals": left("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_marks": left("!?"),
        "n_bars": left("|"),
    }
    return counted.withColumns({k: v.cast("long") for k, v in counts.items()}).drop(w, x)


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.cut if self.above else values <= self.cut

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.cut if self.above else value <= self.cut


Rule = tuple[Condition, ...]


def _covered(rule: Rule, data: dict[str, np.ndarray], size: int) -> np.ndarray:
    here = np.ones(size, bool)
    for condition in rule:
        here &= condition.holds(data[condition.feature])
    return here


def _grown(data: dict[str, np.ndarray], bad: np.ndarray, left: np.ndarray) -> Rule:
    """Conditions added one by one, each with the largest gain of information."""
    rule: Rule = ()
    here = left.copy()
    while len(rule) < CONDITIONS:
        p, n = (here & bad).sum(), (here & ~bad).sum()
        if not p or not n:
            break
        base, best = np.log2(p / (p + n)), (0.0, None, None)
        for feature, values in data.items():
            for cut in np.unique(np.quantile(values[here & bad], np.linspace(0, 1, CUTS))):
                for above in (True, False):
                    condition = Condition(feature, above, float(cut))
                    then = here & condition.holds(values)
                    q, m = (then & bad).sum(), (then & ~bad).sum()
                    gain = q * (np.log2(q / (q + m)) - base) if q else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, condition, then)
        if best[1] is None:
            break
        rule, here = (*rule, best[1]), best[2]
    return rule


def _pruned(rule: Rule, data: dict[str, np.ndarray], bad: np.ndarray, left: np.ndarray) -> Rule:
    """The beginning of the rule that is worth most on held-out texts."""

    def worth(part: Rule) -> float:
        here = _covered(part, data, len(bad)) & left
        p, n = (here & bad).sum(), (here & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    parts = [rule[:size] for size in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (round(worth(part), 6), len(part)))


def learn(data: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray) -> list[Rule]:
    """Ordered rules that cover bad texts."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < RULES and (left & ~held & bad).sum() >= COVER:
        rule = _grown(data, bad, left & ~held)
        if not rule:
            break
        rule = _pruned(rule, data, bad, left & held)
        here = _covered(rule, data, len(bad)) & left
        right = [(here & part & bad).sum() / max((here & part).sum(), 1) for part in (held, ~held)]
        if min(right) < PRECISION or (here & bad).sum() < COVER:
            break
        rules.append(rule)
        left &= ~here
    return rules


def fit(docs: DataFrame, labels: DataFrame, number: int = SAMPLE) -> list[Rule]:
    """Rules from labels (doc_id, quality 0 or 1), on at most `number` labelled texts, of
    which those that pass the base rules are learned from. A document with several labels
    takes the lower one."""
    work = Workspace(docs.sparkSession, "quality")
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(number)
    known = work.store(known, "known")
    # Written once, so that neither the base rules nor the features count the words again.
    stats = with_statistics(one_text_each(docs, known)).select("doc_id", *COUNTS)
    stats = work.store(stats, "sample").join(F.broadcast(known), "doc_id")  # `number` rows of two numbers
    columns = [F.expr(x).cast("double").alias(name) for name, x in FEATURES.items()]
    rows = stats.where(~base_failed()).select("doc_id", F.xxhash64("doc_id").alias("mark"), "quality", *columns)
    found = sorted(rows.collect(), key=lambda row: (row["mark"], row["doc_id"]))  # `number` rows of numbers
    work.keep()
    if not found:
        return []
    data = {name: np.array([row[name] for row in found]) for name in FEATURES}
    bad = np.array([row["quality"] == 0 for row in found])
    held = np.array([row["mark"] % HELD_OUT == 0 for row in found])
    return learn(data, bad, held)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1 (NULL: none, the text is kept)."""
    found = F.lit(None).cast("int")
    for number in range(len(rules), 0, -1):
        holds = F.lit(True)
        for condition in rules[number - 1]:
            holds &= condition.column()
        found = F.when(holds, number).otherwise(found)
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with statistics, base_failed, rule (the one that rejects) and kept."""
    rules = fit(docs, labels)
    stats = with_statistics(docs).withColumn("base_failed", base_failed())
    stats = stats.withColumn("rule", verdict(rules))
    return stats.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
