"""Spelling variants: words one edit apart, found by a trie of letter-group counts.

A word is a vector of counts, one for each group of letters, common letters first. Words
with equal first counts share a node of the frequency-vector trie. One inserted code point
is a surplus of one in some group, a deleted one a deficit, a replaced one both or, within
a group, neither. So a search goes down the trie depth first with a budget of one surplus
and one deficit, and what it meets in the leaves is verified, code point by code point.

A pair is found from one side only: the first group in which two words differ must be a
surplus of what is searched for, and equal vectors are compared in one order. Both words
are told.

Spark goes down the upper levels as tables of words on their way, until a node holds at most
PAGE words; below, a page is one task's trie, kept as arrays. A page with many visitors, or
one that is full at the last level, is cut into parts that all pairs of parts meet in. A
task puts out counts and the best near word for each word, never its pairs.

Edge cases: NULL and empty texts have no words; a NULL doc_id hashes as an empty one; a
repeated row counts again; words of any length are compared; among near words equally
common the smallest in code-point order is the form; an empty table gives no rows. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.llm.shared import Workspace
from leadspark.operators.joins import split_left_join

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 199
LENGTH = 6
OCCURRENCES = 5
FACTOR = 5

#: Groups of letters: the most common letters alone, the others dealt to the last SHARED.
GROUPS = 18
SHARED = 6
#: Words that a page of the trie holds, and words that visit one part of it, at most.
PAGE = 1 << 14
VISITORS = 1 << 16
#: Searches under way, and pairs verified, at once in a task.
FRONT = 1 << 18
#: Longer words are verified one by one and not as rows of an array.
WIDTH = 64


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words after the slips, with at least OCCURRENCES occurrences.

    Runs too short to be words are passed over by the pattern: a slip only shortens.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{LENGTH},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    each = each.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    each = each.select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = each.where(F.length("word") >= LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def letter_groups(vocabulary: DataFrame, groups: int = GROUPS, shared: int = SHARED) -> list[str]:
    """Letters by group, common ones first. There are no more letters than RUN names."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    counts = letters.groupBy("letter").agg(F.count("*").alias("n")).collect()
    ordered = [row["letter"] for row in sorted(counts, key=lambda row: (-row["n"], row["letter"]))]
    alone = ordered[: groups - shared]
    rest = ordered[groups - shared :]
    return alone + ["".join(rest[at::shared]) for at in range(shared) if rest[at::shared]]


def _group_count(word: Column, letters: str) -> Column:
    return F.length(word) - F.length(F.translate(word, letters, ""))


def _visits(vocabulary: DataFrame, groups: list[str], page: int, work: Workspace) -> list[DataFrame]:
    """(page, word, n, used, members, depth): words at the pages that they search.

    `used` is 0 without a difference so far, 1 after a surplus, 2 after a deficit too. A
    word with `used` 0 is a member of the page as well, of which there are `members`.
    """
    total = vocabulary.count()
    at = vocabulary.select(F.lit("").alias("page"), "word", "n", F.lit(0).alias("used"))
    at = at.withColumns({"members": F.lit(total), "depth": F.lit(0)})
    done, depth = [], 0
    while True:
        last = depth == len(groups)
        done.append(at if last else at.where(F.col("members") <= page))
        big = at.where(F.col("members") > page)
        if last or big.isEmpty():
            return done
        count = _group_count(F.col("word"), groups[depth])
        steps = F.array(
            F.struct(count.alias("x"), F.col("used").alias("used")),
            F.when(F.col("used") == 0, F.struct((count + 1).alias("x"), F.lit(1).alias("used"))),
            F.when((F.col("used") == 1) & (count > 0), F.struct((count - 1).alias("x"), F.lit(2).alias("used"))),
        )
        onward = big.select("page", "word", "n", F.inline(F.array_compact(steps)))
        onward = onward.select(F.concat_ws(".", "page", "x").alias("page"), "word", "n", "used")
        nodes = onward.where("used = 0").groupBy("page").agg(F.count("*").alias("members"))
        nodes = work.store(nodes, f"nodes-{depth}")
        depth += 1
        met = split_left_join(onward, nodes, ["page"]).where("members IS NOT NULL")
        at = work.store(met.withColumn("depth", F.lit(depth)), f"level-{depth}")


def _parted(visits: DataFrame, page: int, visitors: int, work: Workspace) -> DataFrame:
    """Visits and members with the part of the page where they meet."""
    sizes = visits.groupBy("page").agg(F.count("*").alias("all"), F.max("members").alias("members"))
    sizes = sizes.select(
        "page",
        F.ceil(F.col("members") / page).cast("int").alias("m_parts"),
        F.ceil(F.col("all") / visitors).cast("int").alias("v_parts"),
    )
    known = split_left_join(visits.drop("members"), work.store(sizes, "pages"), ["page"])
    mark = F.xxhash64("word")
    m, v = F.pmod(mark, "m_parts").cast("int"), F.pmod(F.shiftright(mark, 20), "v_parts").cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    kept = ["page", "depth", "word", "n", "used"]
    asking = known.select(*kept, F.lit(False).alias("member"), v.alias("v"), F.explode(upto("m_parts")).alias("m"))
    members = known.where("used = 0")
    members = members.select(*kept, F.lit(True).alias("member"), m.alias("m"), F.explode(upto("v_parts")).alias("v"))
    return asking.unionByName(members)


def _codes(found: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(x.encode("latin-1"), np.uint8) for x in found]


def _vectors(codes: list[np.ndarray], groups: list[str]) -> np.ndarray:
    """A row of counts for each word."""
    group_of = np.zeros(256, np.int64)
    for number, letters in enumerate(groups):
        group_of[np.frombuffer(letters.encode("latin-1"), np.uint8)] = number
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    which = np.repeat(np.arange(len(codes)), sizes)
    at = which * len(groups) + group_of[np.concatenate(codes)]
    return np.bincount(at, minlength=len(codes) * len(groups)).reshape(len(codes), len(groups))


def _matrix(codes: list[np.ndarray]) -> np.ndarray:
    """Codes as rows of equal width, zeros behind; of long words only that they are long."""
    width = min(WIDTH, max(map(len, codes), default=0)) + 1
    out = np.zeros((len(codes), width), np.uint8)
    for row, code in zip(out, codes, strict=True):
        if len(code) < width:
            row[: len(code)] = code
    return out


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[head + (len(a) == len(b)) :] == b[head + 1 :]


def _near_rows(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Rows in which the words of two arrays are one edit apart."""
    out = np.zeros(len(a), bool)
    same = size_a == size_b
    out[same] = (a[same] != b[same]).sum(axis=1) == 1
    for long, short, apart in ((a, b, size_a - size_b), (b, a, size_b - size_a)):
        rows = np.flatnonzero(apart == 1)
        big, small = long[rows], short[rows]
        head = np.argmax(big != small, axis=1)
        behind = np.arange(big.shape[1] - 1)[None, :] < head[:, None]
        out[rows] = ((big[:, 1:] == small[:, :-1]) | behind).all(axis=1)
    return out


class Trie:
    """Words below one node, in the order of their counts from `depth` on.

    A level has the sorted marks of its nodes: the parent's number and the count.
    """

    def __init__(self, vectors: np.ndarray, depth: int):
        self.order = np.lexsort(vectors.T[::-1])
        rows = vectors[self.order]
        self.span = int(vectors.max(initial=0)) + 3
        self.levels = []
        node = np.zeros(len(rows), np.int64)
        for at in range(depth, vectors.shape[1]):
            mark = node * self.span + rows[:, at]
            marks, node = np.unique(mark, return_inverse=True)
            self.levels.append(marks)
        self.ends = np.searchsorted(node, np.arange(node.max(initial=0) + 2))

    def search(self, vectors: np.ndarray, used: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(row of `vectors`, place in self.order, used): what each search meets in leaves."""
        rows = np.arange(len(vectors))
        stack = [(0, rows, np.zeros(len(rows), np.int64), used.astype(np.int8))]
        while stack:
            level, row, node, spent = stack.pop()
            if not len(row):
                continue
            if len(row) > FRONT:
                half = len(row) // 2
                stack += [(level, row[:half], node[:half], spent[:half]), (level, row[half:], node[half:], spent[half:])]
                continue
            if level == len(self.levels):
                yield from self._leaves(row, node, spent)
                continue
            count = vectors[row, depth + level]
            marks = self.levels[level]
            found = []
            for step, more, may in ((0, 0, spent >= 0), (1, 1, spent == 0), (-1, 1, (spent == 1) & (count > 0))):
                wanted = node[may] * self.span + np.minimum(count[may] + step, self.span - 1)
                place = np.minimum(np.searchsorted(marks, wanted), len(marks) - 1)
                there = marks[place] == wanted
                found.append((row[may][there], place[there], spent[may][there] + more))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*found, strict=True))))

    def _leaves(self, row: np.ndarray, node: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        first, number = self.ends[node], self.ends[node + 1] - self.ends[node]
        until = np.cumsum(number)
        at = 0
        while at < len(row):
            end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + FRONT, side="right")))
            n = number[at:end]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(row[at:end], n), self.order[np.repeat(first[at:end], n) + within], np.repeat(spent[at:end], n)
            at = end


def _told(found: list[str], n: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(word, n_near, form_n, form): for each word with near ones their number and the best."""
    a = np.concatenate([x for x, _ in pairs] or [np.empty(0, np.int64)])
    b = np.concatenate([x for _, x in pairs] or [np.empty(0, np.int64)])
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(found), np.int64)
    rank[sorted(range(len(found)), key=found.__getitem__)] = np.arange(len(found))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    number = np.diff(np.append(first, len(a)))
    word, form = (pd.Series([found[i] for i in x[first]], dtype=object) for x in (a, b))
    return pd.DataFrame({"word": word, "n_near": number, "form_n": n[b[first]], "form": form})


def page_pairs(rows: pd.DataFrame, groups: list[str]) -> pd.DataFrame:
    """What the visitors of one part of a page find among its members, told for both."""
    found, at = np.unique(rows["word"].to_numpy(object), return_inverse=True)
    found = found.tolist()
    n = np.zeros(len(found), np.int64)
    n[at] = rows["n"].to_numpy(np.int64)
    member = rows["member"].to_numpy(bool)
    members, asking = at[member], at[~member]
    if not len(members) or not len(asking):
        return _told(found, n, [])
    depth = int(rows["depth"].iloc[0])
    codes = _codes(found)
    vectors, matrix = _vectors(codes, groups), _matrix(codes)
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    trie = Trie(vectors[members], depth)
    pairs = []
    for row, place, spent in trie.search(vectors[asking], rows["used"].to_numpy()[~member], depth):
        a, b = asking[row], members[place]
        # Equal vectors meet from both sides; `found` is in code-point order.
        once = (spent > 0) | (a < b)
        a, b = a[once], b[once]
        near = _near_rows(matrix[a], matrix[b], sizes[a], sizes[b])
        long = np.flatnonzero((sizes[a] > WIDTH) | (sizes[b] > WIDTH))
        near[long] = [one_edit(found[i], found[j]) for i, j in zip(a[long], b[long], strict=True)]
        pairs.append((a[near], b[near]))
    return _told(found, n, pairs)


def near_words(vocabulary: DataFrame, work: Workspace, page: int = PAGE, visitors: int = VISITORS) -> DataFrame:
    """(word, n_near, best): number of near words and the best (-n, word) of them."""
    groups = letter_groups(vocabulary)
    schema = "word string, n_near long, form_n long, form string"
    if not groups:
        groups = ["a"]
    visits = _visits(vocabulary, groups, page, work)
    every = visits[0]
    for more in visits[1:]:
        every = every.unionByName(more)
    parts = _parted(every, page, visitors, work)
    told = parts.groupBy("page", "m", "v").applyInPandas(lambda rows: page_pairs(rows, groups), schema)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return told.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def _roots(links: DataFrame, work: Workspace) -> DataFrame:
    """(word, root): the ends of chains of forms. Steps double, so rounds are few."""
    at, turn = work.store(links.select("word", F.col("form").alias("root")), "links-0"), 0
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        told = split_left_join(at, onward, ["root"])
        turn += 1
        new = told.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = work.store(new, f"links-{turn}")
        work.drop(f"links-{turn - 1}")
        at = new.select("word", "root")
        if new.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word with the word it is a variant of."""
    work = Workspace(docs.sparkSession, "spelling")
    vocabulary = work.store(words(docs, key, text), "words")
    near = near_words(vocabulary, work)
    told = split_left_join(vocabulary, near, ["word"])
    common = -F.col("best.less") >= FACTOR * F.col("n")
    told = told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    )
    told = work.store(told, "told")
    roots = _roots(told.where("form IS NOT NULL").select("word", "form"), work)
    whole = split_left_join(told, roots, ["word"])
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
