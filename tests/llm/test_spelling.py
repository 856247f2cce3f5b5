"""Spelling variants against plain loops over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from leadspark.llm import spelling
from leadspark.llm.shared import Workspace

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def plain_variants(counts):
    letters = sorted(set("".join(counts)))
    near = {w: {x for x in edits(w, letters) if x in counts and x != w} for w in counts}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, counts[w], len(near[w]), counts.get(forms[w])))
    return out


def rows_of(frame):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize(("page", "visitors"), [(1 << 14, 1 << 16), (40, 60), (3, 5)])
def test_near_words_on_pages_of_any_size(spark, page, visitors):
    random.seed(page)
    found = {"".join(random.choices("abcé", [4, 3, 2, 1], k=random.randint(6, 8))) for _ in range(700)}
    found |= {"a" * 90, "a" * 89, "a" * 89 + "b", "é" + "a" * 89, "aaaaaa", "aaaaaaa"}
    counts = {w: random.choice([5, 6, 30, 200]) for w in found}
    vocabulary = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    got = spelling.near_words(vocabulary, Workspace(spark, "test"), page, visitors).collect()
    want = {}
    for w in counts:
        near = {x for x in edits(w, "abcé") if x in counts and x != w}
        if near:
            best = min(near, key=lambda x: (-counts[x], x))
            want[w] = (len(near), -counts[best], best)
    assert {r["word"]: (r["n_near"], r["best"]["less"], r["best"]["form"]) for r in got} == want


def test_one_edit_is_the_plain_one():
    random.seed(1)
    for _ in range(2000):
        a = "".join(random.choices("ab", k=random.randint(0, 5)))
        b = "".join(random.choices("ab", k=random.randint(0, 5)))
        assert spelling.one_edit(a, b) == (a != b and b in set(edits(a, "ab")))


def test_variants_of_given_and_odd_texts(spark, docs, given, empty):
    chain = "abcdefgh " * 5 + "abcdefgx " * 25 + "abcdefyx " * 125 + "bbcdefyx " * 125
    tied = "Tiedword " * 25 + "tiedwore " * 25 + "tiedwor " * 5
    long = "q" * 3000 + " " + "q" * 2999
    odd = [(1, chain), (1, tied), (None, "nullid nullid nullid nullid nullid"), (2, f"{long} " * 5), (3, None), (4, "")]
    odd += [(5, "cafés×÷ ÉCOLESĀx " * 6), (5, "cafés×÷ " * 3)]
    frame = spark.createDataFrame([(*row, "w", 7) for row in odd], "doc_id long, text string, word string, n int")
    for each in (frame, docs, given("documents")):
        rows = [(r["doc_id"], r["text"]) for r in each.select("doc_id", "text").collect()]
        assert rows_of(spelling.variants(each)) == plain_variants(plain_words(rows))
    assert rows_of(spelling.variants(empty)) == set()
