"""Operators on texts against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadspark.llm import (
    html_text,
    line_dedup,
    mixing,
    packing,
    pii,
    quality_rules,
    queries,
    token_counts,
    toxicity,
)

SF = "/root/testdata/sf0.001"
RANKS, MODEL = queries.RANKS, queries.PIECES


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, s):
    digits = [int(c) for c in s if c.isdigit()]
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in s.split("."))
    if kind == "card":
        twice = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 14 <= len(digits) <= 19 and (sum(twice) + sum(digits[::-2])) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text or ""):
            if valid(kind, match.group()):
                found.append((match.start(), order, kind, match.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


TRICKY = [
    "a@b.c_d@e.f x@y z@q.r.s. 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3.4",
    "+1 (555) 123-4567 +1+12345678901 4111 1111 1111 1111 4111-1111-1111-1112",
    "é😀 u@v.w 😀 378282246310005 ... 10.0.0.1",
    "9" * 3000 + "." + "1." * 3000 + " " + "a" * 2000 + "@" + "b." * 3000 + "c",
]


def test_base_spans(spark, docs, given):
    tricky = spark.createDataFrame([(i, x) for i, x in enumerate(TRICKY)], "doc_id long, text string")
    for frame in (tricky, docs.select("doc_id", "text"), given("documents").select("doc_id", "text")):
        texts = Counter((r["doc_id"], ",".join(plain_spans(r["text"]))) for r in frame.collect())
        found = pii.find(frame).select("doc_id", pii.listed("base").alias("s")).collect()
        assert Counter((r["doc_id"], r["s"]) for r in found) == texts


def test_pii_query(spark):
    for row in queries.op2_pii(spark, SF).collect():
        assert row["n_email"] == row["spans"].count("email:") or row["n_email"] < row["spans"].count("email:")
        assert len(row["base_sha256"]) == 64
    none = hashlib.sha256(b"").hexdigest()
    assert none in {r["base_sha256"] for r in queries.op2_pii(spark, SF).select("base_sha256").collect()}


def test_patterns_discover_identifiers(spark):
    """Phones without a plus sign follow the words that phones with one follow."""
    rows = [(i, f"please call +1 555 000 {1000 + i} today, it is item {i} of {i + 3}") for i in range(30)]
    rows += [(100 + i, f"contact: member{i}@site{i}.example is the address, page {i}") for i in range(30)]
    rows += [(200, "contact: nobody7@localhost is the address, page 9"), (201, "room 12 and item 9 of 30")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["s"] for r in pii.find(frame).select("doc_id", pii.listed("spans").alias("s")).collect()}
    base = {i: ",".join(plain_spans(t)) for i, t in rows}
    assert found[200] == "email:9:26" and base[200] == ""
    assert {i for i in found if found[i] != base[i]} == {200}


def test_patterns_on_planted_identifiers(spark):
    """Each kind has a place of its own in the text; some identifiers there have no base
    form, and words elsewhere look like them."""
    import random

    random.seed(11)
    filler = ["la", "que", "de", "in", "the", "of", "nicht", "und", "was", "on"]
    number = lambda n: "".join(random.choices("0123456789", k=n))

    def words(n):
        return " ".join(random.choices(filler, k=n))

    rows, planted = [], {}
    for i in range(600):
        kind = ("email", "phone", "ip", "none")[i % 4]
        hidden = i % 5 == 0
        if kind == "email":
            lead, it = "write to", f"u{i}@intranet" if hidden else f"u{i}@mail{i}.example"
        elif kind == "phone":
            lead, it = "call us:", f"({number(3)}){number(7)}" if hidden else f"+{number(11)}"
        elif kind == "ip":
            lead, it = "logged from", f"fe80::{number(4)}:{number(2)}" if hidden else f"10.{i % 250}.3.{i % 99}"
        else:
            lead, it = words(2), random.choice(["@home", number(9), "12:30", f"item{i}", number(3)])
        text = f"{words(8)} {lead} {it} {words(6)} {number(2)} {words(3)}"
        rows.append((i, text))
        if hidden and kind != "none":
            at = text.index(it) + (it[0] == "(")
            planted[i] = (kind, at, text.index(it) + len(it))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in pii.find(frame).collect():
        added = {(x["kind"], x["start"], x["end"]) for x in r["spans"]} - {(x["kind"], x["start"], x["end"]) for x in r["base"]}
        if added:
            got[r["doc_id"]] = added
    right = sum(planted.get(i) in found for i, found in got.items())
    assert right / sum(map(len, got.values())) >= 0.95
    assert right / len(planted) >= 0.9


def test_patterns_of_two_kinds_are_not_trusted(spark):
    rows = [(i, f"see also +1555000{1000 + i} x") for i in range(20)] + [(50 + i, f"see also u{i}@m.example x") for i in range(20)]
    rows += [(90, "see also someone@home x"), (91, None), (92, "@"), (93, "9 " * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.find(frame).collect():
        assert r["spans"] == r["base"]


def test_pii_of_nothing(empty):
    assert pii.find(empty).count() == 0


# Token counts


def plain_count(word, vocabulary):
    best = [(0.0, 0)]
    for stop in range(1, len(word) + 1):
        ways = []
        for start in range(stop):
            score = vocabulary.scores.get(word[start:stop])
            if score is not None:
                ways.append((best[start][0] + score, best[start][1] - 1))
        if word[stop - 1] not in vocabulary.scores:
            size = len(word[stop - 1].encode())
            ways.append((best[stop - 1][0] + token_counts.BYTE_SCORE * size, best[stop - 1][1] - size))
        best.append(max(ways))
    return -best[-1][1]


def test_token_counts(docs, given, empty, monkeypatch):
    vocabulary = token_counts.Vocabulary(MODEL)
    for frame, share in ((docs, 10_000), (given("documents").limit(60), token_counts.TRIE_CHARS)):
        monkeypatch.setattr(token_counts, "TRIE_CHARS", share)
        known = {}
        want = []
        for row in frame.collect():
            words = token_counts.pretokens(row["text"])
            for word in words:
                if word not in known:
                    known[word] = plain_count(word, vocabulary)
            want.append((str(row["doc_id"]), len(words), sum(known[w] for w in words)))
        assert sorted((str(a), b, c) for a, b, c in token_counts.with_counts(frame, MODEL).collect()) == sorted(want)
    assert token_counts.with_counts(empty, MODEL).count() == 0


# HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>one</a></li><li><a href=/b>two</a></li></ul></nav>
<div class="ad">Buy more things now, really cheap</div><div id="sidebar">Popular posts here</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>   text<br>goes on.<p>Second &eacute; one
<aside>Related: other story</aside><form>Name <input></form><p>Third.<div class="comments"><p>I say no</p></div>
</article><footer>&copy; us</footer>"""


def test_main_text():
    weights = html_text.weights(html_text.counts(PAGE))
    wanted = "Title & more\nFirst bold text goes on.\nSecond é one\nThird."
    assert html_text.extract(PAGE, weights) == wanted
    assert html_text.extract(PAGE, html_text.Weights()) == wanted
    assert html_text.extract(None, weights) == html_text.extract("<p></p>", weights) == ""


def test_pages_without_marks_use_weights_learned_from_others():
    weights = html_text.weights(html_text.counts(PAGE))
    body = "".join(f"<p>Paragraph {i} with quite a few words in it.</p>" for i in range(8))
    page = f"<body><div class='menu'>a b c</div><div class=content>{body}</div><div class='footer'>x y</div></body>"
    assert html_text.extract(page, weights).count("Paragraph") == 8
    assert "a b c" not in html_text.extract(page, weights) and "x y" not in html_text.extract(page, weights)


LINE = "Some long words of the article stand here and go on"

ODD_PAGES = {
    "head without end tag": (f"<html><head><title>x</title><body><p>{LINE}</p></body></html>", LINE),
    "head ended by a paragraph": (f"<html><head><title>x</title><p>{LINE}</p>", LINE),
    "head ended by text": (f"<head><meta charset=utf-8>{LINE}", LINE),
    "quote in a plain value": (f"<p title=it's>{LINE}</p><p>{LINE} isn't</p>", f"{LINE}\n{LINE} isn't"),
    "quote that nothing closes": (f'<p title="open>{LINE}</p><p>{LINE}</p>', f"{LINE}\n{LINE}"),
    "greater sign in a value": (f'<p title="a > b">{LINE}</p>', LINE),
    "part of a class name": (f'<div class="content no-sidebar"><p>{LINE}</p></div>', LINE),
    "words of an article": (
        f'<article><p class="share-price">{LINE}</p><div id="related-work">{LINE}</div></article>',
        f"{LINE}\n{LINE}",
    ),
    "composed names": (f'<div class="site-nav">a b</div><p>{LINE}</p><div class="comment-list">{LINE} bad</div>', LINE),
    "nav never closed, article": (f"<body><nav><ul><li>a<li>b</ul><article><p>{LINE}</p></article></body>", LINE),
    "nav never closed, paragraphs": (f"<body><nav><a href=x>a</a><p>{LINE}</p><p>{LINE}</p>", f"{LINE}\n{LINE}"),
    "sidebar never closed": (f'<div class="sidebar">x y<h1>A title of words</h1><p>{LINE}</p>', f"A title of words\n{LINE}"),
    "nav ended by its parent": (f"<div><nav><a>x</a></div><p>{LINE}</p>", LINE),
    "footer never closed": (f"<article><p>{LINE}</p></article><footer><p>{LINE} bad</p></body>", LINE),
    "comments": (f"<p>{LINE}<!-- <p>bad --> on<!--> x<!-- bad", f"{LINE} on x"),
    "signs that are no tags": (f"<p>1 < 2 &lt;b&gt; {LINE}</p>", f"1 < 2 <b> {LINE}"),
    "same attribute twice": (f'<div class="text" class="ad"><p>{LINE}</p></div>', LINE),
}


@pytest.mark.parametrize("name", list(ODD_PAGES))
def test_odd_markup(name):
    page, wanted = ODD_PAGES[name]
    assert html_text.extract(page, html_text.Weights()) == wanted


def test_class_words_are_learned():
    told = Counter()
    for i in range(60):
        told.update(html_text.counts(
            f'<body class="all"><div class="wrap"><div class="zork">Buy {i}</div>'
            f'<main class="story"><p class="lead zork{i}">{LINE}</p></main></div></body>'
        ))
    weights = html_text.weights(told)
    assert weights.outside(("zork",)) and not weights.outside(("zork", "wrap"))
    assert not any(weights.outside((x,)) for x in ("wrap", "lead", "zork1", "unknown", "all", "story"))
    page = f'<div class="wrap"><div class="zork">{LINE} bad</div><p>{LINE}</p></div>'
    assert html_text.extract(page, weights) == LINE
    assert html_text.extract(page, html_text.Weights()) != LINE


@pytest.mark.parametrize("part", ["<", "<a ", "</a", "<div>", "<p><i>", "<a x='", "<nav><div>", "<!", "<a b", "<li><nav>"])
def test_time_grows_with_broken_pages(part):
    import time

    started = time.perf_counter()
    html_text.extract(part * 20_000, html_text.Weights())
    html_text.extract("<span>" * 20_000 + part * 20_000 + "</b>" * 20_000, html_text.Weights())
    assert time.perf_counter() - started < 20


def test_region_is_the_best_one():
    random = np.random.default_rng(1)
    for _ in range(200):
        kinds = random.choice(["p", "li", "td", ""], 12)
        found = [html_text.Piece(name=k, kind=k, text="" if k else "w " * int(random.integers(1, 4))) for k in kinds]
        scores = html_text.Weights(0.5, {"p": -0.4, "li": -1.3, "td": -2.0})
        value = [scores.of(x) if x.name else 0.5 * len(x.text.split()) for x in found]
        best = max((sum(value[a:b]) for a in range(12) for b in range(a, 13)), default=0.0)
        start, stop = html_text._region(found, scores)
        assert sum(value[start:stop]) == pytest.approx(best)


def test_html_query(spark, given):
    import html

    pages = {r["page_id"]: r["html"] for r in given("pages").collect()}
    for row in queries.op4_html_text(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.DOTALL).group(1)
        blocks = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [" ".join(html.unescape(x).split()) for x in blocks]
        assert row["text"] == "\n".join(x for x in blocks if x)
        assert row["n_chars"] == len(row["text"])


def test_html_of_odd_pages(spark):
    rows = [(1, None), (2, ""), (None, "<p>a b c</p>"), (2, ""), (4, "<" * 3000 + '<a b="' * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("x"))
    texts = html_text.with_text(pages, html_text.fit(pages)).collect()
    assert sorted(r["text"] for r in texts)[:3] == ["", "", ""] and len(texts) == 5
    assert html_text.with_text(pages.limit(0), html_text.Weights()).count() == 0


# Packing


def test_ids_are_those_of_the_tokenizer(docs, given):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    encoder = packing.Encoder(RANKS)
    texts = [r["text"] or "" for f in (docs, given("documents")) for r in f.select("text").collect()]
    texts += ["a  b", " a", "a ", "\n x", "a \n b    c", "x  y", "don't  won't 'll", "<|endoftext|> é 12²½ ", "  "]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, size):
    """Space left in each sequence, one length after the other."""
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, x in enumerate(left) if x >= length]
        if fits:
            at = min(fits, key=lambda i: left[i])
            left[at] -= length
        else:
            left.append(size - length)
    return left


def test_plan_is_best_fit():
    random = np.random.default_rng(2)
    for _ in range(200):
        size = int(random.integers(5, 40))
        lengths = random.integers(1, size + 1, int(random.integers(1, 120))).tolist()
        used = Counter()
        for length, first, until, sequence, each, offset in packing.plan(Counter(lengths), size):
            for nth in range(until - first):
                used[sequence + nth // each] += length
                assert offset + (nth % each + 1) * length <= size
        assert sorted(used.values()) == sorted(size - x for x in plain_best_fit(lengths, size))


def test_packed_pieces(docs, empty, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 3)
    pieces = packing.pieces(docs, RANKS, size=64)
    placed = packing.pack(pieces, size=64).collect()
    assert len(placed) == pieces.count()
    by_sequence = {}
    for row in placed:
        assert len(row["ids"]) == 4 * row["length"]
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    long = sorted((r["piece"], r["start"], r["length"]) for r in placed if r["doc_id"] == 7)
    assert [length for _, _, length in long[1:]] == [64] * (len(long) - 1)
    assert len(by_sequence) == len(plain_best_fit([r["length"] for r in placed], 64))
    whole = b"".join(r["ids"] for r in sorted((r for r in placed if r["doc_id"] == 7), key=lambda r: r["piece"]))
    text = docs.where("doc_id = 7").first()["text"]
    assert zlib.crc32(whole) == zlib.crc32(packing.Encoder(RANKS).encode(text) + bytes(4))
    assert packing.pack(packing.pieces(empty, RANKS)).count() == 0


# Toxicity


def test_cumulative_link_learns_order():
    random = np.random.default_rng(4)
    grades = np.repeat([0, 1, 2], 100)
    rows, cols, values = [], [], []
    for i, grade in enumerate(grades):
        for col, chance in ((0, 0.1 + 0.4 * grade), (1, 0.5)):
            if random.random() < chance:
                rows.append(i)
                cols.append(col)
                values.append(1.0)
    weights, cuts = toxicity.fit_cumulative(np.array(rows), np.array(cols), np.array(values), grades, 2)
    assert weights[0] > 1 and abs(weights[1]) < 0.7 and cuts[0] < cuts[1]


def test_toxicity_on_held_out_labels(spark, given):
    docs, labels = given("documents"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = labels.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(3)))
    model = toxicity.fit_labels(docs, labels.where("fold > 0"))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    told = toxicity.with_severity(docs.join(labels.where("fold = 0"), "doc_id"), model).select("toxic", "severity").toPandas()
    found = told["severity"] >= toxicity.REJECT
    assert found[told["toxic"] == 1].mean() > 0.85
    assert found[told["toxic"] == 0].mean() < 0.005


def test_toxicity_of_odd_texts(docs, empty, given):
    labels = given("labels")
    scored = toxicity.with_severity(docs, toxicity.fit_labels(docs, labels.limit(0)))
    assert {r["severity"] for r in scored.collect()} == {0.0}
    assert toxicity.with_severity(empty, toxicity.Model({"x": 1.0}, [0.0])).count() == 0
    model = toxicity.Model({"one": 1.0}, [0.0, 1.0])
    by_text = {r["text"]: r["severity"] for r in toxicity.with_severity(docs, model).collect()}
    assert by_text[None] == by_text[""] < by_text["one"] == pytest.approx(by_text["one two"])


# Line deduplication


def plain_lines(docs, min_words):
    """Lines left of each document: every run is compared with all places before it."""
    kept = [[(n, line.strip(" \t\r\x0b\f")) for n, line in enumerate((text or "").split("\n"))] for _, text in docs]
    sequences = [[(n, line) for n, line in lines if line] for lines in kept]
    places = [(d, i) for d, lines in enumerate(sequences) for i in range(len(lines))]
    gone = [set() for _ in docs]
    for at, (d, i) in enumerate(places):
        longest = 0
        for e, j in places[:at]:
            size = 0
            while (
                i + size < len(sequences[d])
                and j + size < len(sequences[e])
                and sequences[d][i + size][1] == sequences[e][j + size][1]
            ):
                size += 1
            longest = max(longest, size)
        if sum(len(line.split()) for _, line in sequences[d][i : i + longest]) >= min_words:
            gone[d].update(range(i, i + longest))
    left = []
    for (_, text), lines, cut in zip(docs, sequences, gone, strict=True):
        numbers = {lines[i][0] for i in cut}
        for i in cut:
            if i - 1 in cut:
                numbers.update(range(lines[i - 1][0] + 1, lines[i][0]))
        if text is None:
            left.append(None)
        else:
            left.append("\n".join(x for n, x in enumerate(text.split("\n")) if n not in numbers))
    return left


@pytest.mark.parametrize("min_words", [1, 3, 5])
def test_runs_of_random_lines(spark, min_words):
    random = np.random.default_rng(min_words)
    texts = []
    for _ in range(40):
        lines = random.choice(["a", "b", "c d", "", "e f g", " a "], int(random.integers(0, 14)))
        texts.append("\n".join(lines))
    texts += texts[:5]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(frame, min_words).collect()}
    assert [got[i] for i, _ in rows] == plain_lines(rows, min_words)


def test_lines_of_given_and_odd_documents(docs, given, empty):
    for frame in (docs.where("doc_id IS NOT NULL"), given("documents")):
        frame = frame.dropDuplicates(["doc_id"])
        rows = sorted((r["doc_id"], r["text"]) for r in frame.where("text IS NOT NULL").collect())
        got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(frame).collect()}
        assert [got[i] for i, _ in rows] == plain_lines(rows, line_dedup.MIN_WORDS)
    result = line_dedup.deduplicate(docs)
    assert result.columns == [*docs.columns, "n_deleted"] and result.count() == docs.count()
    repeated = sorted(r["text"] for r in result.where("doc_id IN (1, 2)").collect())
    assert repeated[:2] == ["", ""] and repeated[2].startswith("alpha")
    assert line_dedup.deduplicate(docs, drop_emptied=True).where("doc_id IN (1, 2, 4, 5)").count() == 3
    assert line_dedup.deduplicate(empty).count() == 0


# Quality rules


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_statistics(spark, docs, given):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    repeats = spark.createDataFrame([(1, "a b c d e f a b c d e x y a b c d e f"), (2, "a " * 300)], "doc_id long, text string")
    for frame in (repeats, docs, given("documents")):
        for row in quality_rules.with_statistics(frame).collect():
            assert tuple(row[x] for x in names) == plain_statistics(row["text"])


def test_decision_list_finds_the_rule():
    random = np.random.default_rng(6)
    data = {"a": random.random(600), "b": random.random(600), "c": random.random(600)}
    bad = ((data["a"] > 0.7) & (data["b"] < 0.5)) | (data["c"] > 0.95)
    rules = quality_rules.learn(data, bad, np.arange(600) % 3 == 0)
    found = np.zeros(600, bool)
    for rule in rules:
        found |= quality_rules._covered(rule, data, 600)
    assert (found == bad).mean() > 0.97


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality_rules.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    counts = {(r["quality"], r["kept"]): r["n"] for r in judged.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert counts.get((0, False), 0) > 0.9 * (counts.get((0, False), 0) + counts.get((0, True), 0))
    assert counts.get((1, False), 0) < 0.05 * counts[1, True]


def test_quality_of_odd_texts(docs, empty, given):
    judged = quality_rules.judge(docs.withColumn("quality", F.lit(1)), given("labels").limit(0))
    assert judged.count() == docs.count()
    assert not judged.where("text IS NULL").first()["kept"]
    assert quality_rules.judge(empty, given("labels")).count() == 0


# Mixing


def test_counts_follow_the_distribution(spark):
    rows = [(i, f"t{i}", "big" if i % 4 else "small") for i in range(8000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("x"))
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("none", 1.0)], "source string, weight double")
    made = mixing.mix(frame, weights).groupBy("source").agg(F.count("*").alias("n"), F.max("copy_no").alias("m")).collect()
    for row in made:
        assert abs(row["n"] - 4000) < 250
    same = [mixing.mix(frame, weights).select("doc_id", "copy_no").orderBy("doc_id", "copy_no").collect() for _ in range(2)]
    assert same[0] == same[1]


def test_distribution(spark):
    from math import exp, factorial

    rates = spark.createDataFrame([(0.01,), (1.0,), (7.5,), (900.0,)], "rate double")
    for row in rates.select("rate", mixing.distribution(F.col("rate")).alias("p")).collect():
        assert row["p"][-1] == pytest.approx(1.0)
        if row["rate"] < 10:
            for k in range(6):
                want = sum(exp(-row["rate"]) * row["rate"] ** j / factorial(j) for j in range(k + 1))
                assert row["p"][k] == pytest.approx(want)


def test_mixing_of_odd_rows(docs, empty):
    mixed = mixing.mix(docs, share=4.0)
    assert set(docs.columns) < set(mixed.columns)
    assert mixed.where("source IS NULL").count() > 0
    assert mixed.groupBy("shuffle_key").count().where("count > 2").count() == 0
    assert mixing.mix(empty).count() == 0
