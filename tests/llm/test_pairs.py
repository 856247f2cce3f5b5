"""SimHash, components and nearest neighbours against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from leadspark.llm import ann, simhash
from leadspark.llm.components import components
from leadspark.llm.shared import Workspace


def plain_fingerprint(text, words=3):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        found = found.replace(blank, " ")
    found = [x for x in found.split(" ") if x]
    if not found:
        return 0
    shingles = [found[i : i + words] for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(nodes, linked):
    """Smallest member of the group of each node, by walking the links."""
    found = {}
    for node in sorted(nodes):
        if node not in found:
            todo = [node]
            while todo:
                at = todo.pop()
                if at not in found:
                    found[at] = node
                    todo += [x for x in nodes if linked(at, x)]
    return found


def test_fingerprint_is_the_plain_one(docs, given):
    for frame in (docs, given("documents").limit(40)):
        rows = frame.select("text", simhash.fingerprint("text").alias("fp")).collect()
        assert [r["fp"] % 2**64 for r in rows] == [plain_fingerprint(r["text"]) for r in rows]


def test_components_of_documents(docs, given):
    given_docs = given("documents").select("doc_id", "text")
    for frame in (docs.select("doc_id", "text"), given_docs):
        rows = frame.collect()
        prints = [plain_fingerprint(r["text"]) for r in rows]
        near = grouped(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
        least = {}
        for row, fp in zip(rows, prints, strict=True):
            if row["doc_id"] is not None:
                least[near[fp]] = min(least.get(near[fp], row["doc_id"]), row["doc_id"])
        want = sorted((str(r["doc_id"]), least.get(near[fp])) for r, fp in zip(rows, prints, strict=True))
        got = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.near_duplicates(frame).collect())
        assert got == want


def test_trie_join_over_many_node_pairs(spark, monkeypatch):
    random = np.random.default_rng(3)
    some = random.integers(0, 2**63, 1500, dtype=np.uint64)
    near = [x ^ np.uint64(sum(1 << int(b) for b in random.integers(0, 64, 3))) for x in some[:400]]
    some = np.unique(np.concatenate([some, np.array(near, np.uint64), np.arange(60, dtype=np.uint64)]))
    monkeypatch.setattr(simhash, "TASK_FINGERPRINTS", 128)
    prints = spark.createDataFrame([(int(x),) for x in some.view(np.int64)], "fp long")
    work = Workspace(spark, "test")
    got = {r["node"]: r["root"] for r in components(simhash.links(prints, 3, work), work).collect()}
    bits = np.bitwise_count(some[:, None] ^ some[None, :]) <= 3
    place = {int(x): i for i, x in enumerate(some)}
    near_to = grouped(list(place), lambda a, b: bits[place[a], place[b]])
    groups = {}
    for node, root in near_to.items():
        groups.setdefault(root, set()).add(node)
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    found = {}
    for node, root in got.items():
        found.setdefault(root, set()).add(node % 2**64)
    assert {frozenset(g) for g in found.values()} == want


def test_keep_one(docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids
    assert sorted(x for x in ids if x in (3, 4, 5)) == [3]  # no words: one group
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 200)]
    edges = spark.createDataFrame([*chain, *star, (7, 7)], "u long, v long")
    roots = {r["node"]: r["root"] for r in components(edges, Workspace(spark, "test")).collect()}
    assert roots == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 200)}


def plain_nearest(rows, most, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    for q in np.flatnonzero(ids % every == 0):
        scores = [(-float(np.dot(x[q], x[j])), int(ids[j])) for j in range(len(ids)) if ids[j] != ids[q]]
        yield int(ids[q]), sorted(scores)[:most]


def test_nearest_recall(given):
    vectors = given("embeddings")
    got = ann.search(vectors).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    hits = total = 0
    for query, wanted in plain_nearest(rows, 20, 20):
        mine = got[got["query_id"] == query].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert mine["score"].is_monotonic_decreasing
        hits += len(set(mine["vec_id"]) & {i for _, i in wanted})
        total += len(wanted)
    assert hits / total >= 0.9


def test_nearest_windows_on_clustered_vectors(spark, monkeypatch):
    random = np.random.default_rng(5)
    centres = random.normal(size=(60, 16)) * 4
    x = (centres[np.arange(3000) % 60] + random.normal(size=(3000, 16)) * 0.2).astype(np.float32)
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "BLOCK", 64)
    used = []
    monkeypatch.setattr(ann, "_searched", lambda *given, f=ann._searched: used.append(given[4]) or f(*given))
    got = ann.search(frame, every=50, recall=0.95).toPandas()
    wanted = dict(plain_nearest(list(enumerate(x.tolist())), 20, 50))
    hits = [len(set(part["vec_id"]) & {i for _, i in wanted[q]}) for q, part in got.groupby("query_id")]
    assert len(hits) == 60 and sum(hits) / (20 * len(hits)) >= 0.9
    # Windows did it, and they hold fewer blocks for a query than the table.
    assert used and 12 * (2 * used[0] + 1) < 3000 / 64


@pytest.mark.parametrize(("block", "wide"), [(512, 16384), (16, 16384), (16, 64)])
def test_small_tables_are_searched_by_windows_too(spark, monkeypatch, block, wide):
    random = np.random.default_rng(9)
    rows = list(enumerate(random.normal(size=(200, 6)).tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "POINT_PART", wide)
    monkeypatch.setattr(ann, "QUERY_PART", 3)
    used = []
    monkeypatch.setattr(ann, "_searched", lambda *given, f=ann._searched: used.append(given[4]) or f(*given))
    got = ann.search(frame, most=5).orderBy("query_id", "rank").toPandas()
    assert len(used) == 1
    for query, found in all_nearest(rows, 5, 20):
        mine = got[got["query_id"] == query]
        assert list(zip(mine["score"], mine["vec_id"], strict=True)) == found


def all_nearest(rows, most, every):
    """(query id, [(score, id)]) of each row asked for; rows are (id, vector)."""
    width = max(len(v) for _, v in rows)
    x = np.array([v + [0.0] * (width - len(v)) for _, v in rows])
    for i, (query, _) in enumerate(rows):
        if query % every == 0:
            found = sorted((-float((x[i] * x[j]).sum()), rows[j][0]) for j in range(len(rows)) if j != i)
            yield query, [(pytest.approx(-s), j) for s, j in found[:most]]


@pytest.mark.parametrize("kind", ["repeated ids", "uneven lengths", "ties", "mixed widths", "spread"])
def test_nearest_is_brute_force(spark, kind, monkeypatch):
    """Few vectors, and vectors without near ones, are compared with all: recall is 1."""
    random = np.random.default_rng(len(kind))
    monkeypatch.setattr(ann, "BLOCK", 16 if kind == "spread" else 512)
    x = random.normal(size=(300, 8)).astype(np.float32).astype(float)
    if kind == "uneven lengths":
        x *= random.uniform(0.01, 30, size=(300, 1))
    if kind == "ties":
        x = np.round(x)
        x[:, 0] += 10
    ids = random.integers(0, 90, size=300) if kind == "repeated ids" else np.arange(300)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    if kind == "mixed widths":
        rows = [(i, v[: 2 + i % 7]) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for row in ann.search(frame, most=7).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["score"], row["vec_id"]))
    want = {}
    for query, found in all_nearest(rows, 7, 20):
        want.setdefault(query, []).append(found)
    assert got.keys() == want.keys()
    for query, lists in want.items():
        # The answers of rows with one id lie mixed by rank: each rank has the same scores.
        mine = got[query]
        assert sorted(i for _, i in mine) == sorted(i for found in lists for _, i in found)
        if len(lists) == 1:
            assert mine == lists[0]


def test_windows_on_vectors_of_uneven_lengths(spark, monkeypatch):
    random = np.random.default_rng(8)
    centres = random.normal(size=(40, 12)) * 3
    x = centres[np.arange(4000) % 40] + random.normal(size=(4000, 12)) * 0.3
    x *= random.uniform(0.8, 1.25, size=(4000, 1))
    rows = list(enumerate(x.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK", 32)
    got = ann.search(frame, every=50).toPandas()
    wanted = dict(plain_nearest(rows, 20, 50))
    hits = [len(set(part["vec_id"]) & {i for _, i in wanted[q]}) for q, part in got.groupby("query_id")]
    assert len(hits) == 80 and sum(hits) / (20 * len(hits)) >= 0.9
    assert not got.duplicated(["query_id", "vec_id"]).any()


def test_nearest_odd_vectors(spark):
    same = [0.6, 0.8]
    rows = [(i, same) for i in range(40)] + [
        (100, [1.0, 0.0]), (120, None), (140, [0.0, 0.0]), (160, [float("nan"), 1.0]), (180, [1.0, None]),
        (None, [1.0, 1.0]), (200, [1.0]), (0, same),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("point", F.lit(1))
    got = ann.search(frame).toPandas()
    assert set(got["query_id"]) == {0, 20, 100, 200}
    # Two rows have the id 0: each is the other's nearest, by the smaller id.
    assert sorted(got[got["query_id"] == 0]["vec_id"]) == sorted(2 * list(range(20)))
    assert got[got["query_id"] == 20].sort_values("rank")["vec_id"].tolist() == [0, *range(19)]
    assert ann.search(frame.limit(0)).count() == 0
    few = ann.search(frame.where("vec_id IN (0, 100)")).toPandas()
    assert few.groupby("query_id").size().tolist() == [4, 2]


def test_hilbert_curve_is_one_path():
    bits, dims = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = ann.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
