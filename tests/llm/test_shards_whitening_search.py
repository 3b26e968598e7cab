"""Sharding, whitening and ranked search against brute force, with nulls, ties, repeats and hot groups."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import dual_tree, queries, sharding, whitening

DOCS = "doc_id bigint, text string"
CLASHES = ("size int", "shard string", "slot int", "arc int", "id string", "row bigint", "more int", "x int", "key int", "terms string", "n int", "score int")


def brute_shards(rows, shards, points, slack=0.0):
    """Every row by itself: sorted on the ring, offered round by round."""
    pos = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    nodes = sorted((pos(f"{s}:{p}"), s) for s in range(shards) for p in range(points))
    key = lambda r: (pos("" if r[0] is None else str(r[0])), r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
    room = [math.ceil((1 + slack) * len(rows) / shards) if slack else len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    waiting, held, out = sorted(map(key, rows)), [0] * shards, []
    order = {}
    for k in waiting:
        first = next((i for i, (p, _) in enumerate(nodes) if p >= k[0]), 0)
        order[k] = list(dict.fromkeys(nodes[(first + i) % len(nodes)][1] for i in range(len(nodes))))
    for turn in range(shards):
        left = []
        for k in waiting:
            s = order[k][turn]
            if held[s] < room[s]:
                out.append((k[2] if k[1] else None, k[3], k[4], s, held[s]))
                held[s] += 1
            else:
                left.append(k)
        waiting = left
    return Counter(out)


def shard_rows():
    rng = random.Random(3)
    rows = [(i, rng.choice(["", None, "same", f"text {i} é"])) for i in range(300)]
    return rows + [(None, "x"), (None, None), (-5, "b"), (7, "other"), (7, "other")] + [(42, "hot")] * 150


@pytest.mark.parametrize(("shards", "points", "slack"), [(16, 8, 0.0), (5, 1, 0.0), (3, 20, 0.25), (1, 4, 0.0)])
def test_shards_equal_rounds_row_by_row(spark, table, shards, points, slack):
    got = sharding.assign(table(shard_rows(), DOCS, CLASHES).repartition(3), shards=shards, points=points, slack=slack).collect()
    assert Counter(tuple(r) for r in got) == brute_shards(shard_rows(), shards, points, slack)


def test_shards_are_balanced_and_slots_gapless(spark, table):
    got = sharding.assign(table(shard_rows(), DOCS, CLASHES), keep=["text", "size", "x"]).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.size, r.text_crc32) == (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(16)) <= 1
    assert list(got[0].asDict()) == ["doc_id", "size", "text_crc32", "shard", "slot", "text", "x"]


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'t' as text")
    a, b = (dict(sharding.assign(docs, shards=s).select("doc_id", "shard").collect()) for s in (16, 17))
    moved = sum(a[k] != b[k] for k in a) / len(a)
    assert 1 / 17 - 0.01 < moved < 2.5 / 17


def test_shards_of_nothing(spark, table):
    assert sharding.assign(table([], DOCS)).collect() == []
    with pytest.raises(ValueError, match="positive"):
        sharding.assign(table([], DOCS), shards=0)


def test_native_sharding_runs_no_python(spark):
    plan = queries.QUERIES["op11_ring_shards"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VECTORS = "vec_id bigint, embedding array<float>"


def brute_white(rows, most, weights, scale=64.0, shift=1_000_000):
    good = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) and abs(scale * e) < 2 ** 52 for e in v)]
    d = max(Counter(len(v) for _, v in good).items(), key=lambda x: x[::-1])[0]
    x = np.array([[math.floor(scale * float(np.float32(e))) + shift for e in v] for _, v in good if len(v) == d])
    ids = [i for i, v in good if len(v) == d]
    u, count = np.unique(x, axis=0, return_counts=True)
    w = count if weights == "count" else np.ones(len(u), int)
    n, s = int(w.sum()), (w[:, None] * u).sum(0)
    y = u - s / n
    v = (w[:, None] * y).T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    q, e = q[:, e > 1e-12 * e[0]], e[e > 1e-12 * e[0]]
    return ids, n, ((n * x - s) ** 2).sum(1), (x - s / n) @ q / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(spark, table, weights):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (200, 6)).astype(np.float32) * np.array([5, 4, 3, 2, 1, 0.5], np.float32))]
    rows += [(1000 + i, [0.5, 0.25, 0.0, -1.0, 2.0, 3.0]) for i in range(120)]  # a hot vector
    rows += [(None, rows[0][1]), (3, rows[5][1]), (9, None), (10, []), (11, [1.0, 2.0]), (12, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (13, [float("nan")] * 6), (14, [float("inf")] * 6), (15, [1e30] * 6)]
    ids, n, deviation, white, explained = brute_white(rows, 4, weights)
    got = whitening.whiten(table(rows, VECTORS, CLASHES).repartition(4), most=4, weights=weights).collect()
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id, r.component].append(r)
    sign = {}
    for i, dev, z in zip(ids, deviation, white, strict=True):
        for c, value in enumerate(z, 1):
            here = [r for r in by_id[i, c] if r.deviation == dev]
            assert here and min(abs(abs(r.whitened) - abs(value)) for r in here) < 1e-9 * (1 + abs(value))
            assert abs(here[0].explained / explained[c - 1] - 1) < 1e-9
            if abs(value) > 0.1 and len(by_id[i, c]) == 1:
                sign.setdefault(c, set()).add(np.sign(here[0].whitened * value))
    assert all(len(s) == 1 for s in sign.values())


def test_whitening_of_degenerate_tables(spark, table):
    assert whitening.whiten(table([], VECTORS)).collect() == []
    assert whitening.whiten(table([(1, None), (2, [])], VECTORS)).collect() == []
    assert whitening.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS)).collect() == []
    flat = whitening.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 5.0])], VECTORS)).collect()
    assert sorted((r.vec_id, r.component) for r in flat) == [(1, 1), (2, 1), (3, 1)] and flat[0].explained == pytest.approx(1)
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(table([], VECTORS), weights="x")


def test_deviation_beyond_64_bits_is_missing(spark, table):
    got = whitening.whiten(table([(1, [0.0]), (2, [6e13]), (3, [0.5])], VECTORS), scale=60.0).collect()
    assert {r.vec_id: r.deviation is None for r in got} == {1: True, 2: True, 3: True}


def brute_search(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    split = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(1 for _, c in split if c), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in split:
            m = 10 + 90 * sum(c.values()) * n // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def search_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Straße", "X1", "日本"]
    some = lambda n: " ".join(rng.choices(vocabulary, k=n, weights=[1 / (i + 1) for i in range(len(vocabulary))]))
    docs = [(i, rng.choice([some(rng.randint(1, 60)), None, "", "..."])) for i in range(700)]
    docs += [(1000 - i, "w1 w2 w3 Straße") for i in range(150)] + [(None, "w1 w2 w3 Straße"), (5, "w1 w2"), (5, "w1 w2"), (2000, some(30_000))]
    items = [(i, some(rng.randint(1, 20))) for i in range(30)] + [(None, "w1 W2"), (3, None), (4, ""), (6, "nothing here"), (7, "straße"), (7, "straße"), (8, "w1 w2 w3 straße")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_scoring_all(spark, table, monkeypatch, small):
    if small:  # many blocks, many trees
        monkeypatch.setattr(dual_tree, "BLOCK_TERMS", 150)
        monkeypatch.setattr(dual_tree, "TREE_DOCS", 64)
        monkeypatch.setattr(dual_tree, "STEP", 500)
    docs, items = search_rows()
    got = dual_tree.search(table(docs, DOCS, CLASHES).repartition(3), table(items, "item_id bigint, text string", CLASHES)).collect()
    assert Counter(tuple(r) for r in got) == brute_search(docs, items)


def test_search_of_nothing(spark, table):
    docs, items = table([(1, "a b")], DOCS), table([(1, "a")], "item_id bigint, text string")
    assert dual_tree.search(docs.limit(0), items).collect() == [] and dual_tree.search(docs, items.limit(0)).collect() == []


def test_bounds_hold_and_prune(monkeypatch):
    """Every node pair's bound is at least the scores below it, and with known thresholds most pairs are never scored."""
    monkeypatch.setattr(dual_tree, "FAN", 2)
    rng = np.random.default_rng(7)
    dense = rng.integers(0, 50, (64, 40)) * (rng.random((64, 40)) < 0.1)
    wanted = rng.random((9, 40)) < 0.15
    wanted[:, 0] = True
    sparse = lambda m: dual_tree.Level(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), np.nonzero(m)[1], m[m != 0])
    items = dual_tree.Items(sparse(wanted.astype(int)).start, sparse(wanted.astype(int)).term, 40)
    scores = wanted[items.order].astype(int) @ dense.T
    for depth, level in enumerate(items.levels):
        for docs in dual_tree.tree(sparse(dense)):
            found = dual_tree.bounds(items, depth, docs, np.ones((level.nodes, docs.nodes), bool))
            i, d = -(-9 // level.nodes), -(-64 // docs.nodes)
            i, d = 1 << (i - 1).bit_length(), 1 << (d - 1).bit_length()
            for a in range(level.nodes):
                for b in range(docs.nodes):
                    assert found[a, b] >= scores[a * i: (a + 1) * i, b * d: (b + 1) * d].max()
    least = np.sort(wanted.astype(int) @ dense.T, axis=1)[:, -3]
    best = dual_tree.Best(3, least)
    scored = dual_tree.search_tree(items, sparse(dense), pa.array(range(64)), best)
    assert scored < 9 * 64 / 4
    for item, found in enumerate(best.found):
        every = sorted((-int(s), False, d) for d, s in enumerate(wanted[item].astype(int) @ dense.T) if s > 0)[:3]
        assert found == every
