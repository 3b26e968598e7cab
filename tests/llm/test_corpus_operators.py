"""Operators over whole tables against brute force."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import chat, decontaminate, graph, ngram_quality, simhash, text, toxicity, warc
from ledgerloom.session import row_keys

SCHEMA = "doc_id bigint, text string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def fingerprint(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(spark, table):
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one two THREE", "É x", "a\x85b c\xa0d e", LONG,
             *(" ".join(rng.choice("a b c dd Ee ﬁ \t 😀".split(" ")) for _ in range(rng.randint(1, 40))) for _ in range(300))]
    got = simhash.with_fingerprints(table(list(enumerate(texts)), SCHEMA), out="print", keep=["doc_id"]).collect()
    assert {r.doc_id: r.print % 2 ** 64 for r in got} == {i: fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", [simhash.BLOCK, 7])
def test_links_connect_just_what_is_near(spark, monkeypatch, block):
    """Random prints, dense clusters (many near copies) and chains, with groups far above a block."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2 ** 63, 4, dtype=np.uint64)
    near = np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (60, 3), dtype=np.uint64), axis=1) for c in centre])
    chain = [int(centre[0])]
    for b in range(0, 60, 5):
        chain.append(chain[-1] ^ (0b1111 << b))
    prints = np.unique(np.concatenate([rng.integers(0, 2 ** 63, 300, dtype=np.uint64), near, np.array(chain, np.uint64), np.array([0, 15, 2 ** 64 - 1], np.uint64)]))
    df = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp bigint")
    links = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in simhash.fingerprint_links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    values = [int(v) for v in prints]
    want = groups(values, [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= 4])
    assert groups(values, links) == want
    assert len(links) < 70 * len(values)


def test_near_duplicates_of_documents(spark, table):
    base = " ".join(f"tok{i}" for i in range(400))
    texts = [base, base, base + " more", None, "", "  ", "something else entirely here", "something else entirely here"]
    rows = [(i if i != 1 else None, t) for i, t in enumerate(texts)] + [(2, texts[2])]
    got = simhash.near_duplicates(table(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.component_id)
    assert by_id == {0: {0}, None: {0}, 2: {0 if (fingerprint(base) ^ fingerprint(texts[2])).bit_count() <= 4 else 2}, 3: {3}, 4: {3}, 5: {3}, 6: {6}, 7: {6}}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(600, 700)] + [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    nodes = {n for e in edges for n in e}
    want = groups(nodes, edges)
    assert {n: got.get(n, n) for n in nodes} == want
    assert graph.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def contaminated(docs, items, width=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(None if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, got = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    got |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), tuple(sorted(got - {None}))))
    return sorted(out, key=str)


def test_contamination(spark, table):
    rng = random.Random(4)
    say = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    few, many = ["a", "b", "É", "7"], [f"word{i}" for i in range(50)]
    items = [(1, say(25, many)), (2, say(12, few)), (3, "two words"), (4, "lonely"), (5, "a b a"), (6, None), (7, "?!"), (None, say(11, many)),
             (8, say(10, many)), (9, say(25, many)), (10, "lonely")]
    docs = [(None, None), (0, ""), (1, LONG)]
    for i in range(2, 150):
        parts = [say(rng.randint(0, 30), many + few)]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, max(0, len(w) - 5))
            parts += [" ".join(w[a: a + rng.randint(3, 20)]).upper(), say(rng.randint(0, 4), few)]
        docs.append((i, " - ".join(parts)))
    docs += docs[5:8]
    got = decontaminate.contamination(table(docs, SCHEMA), table(items, "item_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=str) == contaminated(docs, items)


def test_contamination_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], SCHEMA), spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r) for r in decontaminate.contamination(docs, items).collect()] == [(1, 2, 0, [])]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def kneser_ney(texts, classes):
    """Probabilities of the interpolated modified model, from dictionaries."""
    n, size = ngram_quality.ORDER, ngram_quality.SYMBOLS
    counts = [defaultdict(int) for _ in range(n + 1)]
    for t in texts:
        s = [0] * (n - 1) + [int(classes[b]) for b in t.encode()]
        for i in range(n - 1, len(s)):
            counts[n][tuple(s[i - n + 1: i + 1])] += 1
    for k in range(n - 1, 0, -1):
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1
    discount = {}
    for k in range(1, n + 1):
        c = [max(sum(v == m for v in counts[k].values()), 1) for m in (1, 2, 3, 4)]
        y = c[0] / (c[0] + 2 * c[1])
        raw = [0, 1 - 2 * y * c[1] / c[0], 2 - 3 * y * c[2] / c[1], 3 - 4 * y * c[3] / c[2]]
        discount[k] = [min(max(r, 0), m) for m, r in enumerate(raw)]

    def p(g):
        if not g:
            return 1 / size
        own = {x: counts[len(g)][(*g[:-1], x)] for x in range(size) if counts[len(g)].get((*g[:-1], x))}
        if not own:
            return p(g[1:])
        d = lambda c: discount[len(g)][min(c, 3)]
        c = own.get(g[-1], 0)
        return (c - d(c) + sum(map(d, own.values())) * p(g[1:])) / sum(own.values())

    return p


def test_ngram_model_equals_plain_kneser_ney(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    classes = ngram_quality.alphabet(df)
    bits = ngram_quality.probabilities(ngram_quality.count_grams(df, classes))
    p = kneser_ney(texts, classes)
    for t in ["abc", "cab é", "", "zzz", "é é", "aaaa"]:
        s = [0] * 3 + [int(classes[b]) for b in t.encode()]
        want = sum(-np.log2(max(p(tuple(s[i - 3: i + 1])), 2 ** -24.0)) for i in range(3, len(s)))
        data, offsets = text.utf8(__import__("pyarrow").array([t]))
        assert bits[ngram_quality.grams(data, offsets, classes)].astype(float).sum() == pytest.approx(want, rel=2e-3, abs=1e-3)


def test_perplexity_keeps_clean_and_drops_junk(spark, table):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["an", "the", "ou", "sh", "re", "ing"]) for _ in range(3))
    clean = [" ".join(word() for _ in range(120)) for _ in range(150)]
    junk = ["#%$ " * 150, "QQ!! " * 100]
    texts = [*clean, *junk, None, "", clean[0]]
    docs = table([(i, t, None if i % 50 == 9 else "xx" if i % 50 == 8 else "en") for i, t in enumerate(texts)], SCHEMA + ", lang string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 152, 2)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in ngram_quality.judge(docs, labels).collect()}
    assert len(got) == len(texts) and not got[150] and not got[151] and got[152] and got[153]
    assert sum(got[i] for i in range(150)) == 150
    everything = ngram_quality.judge(docs, labels.limit(0)).collect()
    assert all(r.kept for r in everything) and ngram_quality.judge(docs.limit(0), labels).count() == 0


def test_perplexity_knows_words_and_their_order(spark, table):
    rng = random.Random(16)
    vocabulary = ["".join(rng.choice("aeioutnrsl") for _ in range(6)) for _ in range(60)]
    follow = {w: rng.sample(vocabulary, 3) for w in vocabulary}

    def walk(n=150):
        out = [rng.choice(vocabulary)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return out

    clean = [" ".join(walk()) for _ in range(160)]
    disorder = [" ".join(rng.choice(vocabulary) for _ in range(150)) for _ in range(4)]
    docs = table([*((i, t, "en") for i, t in enumerate(clean)), *((1000 + i, t, "en") for i, t in enumerate(disorder))], SCHEMA + ", lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 160, 2)], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in ngram_quality.judge(docs, labels).collect()}
    assert not any(got[1000 + i] for i in range(4)) and sum(got[i] for i in range(160)) >= 152


def test_passes_hold_every_word_and_bigram_once(spark):
    rng = random.Random(18)
    say = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(n))
    texts = ["", " ", "a", *(say(rng.randint(0, 40)) for _ in range(30))]
    one = lambda t: int(text.word_hashes(text.words(*text.utf8(pa.array([t])), text.NOT_SPACE))[0].view(np.int64)[0])
    edges = [int(x.view(np.int64)) for x in (ngram_quality.START, ngram_quality.END)]
    want = Counter()
    for i, t in enumerate(texts):
        h = [one(x) for x in t.split()]
        want.update((v, w, i % 2) for v, w in zip([edges[0], *h], [*h, edges[1]], strict=True) if h)
    docs = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "t string, fold int")
    got, waves = Counter(), defaultdict(set)
    for wave in range(ngram_quality.WAVES):
        for r in ngram_quality.count_pairs(docs, wave).collect():
            got.update({(r.v, r.w, 1): r.n0, (r.v, r.w, 0): r.n1})
            waves[r.v].add(wave)
    assert +got == want and all(len(x) == 1 for x in waves.values())


def test_perplexity_leaves_no_copy_of_the_texts(spark, table, tmp_path, monkeypatch):
    rng = random.Random(19)
    say = lambda: " ".join("".join(rng.choice(["an", "the", "ou", "sh"]) for _ in range(3)) for _ in range(80))
    table([(i % 50, say(), "en") for i in range(120)], SCHEMA + ", lang string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    written = []
    monkeypatch.setattr("ledgerloom.session.shared_folder", lambda spark: written.append(f"{tmp_path}/{len(written)}") or written[-1])
    got = [ngram_quality.judge(docs, labels), ngram_quality.judge(row_keys(docs, "__row"), labels, key="__row")]
    left = [w for w in written if Path(w).exists()]
    assert left and all("t" not in spark.read.parquet(w).columns for w in left)
    plain, keyed = (sorted((r.doc_id, r.n_bytes, round(r.bits, 6), r.kept) for r in d.collect()) for d in got)
    assert len(plain) == 120 and plain == keyed


@pytest.mark.parametrize("labelled", [1, 3])
def test_perplexity_keeps_clean_texts_of_a_rare_language(spark, table, labelled):
    rng = random.Random(17)
    say = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))
    rows = [(i, say(["an", "the", "ou", "sh", "re", "ing"], rng.randint(60, 200)), "en") for i in range(150)]
    rows += [(1000 + i, say(["ав", "при", "ост", "ени", "же", "сь", "ли"], rng.randint(20, 200)), "ru") for i in range(30)]
    labels = spark.createDataFrame([*((i, 1) for i in range(0, 150, 2)), *((1000 + i, 1) for i in range(labelled))], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in ngram_quality.judge(table(rows, SCHEMA + ", lang string"), labels).collect()}
    assert [i for i in got if i >= 1000 and not got[i]] == []


def test_toxicity_learns_from_training_rows_only(spark, table):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice(["an", "the", "ou", "sh", "re", "ing"]) for _ in range(3))
    bad = ["grump", "vexolo", "vexoma", "vexoti", "moot"]
    rows, labels = [], []
    for i in range(1500):
        w = [word() for _ in range(rng.randint(1, 40))]
        toxic = rng.random() < 0.15
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad).title()
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(2000, None), (2001, ""), (None, "grump"), (3, rows[3][1])]
    docs, known = table(rows, SCHEMA), spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if i is not None and __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    right = sum((r.score >= 0.3) == bool(truth.get(r.doc_id, 0)) for r in held)
    assert right >= 0.97 * len(held)
    assert all(r.score < 0.3 for r in got if r.doc_id in (2000, 2001)) and all(r.score >= 0.3 for r in got if r.doc_id is None)
    # held-out labels make no difference
    swapped = spark.createDataFrame([(i, 1 - t if __import__("zlib").crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels], "doc_id bigint, toxic int")
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, swapped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got)


def test_toxicity_without_labels(spark):
    docs, none = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA), spark.createDataFrame([], "doc_id bigint, toxic int")
    assert all(r.score < 0.3 for r in toxicity.toxicity(docs, none).collect())
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def test_label_model_finds_accuracies_and_shares_out_copies():
    rng = np.random.default_rng(8)
    y = rng.random(20_000) < 0.2
    fire = lambda good, bad: rng.random(20_000) < np.where(y, good, bad)
    first = fire(0.8, 0.05)
    votes = np.column_stack([first, first, fire(0.7, 0.1), fire(0.6, 0.02)]).astype(float)
    start = np.array([[0.1] * 4, [0.6] * 4])
    m = toxicity.fit_label_model(votes, np.ones(len(votes)), start, 0.3)
    assert np.allclose(m.fires[1][1:], [0.8, 0.7, 0.6], atol=0.08) and np.allclose(m.fires[0][1:], [0.05, 0.1, 0.02], atol=0.05)
    assert m.weight[0] < 0.65 and m.weight[1] < 0.65 and m.weight[2] > 0.8


def test_chat_perspectives(spark, table):
    rows = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi é"), (1, 2, "bob", None), (1, 2, "ann", "tie"), (1, None, None, "?"), (2, 0, "system", "alone"),
            (None, 0, "ann", "x"), (3, 0, "ann", "same"), (3, 0, "ann", "same"), (4, 1, "a", ""), (4, 3000, "b", "late")]
    got = chat.perspectives(table(rows, "conv_id bigint, turn bigint, role string, text string"))
    by = defaultdict(list)
    for r in got.collect():
        by[r.conv_id, r.perspective].append(r)
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "ann"), (4, "a"), (4, "b")}
    for (conv, who), turns in by.items():
        turns.sort(key=lambda r: r.position)
        own = sorted(((t, s or "unknown", x or "") for c, t, s, x in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        whole = "".join(r.text for r in turns)
        assert [r.position for r in turns] == list(range(len(own)))
        assert [whole[r.start:r.end] for r in turns] == [x for _, _, x in own]
        assert [r.trained for r in turns] == [s == who for _, s, _ in own]
        assert [r.role for r in turns] == ["assistant" if s == who else "system" if s == "system" else "user" for _, s, _ in own]
        assert [r.name for r in turns] == [s if r.role == "user" else None for r, (_, s, _) in zip(turns, own, strict=True)]
    whole = {(r.conv_id, r.perspective): r for r in chat.assembled(got).collect()}
    assert whole[4, "b"].text == "".join(r.text for r in by[4, "b"]) and len(whole[4, "b"].mask) == 1
    assert chat.perspectives(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_warc_round_trip(spark, table, tmp_path):
    pages = [(3, "http://a/\n b", "same"), (1, "u", "same"), (2, None, "same"), (5, "v", None), (4, "w", ""), (6, "x", "é\r\n\r\n" * 9), (None, "y", "same"),
             (7, "z", "w" * 300_000), (8, "q", "q"), (8, "q", "q")]
    folder = f"file://{tmp_path}/warc"
    index = warc.write(table(pages, "page_id bigint, url string, html string", extra=("digest string", "row string", "t string", "path string")), folder)
    got = warc.read(index).collect()
    assert len(got) == len(pages)
    for r in got:
        html = {p: h or "" for p, _, h in pages}[r.page_id].encode()
        assert r.n_bytes == len(html) and r.digest == base64.b32encode(hashlib.sha1(html).digest()).decode()
        assert r.payload == (html if r.record_type == "response" else b"")
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds == {1: ("response", None), 2: ("revisit", "1"), 3: ("revisit", "1"), None: ("revisit", "1"), 4: ("response", None), 5: ("revisit", "4"),
                     6: ("response", None), 7: ("response", None), 8: ("response", None)}
    small = {r.page_id: r.record_type for r in warc.read(warc.write(table(pages, "page_id bigint, url string, html string"), folder, least_bytes=5)).collect()}
    assert set(small.values()) == {"response"}
    some = warc.read(index.where(F.col("page_id").isin(6, 7))).collect()
    assert {r.page_id for r in some} == {6, 7}
    for path in {r.path for r in index.collect()}:
        raw = gzip.open(path.removeprefix("file://")).read()
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: re") and raw.endswith(b"\r\n\r\n")
    assert warc.read(warc.write(spark.createDataFrame([], "page_id bigint, url string, html string"), folder)).count() == 0


def test_damaged_archive_is_noticed(spark, tmp_path):
    index = warc.write(spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string"), f"file://{tmp_path}")
    with pytest.raises(Exception, match="damaged record"):
        warc.read(index.withColumn("digest", F.lit("A" * 32))).collect()


def test_byte_ranges_are_coalesced():
    offset, length = np.array([0, 10, 25, 1000, 1010]), np.array([10, 10, 10, 10, 5000])
    assert warc.ranges(offset, length, gap=8, longest=500) == [(0, 3), (3, 4), (4, 5)]
    assert warc.ranges(offset, length, gap=10_000, longest=10_000) == [(0, 5)]


def test_posterior_is_bayes_rule_over_the_voters():
    rng = np.random.default_rng(3)
    model = toxicity.LabelModel(0.2, np.clip(rng.random((2, 5)), 0.05, 0.95), rng.random(5))
    votes = (rng.random((40, 5)) < 0.5).astype(float)
    for v, got in zip(votes, model.posterior(votes), strict=True):
        odds = model.prior / (1 - model.prior)
        for j in range(5):
            likely = [model.fires[c, j] if v[j] else 1 - model.fires[c, j] for c in (0, 1)]
            odds *= (likely[1] / likely[0]) ** model.weight[j]
        assert got == pytest.approx(odds / (1 + odds))


def test_label_model_finds_the_voters_rates_without_labels():
    """Votes drawn from known rates, two voters always the same: rates are recovered, and the pair counts about once."""
    rng = np.random.default_rng(8)
    rates, toxic = np.array([[0.02, 0.05, 0.1, 0.8], [0.7, 0.6, 0.8, 0.1]]), rng.random(20_000) < 0.2
    votes = (rng.random((20_000, 4)) < rates[toxic.astype(int)]).astype(float)
    votes = np.column_stack([votes, votes[:, 2]])
    rates = np.column_stack([rates, rates[:, 2]])
    seen, n = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(seen, n.astype(float), np.clip(rates + rng.normal(0, 0.1, rates.shape), 0.05, 0.95), 0.3)
    assert np.abs(model.fires - rates).max() < 0.05 and abs(model.prior - 0.2) < 0.03
    assert model.weight[2] + model.weight[4] == pytest.approx(1, abs=0.1) and model.weight[0] > 0.8


def test_a_labelled_id_with_many_rows_takes_part_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_ROWS", 2)
    texts = {i: ("vile nasty words number " if i % 3 == 0 else "pleasant words of note ") + str(i) for i in range(60)}
    rows = [*texts.items(), *[(0, f"row {i} of the hot id") for i in range(500)], (None, "vile nasty"), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in texts], "doc_id bigint, toxic int")
    taken = []
    inner = toxicity.fit_linear
    monkeypatch.setattr(toxicity, "fit_linear", lambda rows, cols, n_rows, *a: taken.append(n_rows) or inner(rows, cols, n_rows, *a))
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and 0 < taken[0] <= 60


def test_long_conversations_are_cut_by_their_whole_order(spark, table):
    """No turns, tied turns and no conversation id: cut or not, the places are the same."""
    rng = random.Random(12)
    rows = [(rng.choice([None, None, 1, 2]), rng.choice([None, 0, 1, 5000]), rng.choice(["ann", "bob", "system", None]), rng.choice(["", None, "hi é", "a longer turn"]))
            for _ in range(400)]
    turns = table(rows, "conv_id bigint, turn bigint, role string, text string", ("block int", "who string", "c int", "row int"))
    want = sorted(map(repr, chat.perspectives(turns).collect()))
    assert sorted(map(repr, chat.perspectives(turns.repartition(3), long=20).collect())) == want
    plan = chat.perspectives(turns, long=20)
    assert len(want) > len(rows) and plan.where("conv_id is null").count() > 0
