"""Substring dedup, SimHash, search, language model and classifier against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark import SparkContext
from pyspark.sql import functions as F

from wattlake.llm import components, lm, quality, search, simhash, substring
from wattlake.llm.queries import quality_model


def words(text):
    return (text or "").encode().split()


# substring dedup


def brute_repeats(texts, window):
    starts = {}
    for d, t in enumerate(texts):
        w = words(t)
        for s in range(len(w) - window + 1):
            starts.setdefault(tuple(w[s:s + window]), []).append((d, s))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, s in places:
                gone[d] |= set(range(s, s + window))
    kept = [b" ".join(w for k, w in enumerate(words(t)) if k not in gone[d]).decode() for d, t in enumerate(texts)]
    return [(len(words(t)), len(gone[d]), kept[d]) for d, t in enumerate(texts)]


@pytest.mark.parametrize("part", [4000, 1])
def test_repeats_against_brute_force(table, part):
    rng = random.Random(part)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(5, 25))] for _ in range(12)]
    texts = []
    for _ in range(120):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages)[rng.randint(0, 3):] if rng.random() < 0.6 else [f"w{rng.random()}" for _ in range(rng.randint(1, 12))]
        texts.append(rng.choice([" ", "\n"]).join(w))
    texts += [texts[5]] * 3 + ["x " * 40, None, "", "é😀 " * 9]
    got = substring.remove_repeats(table(list(enumerate(texts))), window=8, gram=3, part=part).collect()
    want = brute_repeats(texts, 8)
    assert sum(w[1] for w in want) > 300
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
        assert r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest()
    assert len(got) == len(texts)


def test_repeats_edge_cases(edge, edge_rows, nothing):
    got = substring.remove_repeats(edge, with_text=False).collect()
    want = brute_repeats([t for _, t in edge_rows], 35)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == sorted(
        (str(i), w[0], w[1]) for (i, _), w in zip(edge_rows, want, strict=True))
    assert substring.remove_repeats(nothing).count() == 0


# simhash


def plain_fingerprint(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def brute_components(rows, distance=3):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f"{prints[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("large", [50_000, 1])
def test_simhash_against_brute_force(spark, table, small, edge_rows, large):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    base = rows[3][1].split()
    rows += [(1000 + k, " ".join(base[:k] + ["Changed"] + base[k + 1:])) for k in range(0, 60, 3)]
    rows += [(i if i is None else 2000 + i, t) for i, t in edge_rows]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(table(rows), large=large).collect()]
    assert sorted(got, key=str) == sorted(brute_components(rows), key=str)


def test_simhash_edge_cases(table, nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    found = simhash.near_duplicates(table([(5, "a b c d"), (3, "A B C D"), (4, None), (9, " ")]))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(5, 3), (3, 3), (4, 4), (9, 4)}
    assert sorted(r.doc_id for r in simhash.survivors(table([(5, "a b c d"), (3, "A B C D")]), found).collect()) == [3]


def test_trie_join_against_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(2, 500))
        base = rng.integers(0, 1 << 63, max(1, n // 10), dtype=np.uint64)
        a = base[rng.integers(0, len(base), n)]
        for _ in range(4):
            a = a ^ ((np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) * (rng.random(n) < 0.4).astype(np.uint64))
        a = np.unique(a)
        want = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ a[None, :]) <= 3), strict=True) if i < j}
        got = [p for i, j in simhash.near_pairs(a, None, 3) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(-5, 7), (200, 200)]
    roots = {r.node: r.root for r in components.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{k: -5 for k in range(41)}, **{k: 100 for k in range(101, 140)}}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


# search


def brute_search(rows, queries, k):
    bags = [Counter(x.lower() for x in words(t)) for _, t in rows]
    df = Counter(t for b in bags for t in b)
    mean = sum(map(Counter.total, bags)) / len(rows)
    asked = {}
    for i, t in queries:
        if i is not None:
            asked.setdefault(i, Counter()).update(x.lower() for x in words(t))
    found = set()
    for q, bag in asked.items():
        hits = []
        for (i, _), b in zip(rows, bags, strict=True):
            score = sum(n * math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / mean))
                        for t, n in bag.items() if t in b)
            if score > 0:
                hits.append((-round(score, 4), math.inf if i is None else i))
        found |= {(q, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(hits)[:k], 1)}
    return found


def test_search_against_brute_force(spark, table, small, edge_rows, monkeypatch):
    monkeypatch.setattr(search, "SHARD_DOCS", 40)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "QUERY_BLOCK", 12)
    monkeypatch.setattr(search, "TOGETHER", 3)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(i if i is None else 2000 + i, t) for i, t in edge_rows]
    queries = [r for r in rows if r[0] is None or r[0] % 7 == 0]
    index = search.build_index(table(rows)).cache()
    got = search.top_k(index, table(queries), 5).collect()
    assert {(r.query_id, r.rank, r.doc_id, r.score) for r in got} == brute_search(rows, queries, 5)


def test_blocks_of_queries_are_held_one_at_a_time(spark, table, monkeypatch):
    """Also the rows of a query's results do not grow with the parts of the index."""
    monkeypatch.setattr(search, "QUERY_BLOCK", 8)
    rows, sent, parts, send, write = [(k, f"w{k % 7} w{k} all") for k in range(60)], [], [], SparkContext.broadcast, search.written

    def watch(context, value):
        assert not any(b._jbroadcast.isValid() for b in sent)
        sent.append(send(context, value))
        return sent[-1]

    def counted(df, name):
        if name == "best":
            parts.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(SparkContext, "broadcast", watch)
    monkeypatch.setattr(search, "written", counted)
    index = search.build_index(table(rows).repartition(40))
    got = search.top_k(index, table(rows), 4).collect()
    assert len(sent) > 2 and not any(b._jbroadcast.isValid() for b in sent)
    assert all(f"Repartition {search.TASKS * spark.sparkContext.defaultParallelism}, false" in plan for plan in parts)
    assert {(r.query_id, r.rank, r.doc_id, r.score) for r in got} == brute_search(rows, rows, 4)


def test_entries_are_added_in_the_same_order_however_few_at_a_time(monkeypatch):
    rng = np.random.default_rng(1)
    n, terms = 500, 60
    first = np.sort(rng.integers(0, 3000, terms))
    ends = first + rng.integers(0, 90, terms)
    row, term, weight = np.sort(rng.integers(0, 9, n)), rng.integers(0, terms, n), rng.random(n)
    column, value, open_at = rng.integers(0, 4 * search.BLOCK, 4000), rng.random(4000), np.array([0, -1, search.BLOCK, -1])
    for at, columns in ((None, 4 * search.BLOCK), (open_at, 2 * search.BLOCK)):
        whole = search._added(row, term, weight, first, ends, column, value, 9, columns, at)
        with monkeypatch.context() as few:
            few.setattr(search, "ENTRIES", 50)
            assert (search._added(row, term, weight, first, ends, column, value, 9, columns, at) == whole).all()


def test_hits_that_round_to_nothing(table):
    """A word that every one of many documents has weighs next to nothing, and still makes them hits."""
    rows = [(k, "common" + " filler" * (k % 3)) for k in range(30_000)]
    index = search.build_index(table(rows))
    got = search.top_k(index, table([(1, "common")]), 3).collect()
    assert [(r.rank, r.doc_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 0), (2, 1), (3, 2)]
    assert {r.score for r in got} == {0.0}


def test_blocks_are_skipped():
    rng = random.Random(4)
    held = []
    for d in range(512):
        topic = d % 8
        bag = Counter(f"{topic}-{rng.randint(0, 60)}".encode() for _ in range(40)) + Counter({f"{topic}-0".encode(): 9})
        held.append((d, bag.total(), np.array([search._hash(t) for t in bag], np.int64), np.array(list(bag.values()), np.int32)))
    shard = {n: c[0].as_py() for n, c in zip(search._SHARD.names, search._shard_batch(held).columns, strict=True)}
    asked = [(q, search._hash(f"{q % 8}-{w}".encode()), 2.0) for q in range(16) for w in range(60)]
    block = search.QueryBlock(*(np.array(c) for c in zip(*asked, strict=True)))
    best = search.Best(16, 5)
    search.search_shard(shard, block, 45.0, best)
    scored, every = search.search_shard(shard, block, 45.0, best)
    assert 0 < scored < every / 2


def test_search_edge_cases(nothing, table):
    assert search.top_k(search.build_index(nothing), table([(1, "a")])).count() == 0
    index = search.build_index(table([(1, "a b"), (2, None)]))
    assert search.top_k(index, nothing).count() == 0 and search.top_k(index, table([(50, ""), (100, "zzz")])).count() == 0
    assert [(r.query_id, r.doc_id) for r in search.top_k(index, table([(50, "A")])).collect()] == [(50, 1)]


# language model


def brute_lm(texts, order):
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        w = words(t)
        for n in range(1, order + 1):
            grams[n].update(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    total = grams[1].total()

    def s(context, w):
        if not context:
            return grams[1][w,] / total
        seen = grams[len(context) + 1][*context, w]
        return seen / grams[len(context)][context] if seen >= 2 else 0.4 * s(context[1:], w)

    return [round(float(np.mean([math.log(s(tuple(w[max(0, k - order + 1):k]), w[k])) for k in range(len(w))])), 5) if (w := words(t)) else None
            for t in texts]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_against_brute_force(table, monkeypatch, order):
    monkeypatch.setattr(lm, "SHARD_ROWS", 16)
    rng = random.Random(order)
    texts = [" ".join(rng.choice("aaabbcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(80)] + [None, "", "a", "A é😀"]
    got = {r.doc_id: r for r in lm.score(table(list(enumerate(texts))), order).collect()}
    for k, want in enumerate(brute_lm(texts, order)):
        assert got[k].n_words == len(words(texts[k]))
        assert got[k].mean_log_score == want if want is None else abs(got[k].mean_log_score - want) < 2e-5


def test_lm_edge_cases(edge, edge_rows, nothing):
    got = lm.score(edge).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == sorted((str(i), len(words(t))) for i, t in edge_rows)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got) and lm.score(nothing).count() == 0


# quality


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality_model(docs, labels)).where(quality.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    good = [r.score >= 0.7 for r in scored if r.quality == 1]
    bad = [r.score < 0.7 for r in scored if r.quality == 0]
    assert len(good) > 50 and np.mean(good) >= 0.98 and np.mean(bad) >= 0.9


def test_quality_learns_only_from_given_labels(table, spark):
    docs = table([(k, "good words here" if k % 2 else "!! ?? !!") for k in range(60)] + [(99, None), (98, "")])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(41, None), (42, 7), (1000, 1), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all((s > 0.9) == (i % 2 == 1) for i, s in got.items() if i < 60) and got[99] == got[98] and 0 < got[99] < 1
    again = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs.orderBy(F.desc("doc_id")), labels)).collect()}
    assert again == got
    assert quality.accepted(docs, model, 0.7).where("doc_id < 60").count() == 30 and quality.accepted(docs, model, 0.7).columns == docs.columns


def test_quality_edge_cases(edge, edge_rows, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(edge, quality.fit(edge, none)).collect()} == {0.5}
    assert quality.score(nothing, quality.fit(nothing, none)).count() == 0
    assert quality.score(edge, quality.fit(edge, none)).count() == len(edge_rows)


def plain_training(bags, labels, steps, rate):
    """The same descent, number by number."""
    rng = np.random.default_rng(quality.SEED)
    size = quality.DIMENSIONS
    vectors = rng.uniform(-1 / size, 1 / size, (quality.BUCKETS, size)).astype(np.float32).astype(float)
    outputs, bias = [[0.0, 0.0] for _ in range(size)], [0.0, 0.0]
    order, at = rng.permutation(len(bags)), 0
    for step in range(steps):
        if at >= len(order):
            order, at = rng.permutation(len(bags)), 0
        now, at = order[at:at + quality.BATCH], at + quality.BATCH
        slow = rate * (1 - step / steps)
        hidden, wrong = [], []
        for k in now:
            h = [sum(w * vectors[i][d] for i, w in zip(*bags[k], strict=True)) for d in range(size)]
            logits = [sum(h[d] * outputs[d][c] for d in range(size)) + bias[c] for c in (0, 1)]
            odds = [math.exp(x - max(logits)) for x in logits]
            hidden.append(h)
            wrong.append([(odds[c] / sum(odds) - (labels[k] == c)) / math.sqrt(len(now)) for c in (0, 1)])
        back = [[sum(g[c] * outputs[d][c] for c in (0, 1)) for d in range(size)] for g in wrong]
        for c in (0, 1):
            for d in range(size):
                outputs[d][c] -= slow * sum(h[d] * g[c] for h, g in zip(hidden, wrong, strict=True))
            bias[c] -= slow * sum(g[c] for g in wrong)
        for k, g in zip(now, back, strict=True):
            for i, w in zip(*bags[k], strict=True):
                vectors[i] -= slow * w * np.array(g)
    return vectors, outputs, bias


def plain_features(text):
    made = [quality._END]
    w = text.split()
    for k, word in enumerate(w):
        spelt = f"<{word}>"
        pieces = [spelt] + [spelt[s:s + n] for n in (2, 3, 4) for s in range(len(spelt) - n + 1)]
        made += [zlib.crc32(p.encode()) % quality.BUCKETS for p in pieces]
        if k and w[k - 1] == word:
            made.append(quality._AGAIN)
    return made


def test_training_and_scores_against_plain_python():
    texts = ["good words of a text", "BAD!! BAD!! BAD!!", "", "fine text and more", "x x x # #", "é ß 漢字 words", "more of the good", "### ### bad"]
    labels = np.array([1, 0, 0, 1, 0, 1, 1, 0])
    bags = [quality.document_features(t) for t in texts]
    for text, (ids, weights) in zip(texts, bags, strict=True):
        counts = Counter(plain_features(text))
        assert dict(zip(ids.tolist(), weights.tolist(), strict=True)) == pytest.approx({i: n / counts.total() for i, n in counts.items()})
    model = quality.train(bags, labels, steps=5)
    vectors, outputs, bias = plain_training([(i.tolist(), w.tolist()) for i, w in bags], labels, 5, quality.RATE)
    scorer = quality.Scorer(model)
    for text in [*texts, "never seen words", "good good good"]:
        f = plain_features(text)
        h = [sum(vectors[i][d] for i in f) / len(f) for d in range(quality.DIMENSIONS)]
        logits = [sum(h[d] * outputs[d][c] for d in range(quality.DIMENSIONS)) + bias[c] for c in (0, 1)]
        assert scorer.score(text) == pytest.approx(1 / (1 + math.exp(logits[0] - logits[1])), abs=1e-5)


def test_labelled_rows_of_one_id_are_bounded(spark):
    """An id that most rows have teaches its text once."""
    texts = [(1, "good words of one text")] * 500 + [(2, "BAD ## BAD")] + [(1, "another text of the same id")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    once = spark.createDataFrame(sorted(set(texts)), "doc_id long, text string")
    many = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    a, b = (quality.fit(d, labels) for d in (once, many))
    assert np.array_equal(a.speaks, b.speaks) and a.bias == b.bias
