"""Near duplicates of the pipeline against exact shingle similarity."""

import random
import time

import corpus_pipeline as pipeline
import numpy as np
import pytest

from wattlake.llm import components, near, simhash


def plain_shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def plain_similarity(a, b):
    a, b = plain_shingles(a), plain_shingles(b)
    return len(a & b) / len(a | b) if a and b else 0.0


def edited_copies(rng, n_pairs):
    """Pairs of a text and a copy with words changed, at a similarity of 0.8 to 0.95."""
    while n_pairs:
        n = rng.choice([60, 100, 300, 1000])
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
        copy = list(base)
        for at in rng.sample(range(n), rng.randint(1, max(1, n // 45))):
            copy[at] = "changed"
        base, copy = " ".join(base), " ".join(copy)
        if 0.8 <= plain_similarity(base, copy) <= 0.95:
            n_pairs -= 1
            yield base, copy


def test_stage_drops_edited_copies(spark, table, small):
    pairs = list(edited_copies(random.Random(3), 120))
    docs = table([(2 * k + j, t) for k, pair in enumerate(pairs) for j, t in enumerate(pair)])
    kept = {r.doc_id for r in dict(pipeline.STAGES)["near-dedup"](spark, docs, small).collect()}
    assert kept == {2 * k for k in range(len(pairs))}


def plain_components(rows, least=0.8):
    """{id: smallest id} of all that hang together with a smaller one, from all pairs."""
    sets = sorted((i, plain_shingles(t)) for i, t in rows)
    root = {i: i for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if root[i] != root[j] and a and b and min(len(a), len(b)) >= least * max(len(a), len(b)):
                shared = len(a & b)
                if shared / (len(a) + len(b) - shared) >= least:
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if v == high else v for k, v in root.items()}
    return {i: r for i, r in root.items() if i != r}


def family(rng, n, edits, words=150):
    """Copies of one text with some words changed."""
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(words), rng.choice(edits)):
            own[at] = f"changed{rng.randrange(10 ** 6)}"
        yield own


@pytest.mark.parametrize("small, counted", [(8, 64), (1, 3)])
def test_components_against_all_pairs(spark, table, small, counted):
    rng = random.Random(counted)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    base = [f"w{k}" for k in range(100)]
    for k in range(50):  # one family, and texts that share half of it
        own = list(base)
        own[rng.randrange(100)] = f"changed{k}"
        rows += [(1000 + k, " ".join(own)), (2000 + k, " ".join(base[:75] + [f"own{k}of{i}" for i in range(40)]))]
    got = {r.node: r.root for r in near.linked(table(rows), small=small, counted=counted).collect()}
    assert got == plain_components(rows)


@pytest.mark.parametrize("seed", range(2))
def test_large_families_lose_no_link(table, seed):
    """Documents around a centre, near it and far from it, and each with a further copy that only it is similar to."""
    rng = random.Random(seed)
    texts = list(family(rng, 120, [0, 1, 2, 3, 4, 5, 6]))
    for own in list(family(rng, 60, [2, 3])):
        further = list(own)
        for at in rng.sample(range(len(own)), rng.choice([2, 3])):
            further[at] = f"again{rng.randrange(10 ** 6)}"
        texts += [own, further]
    for _ in range(4):  # as long a text before as after: families that overlap
        texts += [own + more for own, more in zip(family(rng, 20, [0, 1, 2]), family(rng, 20, [0, 1, 3]), strict=True)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want = plain_components(rows)
    got = {r.node: r.root for r in near.linked(table(rows), counted=12).collect()}
    assert got == want


def test_shared_passages_are_not_compared_in_all_pairs(table, monkeypatch):
    """Texts of a common passage and words of their own, none similar: no text is compared with all others."""
    rows = [(k, " ".join([f"common{i}" for i in range(200)] + [f"own{k}of{i}" for i in range(60)])) for k in range(400)]
    sets = near._sets(table(rows).select("doc_id", "text"))
    part = sets.selectExpr("0L AS group", "doc_id", "cast(size(shingles) AS long) AS n", "shingles AS diff", "0L AS mask")
    counted, count = [], near._counted

    def watch(members, least):
        counted.append(members.groupBy("group").count().where("count > 1").count())
        return count(members, least)

    monkeypatch.setattr(near, "_counted", watch)
    assert near._refined(part, 0.8, 16).count() == 0 and sum(counted) == 0


def test_repeated_ids_take_no_clean_row_with_them(table):
    base = " ".join(f"w{k}" for k in range(60))
    docs = table([(7, base), (7, "a text of its own under the same id"), (3, base + " more"), (7, base + " again"), (None, base), (9, "other words here")])
    kept = near.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted(
        [(7, "a text of its own under the same id"), (3, base + " more"), (-1, base), (9, "other words here")])


def test_stage_keeps_texts_that_only_share_a_fingerprint(spark, table, small):
    """One shingle that makes up over half of a text sets its whole fingerprint."""
    texts = [" ".join(["-"] * 60 + [f"own{k}of{i}" for i in range(40)]) for k in range(20)] + [" ", "\n", None]
    assert len({simhash.fingerprint(t or "", 5) for t in texts}) == 2
    docs = table(list(enumerate(texts)))
    kept = dict(pipeline.STAGES)["near-dedup"](spark, docs, small)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(len(texts)))


def test_near_edge_cases(edge, nothing, table):
    assert near.linked(nothing).count() == 0 and near.survivors(nothing).count() == 0
    found = {r.node: r.root for r in near.linked(table([(5, "a b c d"), (3, "A B  C D"), (4, None), (9, " "), (None, "a b c d")])).collect()}
    assert found == {5: 3}
    assert {r.node for r in near.linked(edge).collect()} == {4, 6, 9}


@pytest.mark.parametrize("leading", [None, 12])
def test_the_tries_of_the_fingerprints_find_every_near_pair(table, leading):
    """More than the 64 bits and 3 differing ones of the query: at 0.8 nearly all such pairs differ in more."""
    pairs = list(edited_copies(random.Random(5), 150))
    texts = [t for pair in pairs for t in pair] + [" ".join(t) for t in family(random.Random(6), 200, [0, 1, 2])]
    prints = near._prints(table(list(enumerate(texts))).select("doc_id", "text"))
    found = simhash.roots(simhash.wide_links(prints.withColumnRenamed("doc_id", "id"), leading)).collect()
    assert {r.node: r.root for r in found} == {2 * k + 1: 2 * k for k in range(150)} | {300 + k: 300 for k in range(1, 200)}


def test_tries_do_not_each_link_a_family_anew(table, monkeypatch):
    """Also where no trie has all members in one group: a few links a member, not one from nearly every trie."""
    n, links, write = 400, [], components.written

    def watch(df, name, *more):
        made = write(df, name, *more)
        links.append(made.count() if name == "edges" else 0)
        return made

    monkeypatch.setattr(components, "written", watch)
    docs = table([(k, " ".join(t)) for k, t in enumerate(family(random.Random(8), n, [1, 2, 3, 4]))])
    prints = near._prints(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "id").cache()
    found = simhash.roots(simhash.wide_links(prints)).collect()
    assert {r.node: r.root for r in found} == {k: 0 for k in range(1, n)}
    assert sum(links) <= 6 * n, links


@pytest.mark.parametrize("early", [0, 1, 60])
def test_tries_walked_first_do_not_change_clusters(table, monkeypatch, early):
    rng = random.Random(9)
    texts = [t for _ in range(12) for t in family(rng, 10, [0, 1, 3, 6, 9, 12])]
    prints = near._prints(table([(k % 117, " ".join(t)) for k, t in enumerate(texts)]).select("doc_id", "text"))
    prints = prints.withColumnRenamed("doc_id", "id").cache()
    want = {r.node: r.root for r in simhash.roots(simhash.wide_links(prints)).collect()}
    monkeypatch.setattr(simhash, "EARLY", early)
    assert {r.node: r.root for r in simhash.roots(simhash.wide_links(prints)).collect()} == want


def test_first_position_of_equal_ids_in_a_group():
    at, ids = np.array([0, 0, 0, 1, 1, 2]), np.array([7, 3, 7, 7, 7, 3])
    assert simhash._first_of_equal(at, ids).tolist() == [0, 1, 0, 3, 3, 5]


def test_a_common_window_alone_links_nothing(table, spark):
    """Chance has a window agree in ever more pairs as a table grows; the whole fingerprints then differ in half their bits."""
    rng, order = np.random.default_rng(3), simhash.window_orders(*simhash.wide_tries(0))[7]
    bits = rng.integers(0, 2, (40, simhash.WIDE), np.uint8)
    bits[20:, order] = bits[:20, order]
    prints = spark.createDataFrame([(k, bytearray(np.packbits(b).tobytes())) for k, b in enumerate(bits)], "id long, fp binary")
    assert simhash.wide_links(prints).count() == 0
    bits[20:] = bits[:20]
    bits[20:, order[:5]] ^= 1  # the other windows without these have them together
    prints = spark.createDataFrame([(k, bytearray(np.packbits(b).tobytes())) for k, b in enumerate(bits)], "id long, fp binary")
    assert {(r.a, r.b) for r in simhash.wide_links(prints).collect()} == {(20 + k, k) for k in range(20)}


def test_steps_leave_no_shuffle_files(table, spark):
    """A step's shuffles go with the step, so the disk holds those of one at a time."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        names = (disk.getAllFiles().apply(k).getName() for k in range(disk.getAllFiles().size()))
        return {n for n in names if n.startswith("shuffle_")}

    docs, before = table([(k, " ".join(t)) for k, t in enumerate(family(random.Random(1), 40, [1, 2]))]), shuffled()
    gone = near.linked(docs)
    for _ in range(50):
        if left := shuffled() - before:
            time.sleep(0.2)
    assert gone.count() == 39 and len(left) <= 20, sorted(left)  # of questions asked without a table


def test_leading_bits_and_tries_grow_with_the_table():
    assert simhash.wide_tries(0) == simhash.wide_tries(1 << 20) == (8, 53)
    assert simhash.wide_tries(12_000_000) == (12, 101)


def test_stage_takes_its_pairs_from_the_tries(spark, table, small, monkeypatch):
    docs = table([(2 * k + j, t) for k, pair in enumerate(edited_copies(random.Random(4), 3)) for j, t in enumerate(pair)])
    stage = dict(pipeline.STAGES)["near-dedup"]
    assert stage(spark, docs, small).count() == 3
    monkeypatch.setattr(simhash, "wide_links", lambda prints: prints.sparkSession.createDataFrame([], "a long, b long"))
    assert stage(spark, docs, small).count() == 6


def test_few_shingles_and_one_more(table):
    rng = random.Random(7)
    texts = [[f"w{rng.randrange(10 ** 6)}" for _ in range(9)] for _ in range(3000)]
    docs = table([(2 * k + j, " ".join(t[j:])) for k, t in enumerate(texts) for j in range(2)])
    assert {r.node: r.root for r in near.linked(docs).collect()} == {2 * k + 1: 2 * k for k in range(len(texts))}
