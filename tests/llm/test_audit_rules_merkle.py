"""Filter audit, voted rules and the Merkle manifest against plain Python."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from wattlake.llm import audit, merkle, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit ------------------------------------------------------------


def plain_audit(docs, labels):
    """docs: (doc_id, text, source); every order is carried out document by document."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, t, source in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and i > first.get(t, i):
            fails.add("E")
        rows.append((source or "", i, fails))
    made, removed_by = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                made[part, order, step] = [
                    len(left), len(out), sum(f in r[2] for r in gone), sum(r[2] == {f} for r in rows if r[0] == part),
                    sum(r[1] in good for r in out), sum(r[1] in toxic for r in out)]
                removed_by[part, f] += len(out)
                gone += out
    return {k: [*v, removed_by[k[0], k[1][k[2] - 1]]] for k, v in made.items()}


def audited(spark, docs, labels):
    given = spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in docs], "doc_id long, text string, source string, part string, bits string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(given, told).collect()
    values = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r.part, r.filter_order, r.step): [r[c] for c in values] for r in got}
    assert len(found) == len(got)
    return found


def test_audit_against_every_order(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [(1, long, "a"), (2, long, "b"), (3, long, "a"), (4, None, None), (5, "", "a"), (6, "", None), (None, long, "a"), (7, "x " * 300, "a"),
            (8, long + " #", "b"), (9, "SHOUT " * 10, "b"), (9, "SHOUT " * 10, "b"), (10, "SHOUT " * 10, ""), (11, "é" * 99 + "AA", "a"), (None, None, None)]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (7, 0, 1), (9, 1, 1), (99, 1, 1), (None, 1, 1), (5, None, 1)]
    got = audited(spark, docs, labels)
    assert got == plain_audit(docs, labels)
    assert len(got) == 3 * 600
    assert got["b", "EABCD", 1][1] == 1 and got["", "EABCD", 1][1] == 2


def test_audit_of_nothing(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    assert len(audited(spark, [(1, None, None)], [])) == 600


def test_orders():
    made = audit.orders()
    assert len(made) == 600 and len({m[0] for m in made}) == 120
    assert all(bin(b).count("1") == s - 1 and not b >> f & 1 for _, s, f, b in made)


# --- voted rules -------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    seen, again = set(), 0
    lines = [line for line in text.split("\n") if WORD.search(line)]
    for line in lines:
        again += line in seen
        seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": again,
        "n_repeat_words": len(covered), "n_lines": len(lines), "n_capitals": sum("A" <= c <= "Z" for c in text), "n_exclaimed": text.count("!"),
        "n_distinct": len(set(words)),
        "n_plain": sum(regex.fullmatch(r"\p{L}+(['’-]\p{L}+)*[.,;:?!]?", w) is not None for w in words),
        "n_ended": sum(regex.search(r"\p{L}[.,;:?!]$", w) is not None for w in words)}


def measured(spark, rows):
    got = rules.measure(spark.createDataFrame([(k, t, 7) for k, t in enumerate(rows)], "doc_id long, text string, words int")).collect()
    return [{c: r[c] for c in (*rules.MEASURES, *rules.FURTHER)} for r in sorted(got)]


def test_measures_on_cases(spark):
    rows = [None, "", " \n\t\r\x0b\x0c ", "a", "a b", "a a a", "a a a a", "a b c a b c", "x a b c y a b c z", "one\none\n\n \n one\none", "#|#",
            "a b a b a b a b", "A-Z É Z", "t " * 5000 + "u", " ".join(f"w{k % 700}" for k in range(20_000)), "\x1cx\x1d y",
            "a b c d e f a b c d e f g a b"]
    assert measured(spark, rows) == [plain_measures(t) for t in rows]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab A#|\n\t!é.'’-", max_size=60), min_size=10, max_size=30))
def test_measures_on_random_texts(spark, rows):
    assert measured(spark, rows) == [plain_measures(t) for t in rows]


def plain_votes(m):
    share = lambda a, b="n_words": m[a] / max(m[b], 1)
    vote = lambda bad, good=False: 0 if bad else 1 if good else None
    return [
        vote(m["n_words"] < 20), vote(share("word_chars") < 2 or share("word_chars") > 15), vote(share("n_symbols") > 0.1),
        vote(share("n_capitals", "word_chars") > 0.3 or share("n_exclaimed") > 0.2), vote(share("n_dup_lines", "n_lines") > 0.3),
        vote(share("n_repeat_words") > 0.3 or share("n_distinct") < 0.25 and m["n_words"] < 1000),
        vote(share("n_plain") < 0.6, share("n_plain") > 0.9), vote(share("n_ended") < 0.02, 0.04 <= share("n_ended") <= 0.5)]


def plain_posteriors(votes):
    """Expectation-maximisation document by document."""
    p = [0.1 if 0 in v else 0.9 for v in votes]
    before = None
    for _ in range(rules.ITERATIONS):
        total = sum(p), sum(1 - x for x in p)
        share = [[[(sum(w for w, v in zip(weights, votes, strict=True) if v[j] == kind) + 1) / (whole + 3) for kind in (0, 1)]
                  for j in range(len(votes[0]))] for weights, whole in ((p, total[0]), ([1 - x for x in p], total[1]))]
        share = [[(b, g, max(1 - b - g, 1e-12)) for b, g in c] for c in share]
        prior = (total[0] + 1) / (sum(total) + 2)
        now = [prior, *(x for c in share for t in c for x in t)]
        odds = [math.log(prior / (1 - prior)) + sum(
            math.log(g[2 if x is None else x] / b[2 if x is None else x]) for x, g, b in zip(v, *share, strict=True)) for v in votes]
        p = [1 / (1 + math.exp(-o)) for o in odds]
        if before and max(abs(a - b) for a, b in zip(now, before, strict=True)) < rules.STILL:
            break
        before = now
    return p


def test_verdicts_against_plain_python(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-k, t) for k, t in enumerate([None, "", "ok " * 30, "fine words here " * 20], 1)]
    measures = [plain_measures(t) for _, t in docs]
    p = plain_posteriors([plain_votes(m) for m in measures])
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs)
    for (i, _), m, chance in zip(docs, measures, p, strict=True):
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert [got[i][c] for c in rules.MEASURES] == [m[c] for c in rules.MEASURES]
        assert got[i].base_failed == failed
        assert abs(got[i].probability - chance) < 1e-6
        assert got[i].kept == (not failed and chance >= rules.KEPT)


def test_verdicts_agree_with_labels_never_read(spark):
    """Labels are for measuring only."""
    folder = "/root/testdata/sf0.01"
    judged = rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = judged.join(labels, "doc_id").select("kept", "quality", "base_failed", "n_words").collect()
    kept_good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    kept_bad = [r.kept for r in rows if r.quality == 0]
    assert sum(kept_good) / len(kept_good) >= 0.95
    assert sum(kept_bad) / len(kept_bad) <= 0.1


def test_a_rule_against_the_others_loses_its_weight(spark):
    """Four rules agree on which documents are bad, a fifth votes at random."""
    rows = []
    for k in range(400):
        bad = k % 4 == 0
        rows.append((k, *(0 if bad else 1 for _ in range(4)), zlib.crc32(str(k).encode()) % 2))
    votes = spark.createDataFrame(rows, "doc_id long, a int, b int, c int, d int, e int")
    model = rules.fit(votes, list("abcde"))
    told = {r.doc_id: r.p for r in votes.withColumn("p", model.probability()).collect()}
    assert all((told[k] > 0.5) == (k % 4 != 0) for k in range(400))
    assert abs(model.of_good["e"][0] - model.of_bad["e"][0]) < 0.15 < model.of_bad["a"][0] - model.of_good["a"][0]


def test_verdict_edge_cases(spark, edge, edge_rows, nothing):
    assert rules.judge(nothing).collect() == []
    got = rules.judge(edge).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got if r.doc_id is not None) == sorted((i is None, i) for i, _ in edge_rows if i is not None)
    assert len(got) == len(edge_rows)


# --- Merkle manifest ---------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    """The top, and for every leaf its siblings (left, right) from below."""
    paths = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[k:k + 16] for k in range(0, len(digests), 16)]
        for leaf, node in enumerate(at):
            run = runs[node // 16]
            paths[leaf].append(("".join(run[:node % 16]), "".join(run[node % 16 + 1:])))
            at[leaf] = node // 16
        digests = [h(*run) for run in runs]
    return (digests[0] if digests else None), paths


def plain_manifest(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    parts = defaultdict(list)
    for row in docs:
        parts[row[1]].append(row)
    order = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    subs, made = [], []
    for s in order:
        rows = sorted(parts[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        top, paths = plain_tree([plain_leaf(r) for r in rows])
        subs.append(top)
        made.append((rows, paths, top))
    root, tops = plain_tree(subs)
    out = []
    for (rows, paths, sub), above in zip(made, tops, strict=True):
        for row, path in zip(rows, paths, strict=True):
            path = path + above
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4]))
            node = plain_leaf(changed)
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], plain_leaf(row), sub, root, h(*(x for p in path for x in p)), node, node == root))
    return out


def verified(spark, docs):
    frame = spark.createDataFrame([(*r, "p", "d") for r in docs], "doc_id long, source string, lang string, n_chars long, text string, path string, digest string")
    return [tuple(r) for r in merkle.verify(frame).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("sizes", [
    {"one": 1}, {"one": 1, "two": 1}, {"big": 273, "seventeen": 17, "single": 1, None: 16, "": 2}, {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_manifest_against_plain_python(spark, sizes):
    docs, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            k += 1
            docs.append((k * 7 % 1009, source, "en" if k % 3 else None, k if k % 5 else None, f"Text É {k}" if k % 4 else None))
    assert sorted(verified(spark, docs), key=key) == sorted(plain_manifest(docs), key=key)


def test_manifest_of_repeated_rows_and_nulls(spark):
    row = (5, "s", "en", 1, "Same")
    docs = [row] * 40 + [(5, "s", "en", 1, None), (5, "s", None, None, ""), (None, "s", "en", 1, "X"), (None, None, None, None, None), (None, "s", "en", 1, "X")]
    assert sorted(verified(spark, docs), key=key) == sorted(plain_manifest(docs), key=key)


def test_manifest_of_nothing(spark):
    assert verified(spark, []) == []


def test_tampering_shows(spark):
    docs = [(k, "s", "en", 1, f"Capital {k}") for k in range(50)] + [(k, "s", "en", 1, f"small {k}") for k in range(50, 100)]
    for doc_id, *_, ok in verified(spark, docs):
        assert ok == (doc_id >= 50 or zlib.crc32(str(doc_id).encode()) % 5 != 0)


def test_some_leaves_are_proved_alone(spark):
    docs = [(k, f"s{k % 3}", "en", 1, f"text {k}") for k in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(frame.select("doc_id", "source", merkle.leaf_of(*(frame[c] for c in merkle.COLUMNS)).alias("leaf")))
    few = merkle.prove(manifest, manifest.leaves.where("doc_id IN (0, 17, 119)"))
    got = few.select("doc_id", merkle.folded(few["leaf"], few["segments"]).alias("top")).collect()
    assert sorted(r.doc_id for r in got) == [0, 17, 119] and {r.top for r in got} == {manifest.root}
