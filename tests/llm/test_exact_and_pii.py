import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattlake.llm import exact, pii


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_exact_edge_cases(spark, edge, edge_rows, nothing):
    index = exact.DigestIndex.temporary(spark, 4)
    found = exact.deduplicate(edge, index).collect()
    assert len(found) == len(edge_rows)
    groups = {}
    for i, t in edge_rows:
        groups.setdefault(sha(t), []).append(i)
    for r in found:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups) and all(r.doc_id == r.keep_id for r in kept)
    stay = exact.survivors(edge, exact.deduplicate(edge, exact.DigestIndex.temporary(spark, 4)))
    assert stay.columns == edge.columns and sorted(map(sha, (r.text for r in stay.collect()))) == sorted(groups)
    assert exact.deduplicate(nothing, exact.DigestIndex.temporary(spark, 4)).count() == 0


def test_a_batch_is_added_in_turns_by_anti_join(spark, table, monkeypatch):
    """The upper ids are in the index before the lower ones, whose copies of them are not appended."""
    rows = [(k, f"text {k % 7}" if k % 3 else f"own {k}") for k in range(60)] + [(None, "text 1"), (None, "only null"), (59, "own 59")]
    appended, append = [], exact.DigestIndex.append

    def watched(index, entries):
        before = index.rows().count()
        append(index, entries)
        appended.append((before, entries.count(), index.rows().count() - before))

    monkeypatch.setattr(exact.DigestIndex, "append", watched)
    for turns in (1, 2, 5):
        appended.clear()
        index = exact.DigestIndex.temporary(spark, 4)
        got = exact.deduplicate(table(rows), index, turns=turns).collect()
        index.forget()
        assert not index.exists() and len(appended) == turns
        assert turns == 1 or (appended[1][0] > 0 and appended[1][2] < appended[1][1])
        for r in got:
            ids = [i for i, t in rows if sha(t) == r.text_sha256]
            assert (r.keep_id, r.group_size) == (max((i for i in ids if i is not None), default=None), len(ids))
        assert len(got) == len(rows) and sum(r.kept for r in got) == len({t for _, t in rows})


def test_survivors_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", "x", "y"), (2, "a", "p", "q")], "doc_id long, text string, __id string, __digest string")
    stay = exact.survivors(docs, exact.deduplicate(docs, exact.DigestIndex.temporary(spark, 4)))
    assert stay.columns == docs.columns and [tuple(r) for r in stay.collect()] == [(2, "a", "p", "q")]


def test_index_outlives_a_batch(spark, table):
    index = exact.DigestIndex.temporary(spark, 4)
    first = table([(1, "a"), (2, "a"), (3, "b")])
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact.deduplicate(first, index).collect()} == {(1, 2, False), (2, 2, True), (3, 3, True)}
    second = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.deduplicate(table([(9, "a"), (8, "c")]), index).collect()}
    assert second == {(9, 2, 1, False), (8, 8, 1, True)}
    assert index.rows().count() == 3
    again = exact.deduplicate(first, index).collect()
    assert not any(r.kept for r in again) and index.rows().count() == 3


def plain_base(text):
    """The base kinds as their definition has them, with nothing made faster."""
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.b-@+%_ 0123456789()٣é\n", max_size=80))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == plain_base(text)


def test_spans_that_look_like_data():
    rng = random.Random(5)
    for _ in range(2000):
        text = " ".join(rng.choice(["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "1.2.3.4.5.6.7.8", "300.1.1.1",
                                    "a@b.c@d.e.f", "x..y@z", "9" * rng.randint(1, 30), "+" + "1 " * rng.randint(1, 20), "é"])
                        for _ in range(rng.randint(0, 6)))
        assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == plain_base(text)


def test_checksums_and_words_nearby():
    assert [s[0] for s in pii.find("pay to GB82 WEST 1234 5698 7654 32 now")] == ["iban"]
    assert pii.find("pay to GB83 WEST 1234 5698 7654 32 now") == []
    assert pii.find("number 078-05-1120 is here") == []
    assert [s[0] for s in pii.find("her SSN is 078-05-1120.")] == ["ssn"]
    near, plain, against = (pii.find(f"{w} 4111111111111111")[0][3] for w in ("visa", "thing", "order"))
    assert near > plain > against


@pytest.mark.parametrize("text, number", [
    ("IBAN DE89370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000"),
    ("GB82WEST12345698765432 20 May", "GB82WEST12345698765432"),
    ("DE89370400440532013000 A note", "DE89370400440532013000"),
    ("DE89 3704 0044 0532 0130 00 0042 EUR", "DE89 3704 0044 0532 0130 00"),
    ("ref AB12 GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 32"),
    ("ZZ59 1234 5678 9012 3456 A NOTE", "ZZ59 1234 5678 9012 3456"),
])
def test_an_iban_ends_before_what_follows(text, number):
    start = text.index(number)
    assert [s[:3] for s in pii.find(text) if s[0] == "iban"] == [("iban", start, start + len(number))]


def test_ibans_in_a_row():
    numbers = ["DE89370400440532013000", "GB82WEST12345698765432", "NO9386011117947"]
    text = " ".join(numbers)
    assert [text[s:e] for k, s, e, _ in pii.find(text) if k == "iban"] == numbers
    assert [s for s in pii.find("AB12 " * 40_000) if s[0] == "iban"] == []


def test_pii_edge_cases(edge, edge_rows, nothing, table):
    assert edge.count() == pii.digest(edge).count() and pii.digest(nothing).count() == 0
    assert {r.spans for r in pii.digest(edge).collect()} == {""}
    docs = table([(1, "😀 a@b.cd and 1.2.3.4"), (2, None), (3, "9" * 200_000 + "@" * 200_000 + "+" * 200_000)])
    found = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert found[1].spans == "email:2:8,ip:13:20" and (found[1].n_email, found[1].n_ip, found[1].n_card) == (1, 1, 0)
    assert found[2].spans == "" and found[3].n_email == 0
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    assert {r.doc_id: r.text for r in masked.where("doc_id < 3").collect()} == {1: "😀 [EMAIL] and [IP]", 2: None}
