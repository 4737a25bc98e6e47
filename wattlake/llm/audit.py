"""Interaction of filters: what every order of five filters keeps, removes and loses, from one pass over the texts.

Each document fails some of the filters A to E. A to D look at its text. E fails where an identical text has a smaller
id: an existential self-join (left semi) on hash, exact text and smaller id. Its right side is one row per repeated text,
with the smallest id, so a copy meets one row however many copies there are; only texts whose hash occurs again take
part. The ids that fail E are united with those that fail the others, the failures of an id are combined to a set of
bits, and documents are counted per part and set, at most 32 a part. All orders and steps are worked out from these counts.

With S the filters before f in an order: removed are those that fail f and none of S, redundant those that fail f and
one of S, kept those that fail neither. The Shapley sum of f adds what f removes over all orders.

- A null text counts as empty, a null source as the empty string. A null id is smaller than none and has no smaller one.
- Rows of one id are rows of their own; equal texts under one id are no copies of each other.
- Labels other than 1, and those of null ids, say nothing; several labels of an id count as 1 where one of them is.
- Every part has its 600 rows, zeros included; an empty table gives none. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import text_of, written

FILTERS = "ABCDE"
_BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
_SETS = 1 << len(FILTERS)
MIN_WORDS = 200
_COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    few = F.size(words) < MIN_WORDS
    repeated = F.size(F.array_distinct(words)) * 100 < F.size(words) * 50
    capitals = F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 2
    symbols = text.rlike(r"[#$%&*|]")
    bits = [F.when(fails, F.lit(_BIT[f])).otherwise(0) for f, fails in zip(FILTERS, (few, repeated, capitals, symbols), strict=False)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def _with_smaller(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row) of the rows whose text a smaller id has as well."""
    again = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    hashed = docs.select("row", "doc_id", F.xxhash64("text").alias("hash"), "text")
    texts = hashed.join(written(again, "audit-repeated"), "hash", "left_semi")
    firsts = written(texts.groupBy("hash", "text").agg(F.min("doc_id").alias("first")), "audit-firsts").hint("merge")
    same = (texts["hash"] == firsts["hash"]) & (texts["text"] == firsts["text"]) & (texts["doc_id"] > firsts["first"])
    return texts.join(firsts, same, "left_semi").select("row")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters that they fail."""
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text_of(F.col("text")).alias("text"))
    given = written(given, "audit-documents")
    rows = written(given.select("row", "doc_id", "part", F.xxhash64("text").alias("hash"), failures(F.col("text")).alias("bits")), "audit-rows")
    copies = _with_smaller(given, rows).select("row", F.lit(_BIT["E"]).alias("bits"))
    failed = rows.where("bits <> 0").select("row", "bits").unionByName(copies)
    failed = failed.groupBy("row").agg(F.bit_or("bits").alias("failed"))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    every = rows.select("row", "doc_id", "part").join(failed, "row", "left").join(written(marked, "audit-labels"), "doc_id", "left")
    return every.groupBy("part", F.coalesce("failed", F.lit(0)).alias("bits")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, number of the step's filter, bits of the filters before it) of all orders."""
    made = []
    for order in map("".join, permutations(FILTERS)):
        for step, f in enumerate(order, 1):
            made.append((order, step, FILTERS.index(f), sum(_BIT[g] for g in order[:step - 1])))
    return made


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    sets = combinations(docs, labels)
    by_part = sets.groupBy("part").agg(*(
        F.array(*(F.sum(F.when(F.col("bits") == b, F.col(c)).otherwise(0)) for b in range(_SETS))).alias(c) for c in _COUNTS))
    steps = F.expr("array(" + ",".join(f"named_struct('o','{o}','s',{s},'f',{f},'b',{b})" for o, s, f, b in orders()) + ")")
    filters = range(len(FILTERS))

    def total(counts: str, wanted: Callable[[int], bool]) -> str:
        """Sum of the counts of the sets that ``wanted`` names."""
        return "(" + " + ".join(f"{counts}[{b}]" for b in range(_SETS) if wanted(b)) + ")"

    def removed(counts: str, f: int, before: int) -> str:
        return total(counts, lambda b: b >> f & 1 and not b & before)

    def over(made: Callable[[int, int], str]) -> Column:
        """A value for every filter and every set of filters before it, found at f * 32 + set."""
        return F.expr("array(" + ",".join("0L" if s >> f & 1 else made(f, s) for f in filters for s in range(_SETS)) + ")")

    def shapley(f: int) -> str:
        """A set before f begins as many orders as there are orders of it, times those of the filters behind."""
        others = [s for s in range(_SETS) if not s >> f & 1]
        return " + ".join(f"{factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())} * {removed('n', f, s)}" for s in others)

    worked = by_part.select(
        "part", *(over(lambda f, s, c=c: removed(c, f, s)).alias(f"removed_{c}") for c in _COUNTS),
        over(lambda f, s: total("n", lambda b: not b & (1 << f | s))).alias("kept"),
        F.expr("array(" + ",".join(removed("n", f, 0) for f in filters) + ")").alias("fails"),
        F.expr("array(" + ",".join(f"n[{1 << f}]" for f in filters) + ")").alias("only"),
        F.expr("array(" + ",".join(shapley(f) for f in filters) + ")").alias("shapley"),
    )
    at, f = F.col("o.f") * _SETS + F.col("o.b"), F.col("o.f")
    return worked.withColumn("o", F.explode(steps)).select(
        "part", F.col("o.o").alias("filter_order"), F.col("o.s").alias("step"), F.get("kept", at).alias("kept"),
        F.get("removed_n", at).alias("removed"), (F.get("fails", f) - F.get("removed_n", at)).alias("redundant"),
        F.get("only", f).alias("unique_fails"), F.get("removed_good", at).alias("good_lost"),
        F.get("removed_toxic", at).alias("toxic_lost"), F.get("shapley", f).alias("shapley"))
