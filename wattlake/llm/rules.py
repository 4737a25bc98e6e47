"""Quality rules under weak supervision: rules vote or abstain, and what their votes are worth is learned without labels.

A rule looks at a measure of a text and votes for good or for bad, or abstains where the measure says little: that a text
has no fault of some kind is no reason to call it good, so most rules vote against or abstain, and those on what prose
is like vote both ways. Votes are counted by pattern over all documents, at most 3 ** rules rows. Expectation-maximisation starts from all-must-pass (a
document with a vote against it is bad), then in turns estimates for either class how often each rule votes which way,
and from that each pattern's probability of being good, until the probabilities stand still. A rule whose votes go
against the others' loses its weight. A document is kept where its probability is at least ``KEPT`` and it passes the
two base rules.

DataFrame operations only: measures are array expressions inside a row, an iteration is one aggregation over the patterns.

- Words are what stands between ASCII white space; a null text has none. Three-word windows are told apart by 64 bits of hash.
- One row per input row; ids may repeat or be null; other columns play no part. An empty table gives no rows.
- Texts of any length are measured whole, in n log n time.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.text import let
from wattlake.llm.common import id_and_text, written

BLANKS = "\t\n\x0b\x0c\r "
KEPT = 0.5
#: What a document without, or with, a vote against it has at the start.
START_GOOD, START_BAD = 0.9, 0.1
ITERATIONS = 40
STILL = 1e-6
#: Votes that each class is taken to have cast each way beforehand.
PRIOR = 1.0

#: A word of letters, with one mark at its end or none; and a word that ends with a letter and a mark.
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}+(?:['’-]\p{L}+)*[.,;:?!]?(?![^\x20\x09-\x0D])"
ENDED = r"\p{L}[.,;:?!](?![^\x20\x09-\x0D])"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Measures that only the rules read.
FURTHER = ("n_lines", "n_capitals", "n_exclaimed", "n_distinct", "n_plain", "n_ended")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(bad: Column, good: Column | None = None) -> Column:
    """1 for good, 0 for bad, null where the rule abstains."""
    return F.when(bad, 0) if good is None else F.when(bad, 0).when(good, 1)


def rules() -> dict[str, Column]:
    """Votes by name, over the measures."""
    length, words = _share("word_chars", "n_words"), F.col("n_words")
    plain, ended = _share("n_plain", "n_words"), _share("n_ended", "n_words")
    return {
        "length": _vote(words < 20),
        "word_length": _vote((length < 2) | (length > 15)),
        "symbols": _vote(_share("n_symbols", "n_words") > 0.1),
        "shouting": _vote((_share("n_capitals", "word_chars") > 0.3) | (_share("n_exclaimed", "n_words") > 0.2)),
        "lines": _vote(_share("n_dup_lines", "n_lines") > 0.3),
        "repetition": _vote((_share("n_repeat_words", "n_words") > 0.3) | ((_share("n_distinct", "n_words") < 0.25) & (words < 1000))),
        "plain_words": _vote(plain < 0.6, plain > 0.9),
        "sentences": _vote(ended < 0.02, ended.between(0.04, 0.5)),
    }


def _covered(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in ``words``."""

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def places(h: Column) -> Column:
        """Where repeated windows begin, in order."""
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def same(x: Column, k: Column) -> Column:
                return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

            return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

        return F.sort_array(F.transform(let(pairs, repeated), lambda x: x["i"]))

    def spread(p: Column) -> Column:
        """Each window adds the words that the one before it does not cover."""
        return F.aggregate(
            p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(spread(places(h)))

    return F.when(F.size(words) < 3, 0).otherwise(let(hashed(words), count))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, all measures) of every row."""
    trimmed = F.btrim("text", F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    given = id_and_text(docs, id_col, text_col).select("doc_id", "text", words.alias("words"), lines.alias("lines"))

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    made = {
        "n_words": F.size("words"), "word_chars": F.length(F.array_join("words", "")), "n_symbols": count(r"[#*$%&|<>]"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": _covered(F.col("words")),
        "n_lines": F.size("lines"), "n_capitals": count("[A-Z]"), "n_exclaimed": count("!"),
        "n_distinct": F.size(F.array_distinct("words")), "n_plain": count(PLAIN), "n_ended": count(ENDED),
    }
    return given.select("doc_id", *(made[c].cast("long").alias(c) for c in (*MEASURES, *FURTHER)))


def _by_vote(vote: Column, values: tuple[float, float, float]) -> Column:
    bad, good, none = values
    return F.when(vote == 0, bad).when(vote == 1, good).otherwise(none)


class Model:
    """Per class, how often each rule votes bad, good or not at all; and how many documents are good."""

    def __init__(self, good: float, of_good: dict[str, tuple[float, float, float]], of_bad: dict[str, tuple[float, float, float]]):
        self.good, self.of_good, self.of_bad = good, of_good, of_bad

    def probability(self) -> Column:
        """Of being good, from the columns of votes."""
        odds = F.lit(log(self.good / (1 - self.good)))
        for name, shares in self.of_good.items():
            odds += _by_vote(F.col(name), tuple(log(g / b) for g, b in zip(shares, self.of_bad[name], strict=True)))
        return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, names: list[str], iterations: int = ITERATIONS) -> Model | None:
    """Expectation-maximisation over the patterns of votes of all rows; nothing without rows."""
    patterns = written(votes.groupBy(*names).agg(F.count("*").alias("n")).repartition(1), "vote-patterns", tuple(names))
    against = F.least(*(F.coalesce(F.col(c), F.lit(1)) for c in names)) == 0
    probability, before = F.when(against, START_BAD).otherwise(START_GOOD), None
    model = None
    for _ in range(iterations):
        weighed = patterns.withColumn("p", probability).select(
            *names, (F.col("n") * F.col("p")).alias("good"), (F.col("n") * (1 - F.col("p"))).alias("bad"))
        sums = [F.sum(c).alias(c) for c in ("good", "bad")]
        sums += [F.sum(F.when(F.col(r) == v, F.col(c)).otherwise(0.0)).alias(f"{c}_{r}_{v}") for c in ("good", "bad") for r in names for v in (0, 1)]
        got = weighed.agg(*sums).first()
        if got["good"] is None:
            return None

        def shares(c: str, got=got) -> dict[str, tuple[float, float, float]]:
            whole = got[c] + 3 * PRIOR
            made = {}
            for r in names:
                bad, good = ((got[f"{c}_{r}_{v}"] + PRIOR) / whole for v in (0, 1))
                made[r] = (bad, good, max(1 - bad - good, 1e-12))
            return made

        model = Model((got["good"] + PRIOR) / (got["good"] + got["bad"] + 2 * PRIOR), shares("good"), shares("bad"))
        now = [model.good, *(x for d in (model.of_good, model.of_bad) for t in d.values() for x in t)]
        if before and max(abs(a - b) for a, b in zip(now, before, strict=True)) < STILL:
            break
        probability, before = model.probability(), now
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", make: Callable[[], dict[str, Column]] = rules) -> DataFrame:
    """(doc_id, base measures, base_failed, kept, probability) of every row."""
    votes = make()
    measured = measure(docs, id_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = written(measured.select("doc_id", *MEASURES, failed.alias("base_failed"), *(v.cast("int").alias(f"vote_{n}") for n, v in votes.items())), "votes")
    model = fit(voted, [f"vote_{n}" for n in votes])
    probability = F.lit(None).cast("double") if model is None else model.probability()
    return voted.select("doc_id", *MEASURES, "base_failed", probability.alias("probability")).select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & (F.col("probability") >= KEPT)).alias("kept"), "probability")
