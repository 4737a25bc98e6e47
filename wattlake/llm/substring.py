"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``WINDOW`` consecutive words. Every word covered by a window that also starts elsewhere is removed.

1. *Anchors.* The smallest hashed ``GRAM``-word gram of a window is its anchor; equal windows have equal anchors at equal
   offsets, and an anchor serves some dozen windows. An anchor met once in the corpus ends the matter for its windows.
2. *Reference.* The first occurrence of each repeated anchor, with the windows it serves, is a reference block, indexed
   by the anchor. Blocks met very often exist in several parts of at most about ``PART`` occurrences each.
3. *Parsing.* Every other occurrence is factored against its block: the longest run of windows that agree is a factor,
   which marks both the document and the block.
4. *Factor boundaries.* Windows past the end of their factor, and the blocks of anchors in several parts, are compared
   among each other by one aggregation, so nothing hangs on which block was the reference.

Texts are handled once per distinct text, in a table bucketed by their hash, which is read three times and shuffled
once; a text that occurs twice has all its windows elsewhere. Windows are compared by 128 bits of hashes.

- Words are separated by ASCII white space and kept as they are. Null and empty texts have no words.
- One row per input row; ids may repeat or be null. Texts of any length are processed in linear time and memory of a
  small multiple of the text. Other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from wattlake.llm.common import batches_of, id_and_text, rows, text_of, written
from wattlake.session import new_folder

WINDOW = 35
GRAM = 8
#: Occurrences of one anchor that share a reference block.
PART = 4000
CACHED_WORDS = 400_000
_STEP = 1 << 16

_random = np.random.default_rng(20)
_GRAM_WEIGHTS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_WINDOW_WEIGHTS = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        made = xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = made
        return made

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _rolled(hashes: np.ndarray, width: int, weights: np.ndarray) -> np.ndarray:
    """A hash of every ``width`` consecutive ones."""
    n = len(hashes) - width + 1
    made = np.zeros(n, np.uint64)
    for k in range(width):
        made += hashes[k:k + n] * weights[k]
    made ^= made >> np.uint64(32)
    made *= np.uint64(0x9E3779B97F4A7C15)
    made ^= made >> np.uint64(29)
    return made


def anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams; for every window, where its anchor starts (the first of the smallest grams)."""
    grams = _rolled(hashes, gram, _GRAM_WEIGHTS)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    found = np.empty(len(view), np.int64)
    for at in range(0, len(view), _STEP):
        part = view[at:at + _STEP]
        found[at:at + _STEP] = part.argmin(1) + np.arange(at, at + len(part))
    return grams, found


def text_id(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def _distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(t1, t2, n, text) as a table bucketed by the text's id."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"distinct_texts_{uuid.uuid4().hex[:12]}"
    text = text_of(docs[text_col])
    once = docs.select(text.alias("text"), *text_id(text)).groupBy("t1", "t2").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    once.write.bucketBy(buckets, "t1", "t2").option("path", new_folder(spark, name)).saveAsTable(name)
    return spark.table(name)


def _anchor_rows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, t1, t2, n): how often each text has each of its anchors."""
    schema = pa.schema([("key", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()), ("n", pa.int32())])

    def run(batches):
        known = WordHashes()
        for t1, t2, text in rows(batches, "t1", "t2", "text"):
            words = text.encode().split()
            if len(words) < window:
                continue
            grams, found = anchors(known.of(words), window, gram)
            keys, counts = np.unique(grams[np.unique(found)], return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), t1)), pa.array(np.full(len(keys), t2)),
                pa.array(counts.astype(np.int32)),
            ], schema=schema)

    return texts.select("t1", "t2", "text").mapInArrow(_joined(run, schema), "key long, t1 long, t2 long, n int")


def _joined(run, schema: pa.Schema, size: int = 8192):
    """``run`` with its small batches put together."""

    def grouped(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches(max_chunksize=4 * size)
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches(max_chunksize=4 * size)

    return grouped


def _occurrences(texts: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, part, t1, t2, anchor, first, windows): the windows each repeated anchor serves, from window ``first`` on."""
    schema = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("t1", pa.int64()), ("t2", pa.int64()), ("anchor", pa.int32()),
                        ("first", pa.int32()), ("windows", pa.list_(pa.int64()))])

    def run(batches):
        known = WordHashes()
        for t1, t2, text, keys, parts in rows(batches, "t1", "t2", "text", "keys", "parts"):
            hashes = known.of(text.encode().split())
            grams, found = anchors(hashes, window, gram)
            at, first, served = np.unique(found, return_index=True, return_counts=True)
            keys = np.array(keys, np.int64)
            order = np.argsort(keys)
            keys, parts = keys[order], np.array(parts, np.int32)[order]
            own = grams[at].view(np.int64)
            place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == own)
            if not len(hit):
                continue
            of = parts[place[hit]]
            dealt = np.where(of > 1, (at[hit] * 7919 + t1 % 1_000_003) % of, -1).astype(np.int32)
            made = _rolled(hashes, window, _WINDOW_WEIGHTS).view(np.int64)
            counts = served[hit]
            ends = np.cumsum(counts)
            picked = np.repeat(first[hit] - (ends - counts), counts) + np.arange(ends[-1])
            yield pa.RecordBatch.from_arrays([
                pa.array(own[hit]), pa.array(dealt), pa.array(np.full(len(hit), t1)), pa.array(np.full(len(hit), t2)),
                pa.array(at[hit].astype(np.int32)), pa.array(first[hit].astype(np.int32)),
                pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), pa.array(made[picked])),
            ], schema=schema)

    given = texts.join(wanted, ["t1", "t2"]).select("t1", "t2", "text", "keys", "parts")
    return given.mapInArrow(_joined(run, schema, 2048), "key long, part int, t1 long, t2 long, anchor int, first int, windows array<long>")


def _parsed(occurrences: DataFrame) -> DataFrame:
    """(t1, t2, start, n, key, at, window): ``n`` windows from ``start`` are factors, or (n = 0) one window to compare.

    ``at``: where the anchor starts, counted from the window.
    """
    ddl = "t1 long, t2 long, start int, n int, key long, at int, window long"
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("key", pa.int64()),
                        ("at", pa.int32()), ("window", pa.int64())])

    def run(batches):
        return batches_of(_factors(rows(batches, "key", "part", "t1", "t2", "anchor", "first", "windows")), schema, 8192)

    placed = occurrences.repartition("key", "part").sortWithinPartitions("key", "part", "t1", "t2", "anchor")
    return placed.mapInArrow(run, ddl)


def _factors(occurrences: Iterator[tuple]) -> Iterator[tuple]:
    block, met = None, set()

    def closed():
        if block:
            key, part, t1, t2, anchor, windows = block
            yield from _runs(t1, t2, [anchor - at for at in met])
            if part >= 0:  # other parts have blocks of their own
                yield from ((t1, t2, anchor - at, 0, key, at, w) for at, w in windows.items())

    for key, part, t1, t2, anchor, first, windows in occurrences:
        own = {anchor - first - k: w for k, w in enumerate(windows)}
        if not block or block[:2] != (key, part):
            yield from closed()
            block, met = (key, part, t1, t2, anchor, own), set()
            continue
        reference = block[5]
        same = [at for at, w in own.items() if reference.get(at) == w]
        met.update(same)
        yield from _runs(t1, t2, [anchor - at for at in same])
        if len(same) < len(own):
            same = set(same)
            yield from ((t1, t2, anchor - at, 0, key, at, w) for at, w in own.items() if at not in same)
    yield from closed()


def _runs(t1: int, t2: int, starts: list[int]) -> Iterator[tuple]:
    """Neighbouring windows as one factor."""
    starts.sort()
    begin = 0
    for k in range(1, len(starts) + 1):
        if k == len(starts) or starts[k] != starts[k - 1] + 1:
            yield t1, t2, starts[begin], k - begin, None, None, None
            begin = k


def _spans(texts: DataFrame, window: int, gram: int, part: int) -> DataFrame:
    """(t1, t2, starts, counts): runs of windows that start elsewhere too."""
    found = written(_anchor_rows(texts, window, gram), "anchors")
    repeated = found.groupBy("key").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.min("t1").alias("a1"), F.max("t1").alias("b1"),
        F.min("t2").alias("a2"), F.max("t2").alias("b2"),
    ).where("most > 1 OR a1 <> b1 OR a2 <> b2").select("key", F.ceil(F.col("n") / part).cast("int").alias("parts"))
    wanted = found.join(repeated, "key").select("t1", "t2", F.struct("key", "parts").alias("a"))
    wanted = wanted.groupBy("t1", "t2").agg(F.collect_list("a").alias("a")).select(
        "t1", "t2", F.col("a.key").alias("keys"), F.col("a.parts").alias("parts"))
    parsed = written(_parsed(_occurrences(texts, wanted, window, gram)), "factors")
    boundary = parsed.where("n = 0")
    elsewhere = boundary.groupBy("key", "at", "window").agg(F.count("*").alias("met")).where("met > 1")
    also = boundary.join(elsewhere, ["key", "at", "window"]).select("t1", "t2", "start", F.lit(1).alias("n"))
    runs = parsed.where("n > 0").select("t1", "t2", "start", "n").unionByName(also)
    return runs.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "n")).alias("r")).select(
        "t1", "t2", F.col("r.start").alias("starts"), F.col("r.n").alias("counts"))


def kept_words(words: list[bytes], copied: bool, starts: list[int], counts: list[int], window: int) -> np.ndarray:
    """Which words stay."""
    n = len(words)
    if copied and n >= window:
        return np.zeros(n, bool)
    edges = np.zeros(n + 1, np.int64)
    if starts:
        begin = np.array(starts)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + np.array(counts) + window - 1, -1)
    return np.cumsum(edges[:n]) == 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   part: int = PART, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), and with ``with_text`` the kept words joined by spaces as kept_text."""
    texts = _distinct_texts(docs, text_col)
    spans = written(_spans(texts, window, gram, part), "spans")
    fields = [("t1", pa.int64()), ("t2", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept_text", pa.string())] * with_text)

    def run(batches):
        def made():
            for t1, t2, n, text, starts, counts in rows(batches, "t1", "t2", "n", "text", "starts", "counts"):
                words = text.encode().split()
                stay = kept_words(words, n > 1, starts or [], counts or [], window)
                kept = b" ".join([words[k] for k in np.flatnonzero(stay)] if not stay.all() else words)
                yield (t1, t2, len(words), int(len(words) - stay.sum()), hashlib.sha256(kept).hexdigest(), *([kept.decode()] * with_text))

        return batches_of(made(), schema, 1024)

    ddl = "t1 long, t2 long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    done = texts.join(spans, ["t1", "t2"], "left").select("t1", "t2", "n", "text", "starts", "counts").mapInArrow(run, ddl)
    plain = id_and_text(docs, id_col, text_col)
    ids = plain.select("doc_id", *text_id(F.col("text")))
    return ids.join(done.hint("merge"), ["t1", "t2"]).drop("t1", "t2")
