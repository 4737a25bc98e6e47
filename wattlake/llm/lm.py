"""Language-model scores by stupid backoff, computed relationally.

The count of an n-gram is a sum over the whole corpus. Documents are taken in shards of ``SHARD_ROWS`` rows. Each shard's
distinct n-grams, with their counts, are dealt to buckets by the leading bits of their hashes: one row (bucket, shard,
keys, counts) for each pair. A bucket holds its part of the count table, about ``BUCKET_KEYS`` keys; it sums the counts
and sends every shard the totals of its keys, in their order. There they are joined with the shard's documents, the
n-grams of each document are looked up and the logarithms are summed. A frequent n-gram is one key per shard, not one
per occurrence, so no key is hot, and buckets are even.

    S(w | u) = c(u w) / c(u)          where c(u w) >= MIN_COUNT
             = BACKOFF * c(w) / N     otherwise

and likewise for higher orders; a document's first words have shorter contexts. An n-gram seen once, which is in the
scored document itself, is no evidence, hence the least count of 2. N-grams are told apart by 64 bits of hash.

- Words are separated by ASCII white space and kept as they are. The score is the mean natural logarithm per word, rounded
  to ``DIGITS`` digits; without words (null or empty text) it is null.
- One row per input row; ids may repeat or be null; other columns play no part; an empty table gives no rows.
- Memory in a task is a small multiple of a shard's text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from wattlake.llm.common import batches_of, rows, text_of, written

ORDER = 2
BACKOFF = 0.4
MIN_COUNT = 2
DIGITS = 6
SHARD_ROWS = 8192
#: N-grams held before a shard's counts are passed on; a shard may pass on several times.
HELD = 8_000_000
CACHED_WORDS = 400_000
#: Distinct keys a shard is reckoned to have, and those a bucket shall have, of all shards together.
SHARD_KEYS = 4_000_000
BUCKET_KEYS = 2_000_000
#: The key whose count is the number of words in the corpus.
WORDS = 0

_WEIGHTS = np.random.default_rng(7).integers(1, 1 << 63, (8, 8), dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        made = xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = made
        return made


def keys_of(text: str, order: int, known: _Hashes) -> list[np.ndarray]:
    """For n = 1 to ``order`` the keys of all n-grams, by where they begin."""
    words = text.encode().split()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    made = []
    for n in range(1, order + 1):
        total = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            total += hashes[k:k + len(total)] * _WEIGHTS[n - 1, k]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        made.append(total)
    return made


def _sharded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(shard, doc_id, text): shards are stretches of rows of one file, found again by any later scan."""
    try:
        placed = docs.select(id_col, text_col, "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:  # not read from files
        docs = written(docs.select(id_col, text_col), "lm-documents")
        placed = docs.select(id_col, text_col, "_metadata.file_path", "_metadata.row_index")
    shard = F.xxhash64("file_path", F.floor(F.col("row_index") / SHARD_ROWS))
    return placed.select(shard.alias("shard"), F.col(id_col).cast("long").alias("doc_id"), text_of(placed[text_col]).alias("text"))


def _asked(docs: DataFrame, order: int, bits: int) -> DataFrame:
    """(bucket, shard, keys, counts): how often a shard has its n-grams, in the order of their unsigned keys."""
    schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])

    def counted(shard: int, held: list[np.ndarray], words: int) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        keys, counts = _with_words(keys, counts, words)
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        offsets = pa.array(np.append(starts, len(keys)).astype(np.int32))
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[starts]), pa.array(np.full(len(starts), shard)),
            pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
        ], schema=schema)

    def run(batches):
        known, current, held, n, words = _Hashes(), None, [], 0, 0
        for shard, text in rows(batches, "shard", "text"):
            if held and (shard != current or n >= HELD):
                yield counted(current, held, words)
                held, n, words = [], 0, 0
            current = shard
            keys = keys_of(text, order, known)
            held += keys
            n, words = n + sum(map(len, keys)), words + len(keys[0])
        if held:
            yield counted(current, held, words)

    return docs.select("shard", "text").mapInArrow(run, "bucket int, shard long, keys array<long>, counts array<int>")


def _with_words(keys: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with that of the number of words in front."""
    if len(keys) and keys[0] == WORDS:
        raise ValueError("an n-gram has the key that is kept for the number of words")
    return np.append(np.uint64(WORDS), keys), np.append(words, counts)


def _answered(asked: DataFrame) -> DataFrame:
    """(shard, bucket, n, totals): corpus counts of the keys a shard has in a bucket, in the order of the keys.

    ``totals`` are compressed 64-bit numbers; most are small.
    """
    schema = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("totals", pa.binary())])

    def totals(bucket: int, held: dict[int, list[tuple[np.ndarray, np.ndarray]]]):
        every = np.concatenate([keys for parts in held.values() for keys, _ in parts])
        counts = np.concatenate([counts for parts in held.values() for _, counts in parts])
        distinct, place = np.unique(every, return_inverse=True)
        summed = np.zeros(len(distinct), np.int64)
        np.add.at(summed, place, counts)
        for shard, parts in held.items():
            own = parts[0][0] if len(parts) == 1 else np.unique(np.concatenate([keys for keys, _ in parts]))
            found = summed[np.searchsorted(distinct, own)]
            yield shard, bucket, len(found), pa.compress(found.tobytes(), codec="zstd", asbytes=True)

    def run(batches):
        def made():
            current, held = None, {}
            for batch in batches:
                buckets, shards = batch.column("bucket").to_pylist(), batch.column("shard").to_pylist()
                for at, (bucket, shard) in enumerate(zip(buckets, shards, strict=True)):
                    if bucket != current and held:
                        yield from totals(current, held)
                        held = {}
                    current = bucket
                    keys = batch.column("keys")[at].values.to_numpy().view(np.uint64)
                    held.setdefault(shard, []).append((keys.copy(), batch.column("counts")[at].values.to_numpy().copy()))
            if held:
                yield from totals(current, held)

        return batches_of(made(), schema, 64)

    dealt = asked.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "shard long, bucket int, n int, totals binary")


def _scores(table: pa.Table, counts: pa.Table, order: int) -> Iterator[tuple]:
    known = _Hashes()
    ids, held = [], []
    for doc_id, text in rows(table.to_batches(), "doc_id", "text"):
        ids.append(doc_id)
        held += keys_of(text, order, known)
    ends = np.cumsum([len(k) for k in held])
    distinct, place = np.unique(np.concatenate(held), return_inverse=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    del held
    answers = sorted(zip(counts["bucket"].to_pylist(), counts["n"].to_pylist(), counts["totals"].to_pylist(), strict=True))
    totals = np.concatenate([
        np.frombuffer(pa.decompress(t, decompressed_size=8 * n, codec="zstd", asbytes=True), np.int64) for _, n, t in answers]).astype(np.float64)
    _with_words(distinct, distinct, 0)
    if len(totals) != len(distinct) + 1:
        raise ValueError("a shard's n-grams changed between two scans")
    corpus, totals = totals[0], totals[1:]
    # the corpus counts of all n-grams, document by document, the shorter ones first
    grams = np.split(totals[place], ends[:-1])
    for k, doc_id in enumerate(ids):
        own = grams[k * order:(k + 1) * order]
        words = len(own[0])
        if not words:
            yield doc_id, 0, None
            continue
        # from the lowest order up: a longer n-gram that is known replaces the score of the shorter one
        log_score = np.log(own[0] / corpus)
        for n in range(2, order + 1):
            if words < n:
                break
            seen, context = own[n - 1], own[n - 2][:words - n + 1]
            longer = np.where(seen >= MIN_COUNT, np.log(seen / context), np.log(BACKOFF) + log_score[n - 1:])
            log_score = np.concatenate((log_score[:n - 1], longer))
        yield doc_id, words, round(float(log_score.mean()), DIGITS)


def score(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, mean_log_score) of every row, by the n-grams of all rows."""
    placed = _sharded(docs, id_col, text_col)
    shards = placed.select("shard").distinct().count()
    bits = max(1, math.ceil(math.log2(max(1, shards * SHARD_KEYS / BUCKET_KEYS))))
    answers = _answered(_asked(placed, order, bits))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("mean_log_score", pa.float64())])

    def join(texts: pa.Table, counts: pa.Table) -> pa.Table:
        made = list(zip(*_scores(texts, counts, order), strict=True)) or [[], [], []]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    return placed.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        join, "doc_id long, n_words long, mean_log_score double")
