"""Exact top-k search: BM25 over a sharded inverted index with block-max WAND pruning.

The index is a table of shards: some ``SHARD_DOCS`` documents each, with the postings of their terms. Statistics are
global: document frequencies come from all shards, by aggregation. Queries go in blocks of about ``QUERY_BLOCK`` and
``QUERY_TERMS`` terms at most, one block after the other; a block's weighted terms are sent to the tasks that read the
shards, and every task keeps the best k of what it reads. A task holds one block and one shard at a time, and there are
``TASKS`` tasks a core, so neither the memory of a task nor the rows that a query's results come in grow with the table.

Documents of a shard are ordered so that neighbours are alike (commonest term, then length) and form blocks of
``BLOCK``. For each term the largest impact in a block is known; their weighted sum bounds every score in the block, and
a block whose bound is below a query's k-th best score so far is skipped: the pivot test of block-max WAND, made for a
group of queries and a shard's blocks at once. What is not skipped is scored in full, so results are exact.

- Terms are what ASCII white space separates, with A-Z lower-cased; a query's term counts as often as it occurs.
- Scores are rounded to ``DIGITS`` digits; equal scores rank by id, null ids last. Only documents that share a term with
  the query are found, so a query without words, or an empty table, finds nothing.
- Repeated ids are rows of their own among the documents; repeated query ids are one query with all their words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from wattlake.llm.common import batches_of, id_and_text, rows, written
from wattlake.session import settings

K1, B = 1.2, 0.75
DIGITS = 4
SHARD_DOCS = 2048
SHARD_WORDS = 2_000_000
BLOCK = 64
QUERY_BLOCK = 4096
#: Distinct terms of all queries of a block together; both bounds hold on average over blocks dealt by hash.
QUERY_TERMS = 4_000_000
#: Queries of a block that are scored together.
TOGETHER = 64
#: Tasks for each core that search the shards.
TASKS = 4
#: Entries that are added up at a time.
ENTRIES = 1 << 20
#: Shards come to a task one by one, from the files and to Python.
ONE_BY_ONE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1"}
#: Terms in at least this share of a shard's documents are multiplied as a dense matrix.
DENSE = 0.04
_NONE = np.iinfo(np.int64).max


def _terms(text: str) -> Counter:
    return Counter(text.encode().lower().split())


def _hash(word: bytes) -> int:
    h = xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        made = _hash(word)
        if len(word) <= 64:
            self[word] = made
        return made


_SHARD = pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("terms", pa.list_(pa.int64())),
                    ("starts", pa.list_(pa.int32())), ("members", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
_SHARD_DDL = ("doc_ids array<long>, lengths array<int>, terms array<long>, starts array<int>, members array<int>, counts array<int>")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard: its documents' ids and lengths, its terms, and for term ``i`` the postings (member, count)
    from ``starts[i]`` to ``starts[i + 1]``."""

    def run(batches):
        known, held, words = _Hashes(), [], 0
        for doc_id, text in rows(batches, "doc_id", "text"):
            terms = _terms(text)
            length = sum(terms.values())
            held.append((doc_id, length, np.fromiter(map(known.__getitem__, terms), np.int64, len(terms)),
                         np.fromiter(terms.values(), np.int32, len(terms))))
            words += length
            if len(held) >= SHARD_DOCS or words >= SHARD_WORDS:
                yield _shard_batch(held)
                held, words = [], 0
        if held:
            yield _shard_batch(held)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _SHARD_DDL)


def _shard_batch(held: list[tuple]) -> pa.RecordBatch:
    commonest = [int(terms[counts.argmax()]) if len(terms) else 0 for _, _, terms, counts in held]
    order = sorted(range(len(held)), key=lambda k: (commonest[k], held[k][1]))
    held = [held[k] for k in order]
    sizes = np.array([len(h[2]) for h in held])
    terms = np.concatenate([h[2] for h in held])
    counts = np.concatenate([h[3] for h in held])
    members = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
    by = np.lexsort((members, terms))
    terms, members, counts = terms[by], members[by], counts[by]
    distinct, starts = np.unique(terms, return_index=True)
    columns = ([h[0] for h in held], [h[1] for h in held], distinct, np.append(starts, len(terms)), members, counts)
    made = []
    for column, field in zip(columns, _SHARD, strict=True):
        values = pa.array(column, type=field.type.value_type)
        made.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    return pa.RecordBatch.from_arrays(made, schema=_SHARD)


class QueryBlock:
    """Queries as rows of (term, weight); terms are places in ``vocabulary``, which is sorted."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, of = np.unique(ids, return_inverse=True)
        self.vocabulary, term = np.unique(terms, return_inverse=True)
        # queries alike in their weightiest term are scored together
        by = np.lexsort((term, of))
        of, term, weights = of[by], term[by], weights[by]
        bounds = np.searchsorted(of, np.arange(len(self.ids) + 1))
        top = np.array([term[lo + weights[lo:hi].argmax()] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)])
        order = np.argsort(top, kind="stable")
        self.ids = self.ids[order]
        pieces = [slice(bounds[k], bounds[k + 1]) for k in order]
        self.term = np.concatenate([term[p] for p in pieces]).astype(np.int32)
        self.weight = np.concatenate([weights[p] for p in pieces])
        self.bounds = np.cumsum([0] + [p.stop - p.start for p in pieces])


class Best:
    """The best k of each query so far."""

    def __init__(self, n: int, k: int):
        self.score, self.doc = np.full((n, k), -np.inf), np.full((n, k), _NONE)

    def threshold(self, q: np.ndarray) -> np.ndarray:
        return self.score[q, -1]

    def add(self, q: int, scores: np.ndarray, docs: np.ndarray) -> None:
        s, d = np.concatenate((self.score[q], scores)), np.concatenate((self.doc[q], docs))
        first = np.lexsort((d, -s))[:self.score.shape[1]]
        self.score[q], self.doc[q] = s[first], d[first]


def search_shard(shard: dict, block: QueryBlock, average_length: float, best: Best) -> tuple[int, int]:
    """Score one shard for all queries of a block. Gives the number of (query, block of documents) scored, and of all."""
    lengths, terms = np.asarray(shard["lengths"]), np.asarray(shard["terms"])
    ids = np.array([_NONE if d is None else d for d in shard["doc_ids"]], np.int64)
    starts, members, counts = np.asarray(shard["starts"]), np.asarray(shard["members"]), np.asarray(shard["counts"])
    n = len(ids)
    at = np.minimum(np.searchsorted(block.vocabulary, terms), len(block.vocabulary) - 1)
    used = np.flatnonzero(block.vocabulary[at] == terms)
    if not len(used):
        return 0, 0
    sizes = (starts[1:] - starts[:-1])[used]
    ends = np.cumsum(sizes)
    picked = np.repeat(starts[:-1][used] - (ends - sizes), sizes) + np.arange(ends[-1])
    member, tf = members[picked], counts[picked].astype(np.float64)
    impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[member] / average_length))
    first = ends - sizes
    n_blocks = -(-n // BLOCK)
    # per term and block the largest impact: postings are sorted by member, so blocks are runs
    term_of = np.repeat(np.arange(len(used)), sizes)
    cell = term_of * n_blocks + member // BLOCK
    run = np.flatnonzero(np.diff(cell, prepend=-1))
    most, most_block = np.maximum.reduceat(impact, run), (cell[run] % n_blocks)
    most_first = np.searchsorted(cell[run] // n_blocks, np.arange(len(used) + 1))
    dense = sizes >= max(2, DENSE * n)
    dense_place = np.where(dense, np.cumsum(dense) - 1, -1)
    # a row a document, so that those of open blocks lie together
    matrix = np.zeros((n, int(dense.sum())))
    inside = dense[term_of]
    matrix[member[inside], dense_place[term_of[inside]]] = impact[inside]
    # where a term of the vocabulary is in this shard
    place = np.full(len(block.vocabulary), -1)
    place[at[used]] = np.arange(len(used))
    scored = 0
    for low in range(0, len(block.ids), TOGETHER):
        high = min(low + TOGETHER, len(block.ids))
        span = slice(block.bounds[low], block.bounds[high])
        term, weight = place[block.term[span]], block.weight[span]
        row = np.repeat(np.arange(high - low), np.diff(block.bounds[low:high + 1]))
        here = term >= 0
        term, weight, row = term[here], weight[here], row[here]
        bounds = _added(row, term, weight, most_first[:-1], most_first[1:], most_block, most, high - low, n_blocks)
        threshold = best.threshold(np.arange(low, high))
        open_ = bounds > np.maximum(threshold, 0)[:, None] - 10.0 ** -DIGITS * (threshold > 0)[:, None]
        open_ &= bounds > 0
        scored += int(open_.sum())
        wanted = np.flatnonzero(open_.any(0))
        if not len(wanted):
            continue
        # only open blocks are scored: for each query those that its own bound leaves open
        columns = (wanted[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        columns = columns[columns < n]
        open_at = np.full(n_blocks, -1)
        open_at[wanted] = np.arange(len(wanted)) * BLOCK
        queries = np.zeros((high - low, matrix.shape[1]))
        thick = dense[term]
        queries[row[thick], dense_place[term[thick]]] = weight[thick]
        total = queries @ (matrix if len(columns) == n else matrix[columns]).T
        thin = ~thick
        total += _added(row[thin], term[thin], weight[thin], first, ends, member, impact, high - low, len(columns), open_at)
        # a document that shares no term is no hit, a score of 0.0000 is one
        hit = total > 0
        total = np.round(total, DIGITS)
        hit &= (total >= threshold[:, None]) & np.repeat(open_[:, wanted], BLOCK, axis=1)[:, :len(columns)]
        k = best.score.shape[1]
        for q in np.flatnonzero(hit.any(1)):
            good = np.flatnonzero(hit[q])
            if len(good) > 4 * k:
                kth = np.partition(total[q][good], len(good) - k)[len(good) - k]
                good = good[total[q][good] >= kth]
            best.add(low + q, total[q][good], ids[columns[good]])
    return scored, n_blocks * len(block.ids)


def _added(row, term, weight, first, ends, column, value, n_rows, n_columns, open_at=None) -> np.ndarray:
    """Row by column sums of weight times value, over each term's entries ``first[term]`` to ``ends[term]``.

    With ``open_at`` entries of closed blocks (-1) are passed over, and columns are counted among the open ones.
    """
    sizes = ends[term] - first[term]
    stop = np.cumsum(sizes)
    if not len(stop) or not stop[-1]:
        return np.zeros((n_rows, n_columns))
    total, low = np.zeros(n_rows * n_columns), 0
    while low < len(row):
        # at least one term, then as many as are at most ENTRIES entries; the order of addition is always the same
        high = max(low + 1, int(np.searchsorted(stop, (stop[low - 1] if low else 0) + ENTRIES, "right")))
        some = slice(low, high)
        begin = stop[some] - sizes[some]
        entry = np.repeat(first[term[some]] - begin, sizes[some]) + np.arange(begin[0], stop[high - 1])
        of = np.repeat(np.arange(low, high), sizes[some])
        where = column[entry]
        if open_at is not None:
            start = open_at[where // BLOCK]
            kept = start >= 0
            entry, of, where = entry[kept], of[kept], (start + where % BLOCK)[kept]
        cell, more = row[of] * n_columns + where, weight[of] * value[entry]
        if low:
            np.add.at(total, cell, more)
        else:
            total = np.bincount(cell, more, n_rows * n_columns)
        low = high
    return total.reshape(n_rows, n_columns)


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): for each query its ``k`` best documents."""
    spark = index.sparkSession
    schema = pa.schema([("query_id", pa.int64()), ("term", pa.int64()), ("n", pa.int64())])

    def split(batches):
        known = _Hashes()
        return batches_of(((q, known[w], n) for q, text in rows(batches, "doc_id", "text") for w, n in _terms(text).items()), schema, 8192)

    asked = id_and_text(queries, id_col, text_col).where("doc_id IS NOT NULL")
    terms = asked.mapInArrow(split, "query_id long, term long, n long").groupBy("query_id", "term").agg(F.sum("n").alias("n"))
    sizes = index.select(F.size("doc_ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("w"))
    total, words = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    n_queries = asked.select("doc_id").distinct().count()
    if not words or not n_queries:
        return empty
    frequencies = index.select(F.explode(F.arrays_zip("terms", F.slice("starts", 2, F.size("terms")).alias("stop"), "starts")).alias("t")).select(
        F.col("t.terms").alias("term"), (F.col("t.stop") - F.col("t.starts")).alias("df")).groupBy("term").agg(F.sum("df").alias("df"))
    with settings(spark, ONE_BY_ONE):
        frequencies = written(frequencies, "term-frequencies")
    weighted = terms.join(frequencies, "term").select(
        "query_id", "term", (F.col("n") * F.log(1 + (F.lit(float(total)) - F.col("df") + 0.5) / (F.col("df") + 0.5))).alias("weight"))
    weighted = written(weighted, "query-terms")
    n_blocks = max(-(-n_queries // QUERY_BLOCK), -(-weighted.count() // QUERY_TERMS), 1)
    found = [
        _search(index, weighted.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b), words / total, k) for b in range(n_blocks)
    ]
    found = [f for f in found if f is not None]
    if not found:
        return empty
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return best.select("query_id", F.posexplode("best").alias("place", "b")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.when(F.col("b.doc_id") != _NONE, F.col("b.doc_id")).alias("doc_id"),
        (-F.col("b.low")).alias("score"))


def _search(index: DataFrame, weighted: DataFrame, average_length: float, k: int) -> DataFrame | None:
    """The best k for one block of queries, whose terms are few enough to be sent to every task."""
    given = weighted.toArrow()
    if not given.num_rows:
        return None
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(vars(QueryBlock(
        given["query_id"].to_numpy(), given["term"].to_numpy(), given["weight"].to_numpy())))
    del given
    item = pa.struct([("low", pa.float64()), ("doc_id", pa.int64())])
    schema = pa.schema([("query_id", pa.int64()), ("best", pa.list_(item))])

    def run(batches):
        block = SimpleNamespace(**sent.value)
        best = Best(len(block.ids), k)
        for batch in batches:
            for at in range(batch.num_rows):
                shard = {name: batch.column(name)[at].values.to_numpy(zero_copy_only=False) for name in batch.schema.names if name != "doc_ids"}
                shard["doc_ids"] = batch.column("doc_ids")[at].as_py()
                search_shard(shard, block, average_length, best)
        return batches_of(_results(block, best), schema, 1024)

    dealt = index.coalesce(TASKS * spark.sparkContext.defaultParallelism)
    parts = dealt.mapInArrow(run, "query_id long, best array<struct<low: double, doc_id: long>>")
    best = parts.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    with settings(spark, ONE_BY_ONE):
        best = written(best, "best")
    sent.destroy()
    return best


def _results(block: QueryBlock, best: Best) -> Iterator[tuple]:
    for q in range(len(block.ids)):
        got = np.isfinite(best.score[q])
        if got.any():
            yield int(block.ids[q]), [{"low": -float(s), "doc_id": int(d)} for s, d in zip(best.score[q][got], best.doc[q][got], strict=True)]
