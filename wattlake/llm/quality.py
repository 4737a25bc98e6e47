"""Quality classifier: supervised subword embeddings.

Every word stands for itself, its character n-grams and, where it repeats the word before it, a mark of that; each of
these is hashed to a learned vector. A document is the average of its vectors, a softmax over two outputs reads its class.
Vectors and outputs are learned together by stochastic gradient descent in numpy, on at most ``LABELLED_ROWS`` labelled
texts (those with the smallest hashes). Whatever the table's size, the model has ``BUCKETS`` vectors.

Scoring needs only each bucket's vector times the difference of the outputs, so it is a sum over words.

- A null or empty text has one vector, that of the text's end, which every document has.
- Labels other than 0 and 1, and labels without a document, teach nothing. Without any usable label every score is 0.5.
- One row per input row; ids may repeat or be null. Texts are scored whole, in linear time; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import batches_of, id_and_text, rows

LABELLED_ROWS = 3000
#: Bytes of their features, at most, as they are learnt from; they travel packed.
LABELLED_BYTES = 256 << 20
BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (2, 3, 4)
#: Batches learnt from, however many rows there are.
STEPS = 2000
BATCH = 16
RATE = 2.0
SEED = 7
CACHED_WORDS = 400_000
CACHED_CHARS = 64
_END, _AGAIN = zlib.crc32(b"\x00end") % BUCKETS, zlib.crc32(b"\x00again") % BUCKETS


def features(word: str) -> list[int]:
    """Buckets of a word and its character n-grams."""
    spelt = f"<{word}>"
    grams = [spelt[k:k + n] for n in GRAMS for k in range(len(spelt) - n + 1)]
    return [zlib.crc32(g.encode()) % BUCKETS for g in (spelt, *grams)]


def bag(text: str) -> tuple[Counter, int]:
    """How often each word occurs, and how often a word repeats the one before it."""
    words = text.split()
    return Counter(words), sum(map(str.__eq__, words, words[1:]))


def document_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document in their order, and how often each occurs."""
    words, again = bag(text)
    counts: Counter = Counter({_END: 1})
    if again:
        counts[_AGAIN] += again
    for word, n in words.items():
        for f in features(word):
            counts[f] += n
    ids, found = np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.int32, len(counts))
    order = np.argsort(ids)
    return ids[order], found[order]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and their weights, which add up to 1."""
    return _weighed(*document_counts(text))


def _weighed(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids, counts.astype(np.float32) / np.float32(counts.sum())


def _packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Gaps and counts are small numbers: about two bytes for a bucket."""
    return zlib.compress(np.concatenate((np.diff(ids, prepend=np.int32(0)), counts)).tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    gaps, counts = np.frombuffer(zlib.decompress(data), np.int32).reshape(2, -1)
    return np.cumsum(gaps, dtype=np.int32), counts


class Model:
    """Per bucket, how much it speaks for class 1."""

    def __init__(self, speaks: np.ndarray, bias: float):
        self.speaks, self.bias = speaks, bias


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, rate: float = RATE) -> Model:
    """Stochastic gradient descent over documents in small batches; the rate falls linearly to nothing."""
    if not len(bags):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    outputs, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    wanted = np.eye(2, dtype=np.float32)[labels]
    order, at = rng.permutation(len(bags)), 0
    for step in range(steps):
        if at >= len(order):
            order, at = rng.permutation(len(bags)), 0
        now, at = order[at:at + BATCH], at + BATCH
        ids = np.concatenate([bags[k][0] for k in now])
        weights = np.concatenate([bags[k][1] for k in now])
        starts = np.cumsum([0] + [len(bags[k][0]) for k in now[:-1]])
        hidden = np.add.reduceat(vectors[ids] * weights[:, None], starts, axis=0)
        logits = hidden @ outputs + bias
        odds = np.exp(logits - logits.max(1, keepdims=True))
        wrong = (odds / odds.sum(1, keepdims=True) - wanted[now]) / np.float32(len(now) ** 0.5)
        now_rate = np.float32(rate * (1 - step / steps))
        back = np.repeat(wrong @ outputs.T, np.diff([*starts, len(ids)]), axis=0) * weights[:, None]
        outputs -= now_rate * (hidden.T @ wrong)
        bias -= now_rate * wrong.sum(0)
        for d in range(DIMENSIONS):
            vectors[:, d] -= now_rate * np.bincount(ids, back[:, d], BUCKETS).astype(np.float32)
    return Model(vectors @ (outputs[:, 1] - outputs[:, 0]), float(bias[1] - bias[0]))


class Scorer:
    def __init__(self, model: Model):
        self.speaks, self.bias = model.speaks.tolist(), model.bias
        self.known: dict[str, tuple[float, int]] = {}

    def _word(self, word: str) -> tuple[float, int]:
        own = features(word)
        made = sum([self.speaks[f] for f in own]), len(own)
        if len(word) <= CACHED_CHARS:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = made
        return made

    def score(self, text: str) -> float:
        words, again = bag(text)
        said, n = self.speaks[_END] + again * self.speaks[_AGAIN], 1 + again
        known = self.known
        for word, count in words.items():
            s, k = known.get(word) or self._word(word)
            said += s * count
            n += k * count
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, said / n + self.bias))))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", limit: int = LABELLED_ROWS) -> Model:
    """Learn from at most ``limit`` labelled texts, and at most ``LABELLED_BYTES`` of their features, which alone reach the
    driver. Of rows alike in id, label and text one counts, so an id that many rows have brings no more than its texts."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col(label_col).cast("int").alias("label"))
    chosen = chosen.where(F.col("label").isin(0, 1)).orderBy(F.xxhash64("labelled"), "labelled", "label").limit(limit)
    given = id_and_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("digest", pa.binary()), ("size", pa.int64()), ("packed", pa.binary())])

    def run(batches):
        def made():
            seen: set[tuple] = set()
            for doc_id, label, text in rows(batches, "doc_id", "label", "text"):
                digest = hashlib.sha256(text.encode()).digest()
                if (doc_id, label, digest) in seen:
                    continue
                if len(seen) >= 10 * LABELLED_ROWS:
                    seen.clear()
                seen.add((doc_id, label, digest))
                ids, counts = document_counts(text)
                yield doc_id, label, digest, 8 * len(ids), _packed(ids, counts)

        return batches_of(made(), schema, 64)

    found = given.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, digest binary, size long, packed binary")
    order = [F.xxhash64("doc_id", "digest"), F.col("doc_id"), F.col("label"), F.col("digest")]
    first = found.dropDuplicates(["doc_id", "label", "digest"]).orderBy(*order).limit(limit)
    so_far = F.sum("size").over(Window.orderBy(*order))  # over at most ``limit`` rows
    taught = first.withColumn("bytes", so_far).where(F.col("bytes") <= LABELLED_BYTES).select("doc_id", "label", "digest", "packed").collect()
    taught.sort(key=lambda r: (r.doc_id, r.label, r.digest))
    return train([_weighed(*_unpacked(r.packed)) for r in taught], np.array([r.label for r in taught], np.int64))


def accepted(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns; a null text scores as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.speaks, model.bias))
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                good = [scorer.score(t or "") >= threshold for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.speaks, model.bias))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        return batches_of(((d, scorer.score(t)) for d, t in rows(batches, "doc_id", "text")), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
