"""Cost-balanced packing of documents into fixed-length sequences.

A piece of ``n`` tokens costs ``LINEAR * n + QUADRATIC * n ** 2``: attention looks at the pieces of a sequence one by one.
Documents are tokenised where they are read and packed in shards of about ``SHARD_TOKENS`` tokens, so no ids are moved
between tasks and memory is bounded:

1. A document longer than a sequence gives full sequences and a tail.
2. Tails go, longest first, to the lowest-cost sequence that still has room for them.
3. Tails that fit nowhere are cut to fill what is left, so every sequence but the shard's last is full.
4. The last sequence is cut into powers of two, which need no padding.

- A null or empty text is a document of the end token alone. Repeated rows are documents of their own.
- A document of any length belongs to one shard; an empty table gives no rows. Other columns play no part.
- Sequence ids are unique over the table: the partition's number, then a count within it. A retried task gives them again.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from wattlake.llm.common import batches_of, byte_names, id_and_text, rows

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SEQUENCE = 2048
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE
SHARD_TOKENS = 4_000_000
_ID_BYTES = 4
#: Characters without a change between white space and other characters.
LONG_RUN = 20_000
_LONG_RUN = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, those of the ``tokenizers`` library for the given file.

    ``tiktoken`` finds the same ids from the same vocabulary some four times as fast; texts with a run too long for its
    pattern engine go through ``tokenizers`` itself.
    """

    def __init__(self, path: str = VOCABULARY):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        byte_of = {name: bytes([b]) for b, name in enumerate(byte_names())}
        ranks = {b"".join(map(byte_of.__getitem__, t)): i for t, i in self.tokenizer.get_vocab().items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        if len(text) > LONG_RUN and _LONG_RUN.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


#: document, start, length, sequence, offset
Placed = tuple[int, int, int, int, int]


def pack(lengths: list[int], capacity: int = SEQUENCE) -> list[Placed]:
    """Where every token of the documents goes; sequences are numbered from 0."""
    placed: list[Placed] = []
    count, tails = 0, []
    for doc, n in enumerate(lengths):
        full = n // capacity
        placed += [(doc, k * capacity, capacity, count + k, 0) for k in range(full)]
        count += full
        if n % capacity:
            tails.append((n % capacity, doc, full * capacity))
    bins = -(-sum(t[0] for t in tails) // capacity)
    if not bins:
        return placed
    filled = [0] * bins
    rooms: list[tuple[float, int]] = [(0.0, b) for b in range(bins)]
    left = []
    waiting: list[tuple[int, float, int]] = []  # without room for the present length, most room first
    tails.sort(key=lambda t: (-t[0], t[1]))
    for n, doc, start in tails:
        while waiting and -waiting[0][0] >= n:
            _, spent, b = heapq.heappop(waiting)
            heapq.heappush(rooms, (spent, b))
        while rooms and filled[rooms[0][1]] + n > capacity:
            spent, b = heapq.heappop(rooms)
            if filled[b] < capacity:
                heapq.heappush(waiting, (filled[b] - capacity, spent, b))
        if rooms:
            spent, b = rooms[0]
            placed.append((doc, start, n, count + b, filled[b]))
            filled[b] += n
            heapq.heapreplace(rooms, (spent + cost(n), b))
        else:
            left.append((n, doc, start))
    rooms += [(spent, b) for _, spent, b in waiting]
    gaps = [b for _, b in sorted(rooms) if filled[b] < capacity]
    at = 0
    for n, doc, start in left:
        while n:
            b = gaps[at]
            part = min(n, capacity - filled[b])
            placed.append((doc, start, part, count + b, filled[b]))
            filled[b] += part
            n, start = n - part, start + part
            at += filled[b] == capacity
    return _close(placed, filled, count, capacity)


def _close(placed: list[Placed], filled: list[int], first: int, capacity: int) -> list[Placed]:
    """Empty all sequences but one that are not full into each other, and cut the last into powers of two."""
    short = sorted((b for b, n in enumerate(filled) if n < capacity), key=lambda b: (-filled[b], b))
    at, to = len(short) - 1, 0
    pieces: dict[int, list[Placed]] = {first + b: [] for b in short}
    rest = []
    for p in placed:
        (pieces[p[3]] if p[3] in pieces else rest).append(p)
    while to < at:
        source, target = first + short[at], first + short[to]
        room = capacity - filled[short[to]]
        doc, start, n, _, offset = pieces[source].pop()
        part = min(n, room)
        pieces[target].append((doc, start + n - part, part, target, filled[short[to]]))
        filled[short[to]] += part
        filled[short[at]] -= part
        if part < n:
            pieces[source].append((doc, start, n - part, source, offset))
        at -= not filled[short[at]]
        to += filled[short[to]] == capacity
    last = first + short[to] if short and to < len(short) and filled[short[to]] < capacity else None
    for b, own in pieces.items():
        if b != last:
            rest += own
    if last is None:
        return rest
    taken, extra = 0, first + len(filled)
    size = _largest_power(filled[short[to]])
    sequence = last
    for doc, start, n, _, _ in pieces[last]:
        while n:
            part = min(n, size - taken)
            rest.append((doc, start, part, sequence, taken))
            n, start, taken = n - part, start + part, taken + part
            filled[short[to]] -= part
            if taken == size and filled[short[to]]:
                size, taken, sequence, extra = _largest_power(filled[short[to]]), 0, extra, extra + 1
    return rest


def _largest_power(n: int) -> int:
    return 1 << (n.bit_length() - 1)


FIELDS = (("doc_id", "long"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"),
          ("sequence_id", "long"), ("offset", "long"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds ``ids`` array<int>, what a sequence holds at the piece's place."""
    schema = pa.schema([(n, pa.int64()) for n, _ in FIELDS] + [("ids", pa.list_(pa.int32()))] * with_ids)
    ddl = ", ".join(f"{n} {t}" for n, t in FIELDS) + ", ids array<int>" * with_ids

    def run(batches):
        return batches_of(_pieces(rows(batches, "doc_id", "text"), path, with_ids), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl)


def _pieces(docs: Iterator[tuple], path: str, with_ids: bool) -> Iterator[tuple]:
    encoder, context = Encoder(path), TaskContext.get()
    next_id = (context.partitionId() if context else 0) << 40
    for shard in _shards(docs, encoder):
        used = 0
        for doc, start, n, sequence, offset in pack([len(ids) // _ID_BYTES for _, ids in shard]):
            doc_id, ids = shard[doc]
            own = memoryview(ids)[start * _ID_BYTES:(start + n) * _ID_BYTES]
            more = (own.cast("I").tolist(),) if with_ids else ()
            yield doc_id, start, n, zlib.crc32(own), len(ids) // _ID_BYTES, next_id + sequence, offset, *more
            used = max(used, sequence + 1)
        next_id += used


def _shards(docs: Iterator[tuple], encoder: Encoder) -> Iterator[list[tuple[int, bytes]]]:
    held, tokens, end = [], 0, END_ID.to_bytes(_ID_BYTES, "little")
    for doc_id, text in docs:
        ids = encoder.encode(text) + end
        held.append((doc_id, ids))
        tokens += len(ids) // _ID_BYTES
        if tokens >= SHARD_TOKENS:
            yield held
            held, tokens = [], 0
    if held:
        yield held
