"""SimHash near-dedup by a binary-trie self-join.

Fingerprints at most ``DISTANCE`` bits apart agree on at least one of ``DISTANCE + 1`` blocks of bits. So every distinct
fingerprint enters one trie per block, rotated so that the block comes first, and tries split at the block's end: what
shares a block is joined in one task, by walking pairs of nodes together, adding up differing bits and dropping a pair
of nodes as soon as it has more than ``DISTANCE``. A block shared by more than ``LARGE`` fingerprints is split further,
into the pairs of nodes one byte deeper whose bytes are near enough.

A task passes on which fingerprints hang together, not every link, so its output is at most as large as its input.

Sets of shingles with a Jaccard similarity of 0.8 have fingerprints that differ in about 15 of 100 bits, too many for that.
For them ``wide_links`` walks tries over ``WIDE`` bits, each over ``WINDOW`` bits in an order of its own, split after so many
leading bits that at most about ``GROUP`` fingerprints share them. ``WIDE_DISTANCE`` bits of a window may differ, and
``FIRST_DISTANCE`` of its first 64, and ``WHOLE_DISTANCE`` of all ``WIDE`` bits: a window alone links ever more sets that have
little in common as a table grows, until they are one cluster. No single trie has every near pair, so there are as many as give a pair at 0.8 about
``MET`` tries that agree on the leading bits. Of 107,500 random pairs at 0.8 of 9 or more shingles none was missed, with the
tries for 200,000 fingerprints and with those for 12,000,000; of 20,000 pairs of four shingles and the same with a fifth 6 and 39.
Each trie would link nearly every member of a family of near copies anew. So the first ``EARLY`` tries are walked before the
others, which are given what hangs together by then under one id and pass on links between such ids only; these go
``ROUND`` at a time, so the shuffled rows of few are on disk at once.

- Words are separated by ASCII white space; A-Z is lower-cased. A text of fewer words than a shingle is one shingle; a
  text without words (null, empty) has fingerprint zero and is linked like any other.
- One row per input row; equal texts always share a component. Ids may repeat; null ids come last in ``component_id``
  (null only where a component has no other). Other columns play no part, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattlake.llm.common import batches_of, id_and_text, rows, written
from wattlake.llm.components import roots

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
#: More fingerprints than this in one block are joined by several tasks.
LARGE = 50_000
#: Pairs of nodes with at most so many pairs of fingerprints are compared directly.
DIRECT = 64
#: Pairs of nodes held at a time.
FRONTIER = 200_000
#: Bits of a wide fingerprint, and of what a trie over it looks at.
WIDE = 384
WINDOW = 128
FIRST_DISTANCE = 16
WIDE_DISTANCE = 30
#: Differing bits of whole fingerprints. Pairs at 0.8 of five or more shingles differ in 16.2 of 100 bits at most, on average;
#: fewer than one in 10 ** 8 of them differs in more than this.
WHOLE_DISTANCE = 108
#: Fingerprints that share the leading bits of a trie, on average and at most; fewer than ``LEADING`` bits are never split.
GROUP = 4096
LEADING = 8
#: Tries that agree on the leading bits of a pair of sets at a similarity of 0.8, and the share of bits it differs in.
MET = 14
DIFFERENT = 0.1515
#: Tries that are walked first, and tries of the others that are walked at a time.
EARLY = 4
ROUND = 16
#: As ``DIRECT``, for tries over windows, and rows of windows walked together.
WIDE_DIRECT = 1 << 14
WALKED = 1 << 16

_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BIT_WEIGHT = _BIT_OF_BYTE.astype(np.float64)
_STEPS = np.arange(WIDE // BITS, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The text's SimHash as a signed 64-bit number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    pieces = map(joined.__getitem__, map(slice, starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()))
    n = len(words) - width + 1
    hashes = np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n)
    counts = np.zeros(8 * 256, np.int64)
    for at in range(0, n, 1 << 16):
        own = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8) + (np.arange(8) << 8)
        counts += np.bincount(own.ravel(), minlength=8 * 256)
    ones = (counts.reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    value = int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of ``WIDE`` bits of a set of hashes; every word of it is of the hashes mixed anew."""
    cells = len(_STEPS) * 8 * 256
    counts, place = np.zeros(cells, np.int64), (np.arange(len(_STEPS) * 8) << 8).reshape(-1, 1, 8)
    for at in range(0, len(hashes), 1 << 13):
        mixed = hashes[at:at + (1 << 13)] + _STEPS
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        own = mixed.astype("<u8").view(np.uint8).reshape(len(_STEPS), -1, 8) + place
        counts += np.bincount(own.ravel(), minlength=cells)
    ones = counts.reshape(-1, 256).astype(np.float64) @ _BIT_WEIGHT
    return np.packbits(ones.ravel() * 2 > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        return batches_of(((d, fingerprint(t, shingle)) for d, t in rows(batches, "doc_id", "text")), schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def near_pairs(a: np.ndarray, b: np.ndarray | None, distance: int, depth: int = 0, nodes: np.ndarray | None = None,
               direct: int = DIRECT, compare=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs at most ``distance`` bits apart, from sorted ``a`` and ``b`` (``a`` with itself if None).

    ``depth``: leading bits on which all agree, or all of each of ``nodes``, the pairs of nodes to begin with. ``compare``
    is given the pairs of nodes with at most ``direct`` pairs of fingerprints.
    """
    compare = compare or _compared
    own = b is None
    b = a if own else b
    # ones[d][k]: how many of the first k numbers have bit d set
    ones_a = _ones(a)
    ones_b = ones_a if own else _ones(b)
    stack = [(depth, np.array([[0, len(a), 0, len(b), 0]]) if nodes is None else nodes)]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > FRONTIER:
            stack += [(depth, nodes[FRONTIER:]), (depth, nodes[:FRONTIER])]
            continue
        sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        few = (sizes <= direct) | (depth >= BITS)
        yield from compare(a, b, nodes[few], sizes[few], own, distance)
        nodes = nodes[~few]
        if not len(nodes):
            continue
        alo, ahi, blo, bhi, errors = nodes.T
        amid = ahi - (ones_a(depth)[ahi] - ones_a(depth)[alo])
        bmid = bhi - (ones_b(depth)[bhi] - ones_b(depth)[blo])
        children = np.concatenate([
            np.stack([alo, amid, blo, bmid, errors], 1), np.stack([amid, ahi, bmid, bhi, errors], 1),
            np.stack([alo, amid, bmid, bhi, errors + 1], 1), np.stack([amid, ahi, blo, bmid, errors + 1], 1),
        ])
        keep = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= distance)
        if own:  # a pair of nodes once
            keep &= children[:, 0] <= children[:, 2]
        stack.append((depth + 1, children[keep]))


def _ones(values: np.ndarray):
    made: dict[int, np.ndarray] = {}

    def at(depth: int) -> np.ndarray:
        if depth not in made:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            made[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        return made[depth]

    return at


def _compared(a, b, nodes, sizes, own, distance):
    for at in range(0, len(nodes), FRONTIER // 8):
        part, n = nodes[at:at + FRONTIER // 8], sizes[at:at + FRONTIER // 8]
        if not len(part):
            continue
        which = np.repeat(np.arange(len(part)), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + k // width, part[which, 2] + k % width
        near = np.bitwise_count(a[i] ^ b[j]) <= distance
        if own:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def hang_together(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position each of ``n`` hangs together with."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            low = np.minimum(label[i], label[j])
            if (label[i] == low).all() and (label[j] == low).all():
                break
            # hook the roots of both ends, then let every label point to a root
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            while (label[label] != label).any():
                label = label[label]
    return label


def hang_together_in_groups(first: np.ndarray, second: np.ndarray, whole: np.ndarray, starts: np.ndarray, known: np.ndarray,
                            leading: int = LEADING) -> np.ndarray:
    """The smallest position each hangs together with, inside groups that agree on their ``leading`` bits.

    ``first`` and ``second``: the halves of windows, sorted in each group by the first; ``whole``: a fingerprint in each row;
    ``starts``: where groups begin;
    ``known``: the smallest position in its group that each is known to hang together with. What hangs together already is
    not compared again, so a family of near copies is connected, not enumerated.
    """
    label, ends = known.copy(), np.append(starts[1:], len(first))

    def compare(a, b, nodes, sizes, own, distance):
        for alo, ahi, blo, bhi, _ in nodes.tolist():
            of_a, of_b = label[alo:ahi], label[blo:bhi]
            if (of_a == of_b[0]).all() and (of_b == of_b[0]).all():
                continue
            apart = np.bitwise_count(a[alo:ahi, None] ^ b[None, blo:bhi]).ravel()
            at = np.flatnonzero(apart <= distance)
            i, j = np.divmod(at, bhi - blo)
            near = (of_a[i] != of_b[j]) & (apart[at] + np.bitwise_count(second[alo + i] ^ second[blo + j]) <= WIDE_DISTANCE)
            i, j = i[near], j[near]
            near = np.bitwise_count(whole[alo + i] ^ whole[blo + j]).sum(1) <= WHOLE_DISTANCE
            if near.any():
                old, place = np.unique(np.concatenate((of_a[i[near]], of_b[j[near]])), return_inverse=True)
                new = old[hang_together(len(old), [tuple(place.reshape(2, -1))])]
                group = np.searchsorted(starts, alo, "right") - 1
                part = label[starts[group]:ends[group]]
                at = np.minimum(np.searchsorted(old, part), len(old) - 1)
                part[:] = np.where(old[at] == part, new[at], part)
        return ()

    several = np.maximum.reduceat(known, starts) > starts
    nodes = np.stack([starts, ends, starts, ends, np.zeros_like(starts)], 1)[several]
    for _ in near_pairs(first, None, FIRST_DISTANCE, leading, nodes, WIDE_DIRECT, compare):
        pass
    return label


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    by = np.uint64(by)
    return (values << by) | (values >> (np.uint64(BITS) - by)) if by else values


def links(prints: DataFrame, distance: int = DISTANCE, large: int = LARGE) -> DataFrame:
    """(a, b): enough links between the distinct values of ``prints.fp`` to connect all that are near each other."""
    blocks = distance + 1
    width = BITS // blocks
    routed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(r).alias("trie"), F.shiftrightunsigned("fp", BITS - width * (r + 1)).bitwiseAND((1 << width) - 1).alias("block"))
        for r in range(blocks)
    ])).alias("at")).select("fp", "at.trie", "at.block")
    routed = written(routed, "tries")
    sizes = routed.groupBy("trie", "block").agg(F.count("*").alias("n")).where("n > 1")
    sized = routed.join(sizes, ["trie", "block"])
    none = F.lit(-1).cast("int")
    small = sized.where(F.col("n") <= large).select("trie", "block", none.alias("p"), none.alias("q"), F.lit(0).alias("side"), "fp")
    # the byte after the block, in the rotated fingerprint
    shift = F.pmod(F.lit(BITS - 8) - F.lit(width) * (F.col("trie") + 1), F.lit(BITS))
    rotated = F.expr(f"shiftrightunsigned(fp, CAST(pmod({BITS - 8} - {width} * (trie + 1), {BITS}) AS INT))")
    wrapped = F.expr(f"shiftleft(fp, CAST({BITS} - pmod({BITS - 8} - {width} * (trie + 1), {BITS}) AS INT))")
    byte = F.when(shift > BITS - 8, rotated.bitwiseOR(wrapped)).otherwise(rotated).bitwiseAND(255).cast("int")
    near = F.array(*[F.lit(m) for m in range(256) if m.bit_count() <= distance])
    deeper = sized.where(F.col("n") > large).select("trie", "block", "fp", byte.alias("own")).select(
        "trie", "block", "fp", "own", F.explode(F.transform(near, lambda m: F.col("own").bitwiseXOR(m))).alias("other")
    ).select("trie", "block", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
             F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for (trie, _, p, q), fps, sides in _groups(batches):
            by = width * trie
            a, b = fps[sides < 2], fps[sides == 2]
            if p == q:
                a, b = _rotated(fps, by), None
            elif not len(a) or not len(b):
                continue
            else:
                a, b = _rotated(a, by), np.sort(_rotated(b, by))
            a = np.sort(a)
            every = a if b is None else np.concatenate((a, b))
            pairs = near_pairs(a, b, distance, width if b is None else 0)
            label = hang_together(len(every), pairs if b is None else ((i, j + len(a)) for i, j in pairs))
            moved = np.flatnonzero(label != np.arange(len(every)))
            if len(moved):
                back = _rotated(every, (BITS - by) % BITS).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(back[moved]), pa.array(back[label[moved]])], schema=schema)

    keys = ["trie", "block", "p", "q"]
    return small.unionByName(deeper).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Runs of rows with equal keys, as key, unsigned fingerprints and sides."""
    held_key, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("trie", "block", "p", "q")])
        fps, sides = batch.column("fp").to_numpy().view(np.uint64), batch.column("side").to_numpy()
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if lo == hi:
                continue
            key = tuple(keys[:, lo].tolist())
            if key != held_key and held:
                yield held_key, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held = []
            held_key = key
            held.append((fps[lo:hi], sides[lo:hi]))
    if held:
        yield held_key, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def wide_tries(n: int) -> tuple[int, int]:
    """How many leading bits split a trie over ``n`` fingerprints, and how many tries there are."""
    leading = max(LEADING, math.ceil(math.log2(max(1, n) / GROUP)))
    return leading, math.ceil(MET / (1 - DIFFERENT) ** leading)


def window_orders(leading: int, tries: int) -> list[np.ndarray]:
    """The bits that each trie looks at. As many tries as can have leading bits without one in common, one order rotated."""
    drawn, once = np.random.default_rng(SEED), WIDE // leading
    rounds = [drawn.permutation(WIDE) for _ in range(0, tries, once)]
    return [np.roll(rounds[t // once], -leading * (t % once))[:WINDOW] for t in range(tries)]


def wide_links(prints: DataFrame, leading: int | None = None) -> DataFrame:
    """(a, b): links that connect the ids of ``prints`` (id, fp) whose wide fingerprints are near each other.

    It may link what is further apart than that through what lies between; a check that may not do so is the caller's.
    ``prints`` is counted and read: a table; ids may repeat. No id is linked to more than one smaller id.
    """
    leading, tries = wide_tries(prints.count() if leading is None else GROUP << leading)
    orders = window_orders(leading, tries)
    early = roots(_walked(prints, orders[:EARLY], leading))
    joined = prints.join(early, prints["id"] == early["node"], "left").select(F.coalesce("root", "id").alias("id"), "fp")
    joined = written(joined, "joined-early")
    rounds = [orders[k:k + ROUND] for k in range(EARLY, max(tries, EARLY + 1), ROUND)]
    late = roots(reduce(DataFrame.unionByName, [written(_walked(joined, some, leading), "late-links") for some in rounds]))
    named = early.join(late.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left")
    return named.select(F.col("node").alias("a"), F.coalesce("last", "root").alias("b")).unionByName(
        late.select(F.col("node").alias("a"), F.col("root").alias("b")))


def _walked(prints: DataFrame, orders: list[np.ndarray], leading: int) -> DataFrame:
    """(a, b): links between the ids that the tries over ``orders`` bring together; rows of one id are together already."""
    words = [f"word_{k}" for k in range(WIDE // BITS)]
    routed = pa.schema([("at", pa.int32()), *((w, pa.int64()) for w in words), ("id", pa.int64())])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def dealt(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.int64).reshape(batch.num_rows, -1)
            bits = np.unpackbits(whole.view(np.uint8), axis=1)
            columns = [pa.array(np.ascontiguousarray(c)) for c in whole.T]
            for trie, order in enumerate(orders):
                at = bits[:, order[:leading]] @ (1 << np.arange(leading - 1, -1, -1, np.int32)) | (trie << leading)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *columns, batch.column("id")], schema=routed)

    def run(batches):
        for at, *columns, ids in _whole_groups(batches, routed.names):
            whole = np.stack(columns, 1).view(np.uint64)
            halves = _windows(whole, at >> leading, orders)
            order = np.lexsort((halves[:, 0], at))
            at, whole, halves, ids = at[order], whole[order], halves[order], ids[order]
            starts = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
            known = _first_of_equal(at, ids)
            first, second = (np.ascontiguousarray(half) for half in halves.T)
            label = hang_together_in_groups(first, second, whole, starts, known, leading)
            # all are linked to the smallest id, so that tries agree; an id once
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, label, ids)
            moved = np.flatnonzero((least[label] != ids) & (known == np.arange(len(ids))))
            yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(least[label[moved]])], schema=schema)

    rows = prints.select("id", "fp").mapInArrow(dealt, f"at int, {', '.join(f'{w} long' for w in words)}, id long")
    return rows.repartition("at").sortWithinPartitions("at").mapInArrow(run, "a long, b long")


def _windows(whole: np.ndarray, tries: np.ndarray, orders: list[np.ndarray]) -> np.ndarray:
    """The halves of each fingerprint's window in its trie; ``tries`` is sorted."""
    halves, cuts = np.empty((len(whole), WINDOW // BITS), np.uint64), np.flatnonzero(np.diff(tries)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(whole)], strict=True):
        for at in range(lo, hi, WALKED):
            part = slice(at, min(at + WALKED, hi))
            bits = np.unpackbits(whole[part].view(np.uint8), axis=1)[:, orders[tries[lo]]]
            halves[part] = np.ascontiguousarray(np.packbits(bits, axis=1)).view(">u8")
    return halves


def _first_of_equal(at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The first position that has the same group and id as each."""
    order = np.lexsort((ids, at))
    begins = np.concatenate(([True], (np.diff(at[order]) != 0) | (np.diff(ids[order]) != 0)))
    first = np.empty(len(ids), np.int64)
    first[order] = order[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
    return first


def _whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut between different values of the first, about ``WALKED`` rows at a time."""
    held, n, enough = [], 0, WALKED
    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in names])
        n += batch.num_rows
        if n >= enough:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                yield [c[:cut] for c in columns]
            held, n = [[c[cut:] for c in columns]], n - cut
            enough = max(WALKED, 2 * n)
    if n:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, large: int = LARGE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): the component is named by the smallest id that is reachable over links."""
    prints = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    hooked = roots(links(classes, distance, large))
    # one row per fingerprint; the smallest id over the component's fingerprints
    rooted = classes.join(hooked, classes["fp"] == hooked["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    components = written(rooted.join(named, "root").select("fp", "component_id"), "components")
    return prints.join(components.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that are not the first of their component; every document needs an id of its own."""
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id"))
    return docs.join(gone, docs[id_col] == gone["__id"], "left_anti")
