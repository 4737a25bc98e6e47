"""Near duplicates by the similarity of shingle sets, as the pipeline drops them.

Two documents are linked when the sets of their five-word shingles have a Jaccard similarity of at least ``SIMILARITY``,
counted exactly. What is counted comes from the tries over fingerprints in ``simhash``: documents whose wide SimHash
fingerprints are near each other, directly or through others, form a cluster (``simhash.wide_links`` says how surely).

In a cluster of up to ``SMALL`` all pairs are counted. The links of a larger one are found without all pairs and without
loss (``_refined``): of its documents only the difference from its centre is looked at, the shingles that most of a sample
of them have. Where the differences of two documents are together small enough, both are linked to the document nearest to the centre, one count a
document. Any other similar pair must have shingles of its differences in common, and so many that one is among the first of
either; by these the documents are dealt to smaller groups, which are treated alike, each with a centre of its own, until
at most ``COUNTED`` are left, whose pairs are all counted. What members of a group share falls away with the centre, so
neither a family of copies nor a text that many documents quote is compared in all pairs.

Documents that hang together form one component, of which the smallest id stays. So a document may go that is similar to
one that goes as well, but not to the one that stays.

- Words are separated by ASCII white space; A-Z is lower-cased. A text of fewer words than a shingle is one shingle.
- A text without words (null, empty) has no shingles and is like no other; a null id is linked to nothing.
- ``survivors`` takes rows one by one, also where ids repeat: of equal ids and similar texts one row stays, a row that is like
  no other stays whatever else has its id. An empty table stays empty; other columns are kept and never looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattlake.llm import simhash
from wattlake.llm.common import batches_of, free_name, id_and_text, rows, written
from wattlake.llm.components import roots

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: Fingerprints of so few shingles and of one less are too far apart for the tries; such a set also has those of one less.
FEW = 5
#: Clusters of at most so many are compared in all pairs at once, and groups by shingles of so many.
SMALL = 8
COUNTED = 256
#: About so many members of a group say where its centre is.
SAMPLED = 64
#: Shingles that are looked at together in all sets of a group.
STEP = 1024


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    pieces = map(joined.__getitem__, map(slice, starts[:n].tolist(), ends[width - 1:].tolist()))
    return np.unique(np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) and len(b) else 0.0


def _prints(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.binary())])

    def run(batches):
        def made():
            for doc_id, text in rows(batches, "doc_id", "text"):
                hashes = shingles(text)
                if len(hashes):
                    yield doc_id, simhash.wide_fingerprint(hashes)
                for k in range(FEW if len(hashes) == FEW else 0):
                    yield doc_id, simhash.wide_fingerprint(np.delete(hashes, k))

        return batches_of(made(), schema)

    return docs.mapInArrow(run, "doc_id long, fp binary")


def _sets(docs: DataFrame) -> DataFrame:
    """Each text as its shingles; other columns, longs, are kept."""
    others = [c for c in docs.columns if c != "text"]
    schema = pa.schema([*((c, pa.int64()) for c in others), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        return batches_of(((*own, shingles(t).view(np.int64)) for *own, t in rows(batches, *others, "text")), schema, 64)

    return docs.select(*others, "text").mapInArrow(run, f"{', '.join(f'{c} long' for c in others)}, shingles array<long>")


def _sorted_groups(batches, *columns: str):
    """(group, rows) from batches that are sorted by ``group``."""
    current, held = None, []
    for group, *row in rows(batches, "group", *columns):
        if held and group != current:
            yield current, held
            held = []
        current = group
        held.append(row)
    if held:
        yield current, held


def _similar(members: DataFrame, least: float) -> DataFrame:
    """The pairs of a group whose texts have a similarity of ``least`` or more. Texts move, which pack better than sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        def made():
            for _, held in _sorted_groups(batches, "doc_id", "text"):
                sets = [(doc_id, shingles(text)) for doc_id, text in sorted(held)]
                for (x, of_x), (y, of_y) in combinations(sets, 2):
                    if similarity(of_x, of_y) >= least:
                        yield x, y

        return batches_of(made(), schema)

    return members.select("group", "doc_id", "text").repartition("group").sortWithinPartitions("group").mapInArrow(run, "a long, b long")


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of some sets share, as a matrix."""
    distinct, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order], place[order]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, len(distinct), STEP):
        inside = slice(*np.searchsorted(place, (at, at + STEP)))
        has = np.zeros((len(sets), min(STEP, len(distinct) - at)), np.float32)
        has[owner[inside], place[inside] - at] = 1
        shared += has @ has.T
    return shared


def _counted(part: DataFrame, least: float) -> DataFrame:
    """The similar pairs of small groups, but for those that an earlier centre has linked."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        def made():
            for _, held in _sorted_groups(batches, "doc_id", "n", "diff", "mask"):
                if len(held) < 2:
                    continue
                ids, n, mask = (np.array([r[k] for r in held], np.int64) for k in (0, 1, 3))
                diffs = [np.array(r[2], np.int64) for r in held]
                sizes = np.array([len(d) for d in diffs])
                # the difference of two documents is that of their differences from the centre
                apart = sizes[:, None] + sizes[None, :] - 2 * _common(diffs)
                both = n[:, None] + n[None, :]
                near = ((both - apart) / (both + apart) >= least) & ((mask[:, None] & mask[None, :]) == 0)
                for x, y in np.argwhere(np.triu(near, 1)).tolist():
                    yield int(ids[x]), int(ids[y])

        return batches_of(made(), schema)

    return part.repartition("group").sortWithinPartitions("group").mapInArrow(run, "a long, b long")


def _centres(part: DataFrame, depth: int) -> DataFrame:
    """(group, centre): the shingles that over half of a group's sample have; any centre gives right results."""
    schema = pa.schema([("group", pa.int64()), ("centre", pa.list_(pa.int64()))])

    def run(batches):
        def made():
            for group, held in _sorted_groups(batches, "diff"):
                values, counts = np.unique(np.concatenate([np.array(r[0], np.int64) for r in held]), return_counts=True)
                yield group, values[2 * counts > len(held)]

        return batches_of(made(), schema, 64)

    drawn = F.pmod(F.xxhash64("doc_id", F.lit(depth)), F.col("size")) < SAMPLED
    sample = part.where(drawn).select("group", "diff").repartition("group").sortWithinPartitions("group")
    return sample.mapInArrow(run, "group long, centre array<long>")


def _from_centre(part: DataFrame, centres: DataFrame) -> DataFrame:
    """``part`` with differences from the new centre; what the centre lacks comes first, it is shared the least."""
    schema = pa.schema([("group", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("mask", pa.int64()), ("diff", pa.list_(pa.int64()))])

    def run(batches):
        def made():
            for group, doc_id, n, mask, diff, centre in rows(batches, "group", "doc_id", "n", "mask", "diff", "centre"):
                own, middle = np.array(diff, np.int64), np.array(centre or (), np.int64)
                added, missing = np.setdiff1d(own, middle, True), np.setdiff1d(middle, own, True)
                yield group, doc_id, n, mask, np.concatenate((added, missing))

        return batches_of(made(), schema, 256)

    joined = part.join(centres, "group", "left").select("group", "doc_id", "n", "mask", "diff", "centre")
    return joined.mapInArrow(run, "group long, doc_id long, n long, mask long, diff array<long>")


def _refined(part: DataFrame, least: float, small: int) -> DataFrame | None:
    """Links that join all similar documents of a group, directly or through others.

    ``part``: (group, doc_id, n, diff, mask), n being the size of a document's set, diff how it differs from what the
    group has in common so far, mask the levels at which it was linked to the one nearest to the centre.

    With r = (1 - least) / (1 + least), documents x and y are similar if and only if they differ in at most r * (n_x + n_y)
    shingles. Let q = |diff| - r * n. If q_x + q_y <= 0 they are similar, and both are similar to the document c with the
    smallest q. If not, they must share at least (q_x + q_y) / 2 elements of diff; each of them shares no fewer than a bound
    o that it knows alone, and one of those is among the first |diff| - o + 1 of both.
    """
    ratio = (1 - least) / (1 + least)
    links, depth = [], 0
    while True:
        sizes = written(part.groupBy("group").agg(F.count("*").alias("size"), F.bit_and("mask").alias("shared"))
                        .where("size > 1 AND shared = 0").drop("shared"), "refined-sizes")
        part = written(part.join(sizes, "group"), "refined-groups")
        links.append(written(_counted(part.where(F.col("size") <= small), least), "refined-counted"))
        part = part.where(F.col("size") > small)
        if not part.take(1):
            return reduce(DataFrame.unionByName, links)
        placed = written(_from_centre(part, written(_centres(part, depth), "refined-centres")), "refined-differences")
        q = F.size("diff") - ratio * F.col("n")
        nearest = placed.groupBy("group").agg(F.min(F.struct(q.alias("q"), "doc_id")).alias("c"))
        nearest = written(nearest.select("group", F.col("c.doc_id").alias("c"), F.col("c.q").alias("q_c")), "refined-nearest")
        told = placed.join(nearest, "group").withColumn("q", q).withColumn("linked", F.col("q") + F.col("q_c") <= 1e-9)
        links.append(written(told.where("linked AND doc_id <> c").select(
            F.least("doc_id", "c").alias("a"), F.greatest("doc_id", "c").alias("b")).distinct(), "refined-stars"))
        bound = F.greatest(F.lit(1.0), F.size("diff") - ratio * (1 + 1 / least) * F.col("n"),
                           F.when(F.col("linked"), (F.col("q") - F.col("q_c")) / 2).otherwise(0.0))
        first = F.greatest(F.size("diff") - F.ceil(bound - 1e-9).cast("int") + 1, F.lit(0))
        mask = F.col("mask").bitwiseOR(F.when(F.col("linked"), F.lit(1 << min(depth, 62))).otherwise(0)) if depth < 63 else F.col("mask")
        dealt = told.select("group", "doc_id", mask.alias("mask"), F.explode(F.slice("diff", F.lit(1), first)).alias("token"))
        dealt = written(dealt.select("group", "doc_id", "mask", F.xxhash64("group", "token").alias("next")), "refined-dealt")
        again = dealt.groupBy("next").agg(F.count("*").alias("size"), F.bit_and("mask").alias("shared"))
        again = written(again.where("size > 1 AND shared = 0").select("next"), "refined-again")
        dealt = dealt.join(again, "next")
        part = dealt.join(placed.select("group", "doc_id", "n", "diff"), ["group", "doc_id"]).select(
            F.col("next").alias("group"), "doc_id", "n", "diff", "mask")
        part, depth = written(part, "refined-part"), depth + 1


def linked(docs: DataFrame, least: float = SIMILARITY, small: int = SMALL, counted: int = COUNTED, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(node, root) of every document that hangs together with a smaller id, ``root`` being the smallest."""
    texts = id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    prints = written(_prints(texts), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "classes")
    same = prints.join(classes, "fp").where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    hung = roots(simhash.wide_links(classes).unionByName(same))
    clusters = written(hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct()), "clusters")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    clusters = written(clusters.join(sizes, "root"), "sized-clusters")
    held = texts.join(clusters, texts["doc_id"] == clusters["node"]).select("doc_id", F.col("root").alias("group"), "size", "text")
    held = written(held, "clustered-texts")
    links = written(_similar(held.where(F.col("size") <= small), least), "similar")
    sets = written(_sets(held.where(F.col("size") > small).drop("size")), "shingle-sets")
    part = sets.select("group", "doc_id", F.size("shingles").cast("long").alias("n"), F.col("shingles").alias("diff"),
                       F.lit(0).cast("long").alias("mask"))
    return roots(links.unionByName(_refined(part, least, counted)).distinct())


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id.

    Only where ids repeat, rows are written once more, with numbers that tell them apart.
    """
    own = F.col(id_col).cast("long")
    repeated = docs.select(own.alias("id")).where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.take(1):
        gone = linked(docs, id_col=id_col, text_col=text_col).select(F.col("node").alias("gone"))
        return docs.join(gone, docs[id_col].cast("long") == gone["gone"], "left_anti")
    row = free_name(docs, "row")
    tagged = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-documents")
    named = tagged.where(F.col(id_col).isNotNull()).select(
        F.col(row).alias("row"), own.alias("id"), F.col(text_col).alias("text"))
    hung = linked(named, id_col="row")
    members = hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())
    members = members.join(named.select("row", "id"), F.col("node") == F.col("row")).select("node", "root", "id")
    stays = members.groupBy("root").agg(F.min(F.struct("id", "node"))["node"].alias("stays"))
    gone = members.join(stays, "root").where("node <> stays").select(F.col("node").alias("gone"))
    return tagged.join(gone, tagged[row] == gone["gone"], "left_anti").drop(row)
