"""Merkle manifest of a dataset: a tree of digests over all rows, kept as records by content, and proofs from it.

A row's leaf is the digest of its columns. Leaves of a source, in the order of their ids, are taken 16 at a time; the
digests of a run, as one text, give the digest of the node above, and so on until one is left, the source's subroot.
Subroots, in the order of the sources, give the root in the same way. Every node is a record (digest, children), found
by its digest alone.

Where a leaf stands is a path of hexadecimal digits: those of its source among the sources, then those of its rank in
the source, each digit the place in a run. A proof descends from the root: the record of the digest in hand lists the
children, the next digit chooses one, the others are collected as a segment of the path. Leaves with a common
beginning of their paths descend together, so the upper nodes are looked up once and not once per leaf, and the last run
serves its 16 leaves at once. Segments, turned round, lead from the leaf back to the root.

Ranks come from range partitions, so a source that holds most rows is in no task alone; whatever is grouped has at most
16 members.

- A null in a column has a mark of its own, an empty text is not a null. Null sources, and null ids within a source, come
  first. Rows of one source and id are ordered by their leaf; equal rows are leaves of their own, one after the other.
- An empty table has no root, and its proofs are an empty table. Columns other than those named play no part.
- Texts are hashed whole; only digests are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import written
from wattlake.operators.ranking import numbered

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NONE = "CAST(array() AS array<struct<l: string, r: string>>)"


def digest_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(*values: Column) -> Column:
    """Digest of columns, each with its length in bytes, so that no two rows read alike."""
    texts = [v.cast("string") for v in values]
    return digest_of(F.concat(*(
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)))


def _hex(position: Column, digits: Column) -> Column:
    return F.lpad(F.lower(F.hex(position)), digits, F.lit("0"))


def _levels(n: Column) -> Column:
    """Levels above ``n`` nodes: how often they must be grouped until one is left."""
    return F.when(n <= 1, 0).otherwise(F.length(F.hex(n - 1)))


@dataclass
class Manifest:
    """``leaves``: (doc_id, source, leaf, subroot, path and what else was given); records (digest, children) of the nodes
    over sources and of those over leaves, the lowest level first; ``root``."""

    leaves: DataFrame
    over_sources: list[DataFrame]
    over_leaves: list[DataFrame]
    root: str | None


def _grown(nodes: DataFrame, key: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Records of every level above ``nodes`` (key, position, digest, n), n being the nodes of that key; and the tops."""
    levels, tops = [], nodes.where("n = 1").select(*key, "digest")
    while nodes.where("n > 1").take(1):
        runs = nodes.where("n > 1").groupBy(*key, "n", F.floor(F.col("position") / FANOUT).alias("run")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("position", "digest"))), lambda c: c["digest"]).alias("children"))
        runs = written(runs.select(
            *key, F.col("run").alias("position"), digest_of(F.array_join("children", "")).alias("digest"), "children",
            F.ceil(F.col("n") / FANOUT).alias("n")), "merkle-level")
        levels.append(written(runs.select("digest", "children").dropDuplicates(["digest"]), "merkle-records"))
        tops = tops.unionByName(runs.where("n = 1").select(*key, "digest"))
        nodes = runs.drop("children")
    return levels, tops


def build(leaves: DataFrame) -> Manifest:
    """The manifest of rows (doc_id, source, leaf and others); they are written before they are ordered."""
    given = written(leaves.withColumn("_tag", F.monotonically_increasing_id()), "merkle-leaves")
    ordered = numbered(given, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_tag")])
    placed = written(ordered.drop("_tag"), "merkle-ranks")
    sizes = written(placed.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("n")), "merkle-sizes")
    nodes = placed.join(sizes, placed["source"].eqNullSafe(sizes["_source"])).select(
        "source", "position", F.col("leaf").alias("digest"), "n")
    over_leaves, subroots = _grown(nodes, ["source"])
    sources = subroots.join(sizes, subroots["source"].eqNullSafe(sizes["_source"])).select("_source", "digest", "n")
    tops = written(numbered(written(sources, "merkle-subroots"), (), [F.col("_source").asc_nulls_first()]), "merkle-sources")
    count = tops.count()
    over_sources, root = _grown(tops.select(F.lit(0).alias("tree"), "position", "digest", F.lit(count).alias("n")), ["tree"])
    found = root.take(1)
    head = F.lit(len(over_sources))
    heads = tops.select("_source", F.col("digest").alias("subroot"), _hex(F.col("position"), head).alias("_head"),
                        _levels(F.col("n")).alias("_digits"))
    names = [c for c in placed.columns if c != "position"]
    paths = placed.join(heads, placed["source"].eqNullSafe(heads["_source"])).select(
        *names, "subroot", F.concat("_head", _hex(F.col("position"), F.col("_digits"))).alias("path"))
    return Manifest(written(paths, "merkle-paths"), over_sources, over_leaves, found[0]["digest"] if found else None)


def _children(here: DataFrame, wanted: DataFrame) -> DataFrame:
    """(prefix, digest, segments) of the children that are asked for."""
    child = here.select("prefix", "segments", "children", F.posexplode("children").alias("place", "digest"))
    return child.select(
        F.concat("prefix", F.lower(F.hex("place"))).alias("prefix"), "digest",
        F.concat("segments", F.array(_segment(F.col("children"), F.col("place")))).alias("segments"),
    ).join(wanted, "prefix", "left_semi")


def _descended(manifest: Manifest, runs: DataFrame) -> DataFrame:
    """(prefix, children, segments) of all nodes on the way from the root to the lowest nodes asked for in ``runs``.

    Down to the sources by depth, and from there by height, so that the records of a level are read once.
    """
    head = len(manifest.over_sources)
    digits = F.length("prefix") + 1 - head
    at = runs.sparkSession.createDataFrame([("", manifest.root)], "prefix string, digest string").withColumn("segments", F.expr(_NONE))
    passed = []
    for depth, records in enumerate(reversed(manifest.over_sources), 1):
        passed.append(written(at.join(records, "digest").select("prefix", "children", "segments"), "merkle-descent"))
        wanted = runs.where(F.length("prefix") >= depth).select(F.substring("prefix", 1, depth).alias("prefix")).distinct()
        at = _children(passed[-1], wanted)
    heights = runs.where(digits >= 1).select(F.substring("prefix", 1, head).alias("prefix"), digits.alias("height")).distinct()
    entering = written(at.join(heights, "prefix"), "merkle-entering")
    at = None
    for height, records in reversed(list(enumerate(manifest.over_leaves, 1))):
        new = entering.where(F.col("height") == height).drop("height")
        at = new if at is None else at.unionByName(new)
        passed.append(written(at.join(records, "digest").select("prefix", "children", "segments"), "merkle-descent"))
        wanted = runs.where(digits >= height).select(F.expr(f"substring(prefix, 1, length(prefix) + 2 - {height})").alias("prefix")).distinct()
        at = _children(passed[-1], wanted)
    return reduce(DataFrame.unionByName, passed)


def _segment(children: Column, place: Column) -> Column:
    """What stands left and right of the chosen child."""
    left = F.slice(children, F.lit(1), place)
    right = F.slice(children, place + 2, F.greatest(F.size(children) - place - 1, F.lit(0)))
    return F.struct(F.array_join(left, "").alias("l"), F.array_join(right, "").alias("r"))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (rows of ``manifest.leaves``, each at most once) with ``segments`` from the leaf up to the root."""
    names = requests.columns
    alone = requests.where("path = ''").withColumn("segments", F.expr(_NONE))
    grouped = requests.where("path <> ''").groupBy(F.expr("substring(path, 1, length(path) - 1)").alias("prefix")).agg(
        F.collect_list(F.struct(*names)).alias("asked"))
    runs = written(grouped, "merkle-requests")
    if manifest.root is None or not runs.take(1):
        return alone
    place = F.conv(F.substring(F.col("one.path"), -1, 1), 16, 10).cast("int")
    each = runs.join(_descended(manifest, runs.select("prefix")), "prefix").select("children", "segments", F.explode("asked").alias("one"))
    up = F.reverse(F.concat("segments", F.array(_segment(F.col("children"), place))))
    return each.select("one.*", up.alias("segments")).unionByName(alone)


def folded(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segments, leaf, lambda node, s: digest_of(F.concat(s["l"], node, s["r"])))


def proof_text(segments: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["l"], s["r"])), "")


def tampered_text(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def verify(docs: DataFrame, every: int = 5) -> DataFrame:
    """A proof of every row, checked with its leaf, or with a changed leaf where ``every`` divides the id's checksum."""
    fields = [F.col(c) for c in COLUMNS]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % every == 0, F.lit(False))
    other = leaf_of(*fields[:-1], tampered_text(F.col("text")))
    manifest = build(docs.select("doc_id", "source", leaf_of(*fields).alias("leaf"), F.when(changed, other).alias("changed")))
    out = prove(manifest, manifest.leaves).select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"),
        digest_of(proof_text(F.col("segments"))).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("segments")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
