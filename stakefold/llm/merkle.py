"""Merkle manifest of a dataset: a hash tree over the rows of each group, and one over the groups' roots.

Rows are numbered in their group and dealt to aligned blocks of 2^8 leaves.  A builder takes one block and appends its
nodes to a log in the order they are completed: a leaf, then every parent it completes.  That is the postorder of the
block's tree, so where a node stands follows from its level and index alone: leaf t comes after the 2t - popcount(t)
nodes that the t leaves before it complete, and a node of level l stands l places after its last leaf.  Parents find
their left child that way when they are written, and proofs address every sibling that way without a search.

The roots of the blocks are the leaves of the next tier, until a group has one root; no task ever holds more than a
block, however large a group is.  Logs are stored as a row a block.  Proofs go from the top down: a block's own path
to the root is found once and handed to all of its leaves.

Digests are SHA-256 over the hex texts of the children, one after the other; a last node without a partner is hashed alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakefold.llm import common

BITS = 8  # a block has 2^BITS leaves at most
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "grp string, block long, n long, size long, log binary, root binary"
PROOF = "key long, leaf binary, shown binary, path binary, subroot binary, root binary"
FOLDED = "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each as its UTF-8 length, a colon and itself, or - for a null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(child.hex().encode() for child in children)).digest()


def nodes_at(leaves: int, level: int) -> int:
    return -(-leaves >> level) if leaves else 0


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    return max(0, leaves - 1).bit_length()


def position(level: int, index: int, leaves: int) -> int:
    """Where the log of a tree of so many leaves holds a node."""
    last = min((index + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def block_height(n: int, bits: int) -> int:
    """A block of the only tier that is left ends in the root; any other one rises to the level of a full block."""
    return height_of(n) if n <= 1 << bits else bits


def append_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """The nodes of a block in the order they are completed; the last is its root."""
    log: list[bytes] = []
    last = len(leaves) - 1
    for t, leaf in enumerate(leaves):
        log.append(leaf)
        for level in range(1, height + 1):
            if (t + 1) & ((1 << level) - 1) and t != last:
                break
            child = t >> (level - 1)
            pair = [log[position(level - 1, child - 1, t + 1)], log[-1]] if child & 1 else [log[-1]]
            log.append(parent(pair))
    return log


def siblings(log: bytes, leaves: int, height: int, index: int) -> bytes:
    """The path of a leaf up to its block's root: a level is L or R and the sibling on that side, or - where none is."""
    path = []
    for level in range(height):
        own = index >> level
        if own ^ 1 < nodes_at(leaves, level):
            at = DIGEST * position(level, own ^ 1, leaves)
            path += [b"L" if own & 1 else b"R", log[at : at + DIGEST]]
        else:
            path.append(b"-")
    return b"".join(path)


def steps(path: bytes) -> Iterator[tuple[bytes, bytes | None]]:
    at = 0
    while at < len(path):
        side, at = path[at : at + 1], at + 1
        if side == b"-":
            yield side, None
        else:
            yield side, path[at : at + DIGEST]
            at += DIGEST


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf leads to by its path."""
    node = leaf
    for side, sibling in steps(path):
        node = parent([node] if sibling is None else [sibling, node] if side == b"L" else [node, sibling])
    return node


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (grp, ...) with idx, the running number from 0 in the group, and n, the group's size; stored.

    Rows are dealt by ranges of (grp, order), so a hot group is spread over many tasks; only a row per range and group
    takes part in the running sum."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "grp", *order).sortWithinPartitions("grp", *order)
    dealt = common.stored(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    runs = dealt.groupBy(F.col("grp").alias("g"), F.shiftright("at", 33).alias("part")).agg(
        F.min("at").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("g")
    runs = runs.withColumn("before", F.sum("size").over(whole.orderBy("part")) - F.col("size")).withColumn(
        "n", F.sum("size").over(whole))
    found = dealt.join(runs, F.col("grp").eqNullSafe(F.col("g")) & (F.shiftright("at", 33) == F.col("part")))
    found = found.withColumn("idx", F.col("at") - F.col("first") + F.col("before"))
    found = common.stored(found.drop("g", "part", "first", "size", "before", "at"), "merkle-numbered")
    common.drop_stored(dealt)
    return found


def logs_of(nodes: DataFrame, bits: int) -> DataFrame:
    """A log a block of the nodes (grp, idx, n, leaf); stored."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, of = [], None
        for batch in batches:
            for grp, block, n, leaf in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "n", "leaf")), strict=True):
                if held and of != (grp, block, n):
                    yield (*of, held)
                    held = []
                of = (grp, block, n)
                held.append(leaf)
        if held:
            yield (*of, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, block, n, leaves in blocks(batches):
            log = append_log(leaves, block_height(n, bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp], pa.string()), *(pa.array([v], pa.int64()) for v in (block, n, len(leaves))),
                 pa.array([b"".join(log)], pa.binary()), pa.array([log[-1]], pa.binary())], [f.split()[0] for f in LOG.split(", ")])

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select("grp", F.shiftright("idx", bits).alias("block"), "idx", "n", "leaf")
    dealt = dealt.repartition(parts, "grp", "block").sortWithinPartitions("grp", "block", "idx")
    return common.stored(dealt.mapInArrow(run, LOG), "merkle-log")


@dataclass
class Forest:
    """The tiers of logs of one tree a group, the first over the rows, and one root a group (grp, n, root)."""

    tiers: list[DataFrame]
    roots: DataFrame
    bits: int


def grown(nodes: DataFrame, bits: int = BITS) -> Forest:
    """The trees over nodes (grp, idx, n, leaf).  The number of tiers follows from the largest group's size."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tiers, level = [logs_of(nodes, bits)], nodes
    while most > 1 << bits:
        most = nodes_at(most, bits)
        blocks = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        level = tiers[-1].select("grp", F.col("block").alias("idx"), blocks.alias("n"), F.col("root").alias("leaf"))
        tiers.append(logs_of(level, bits))
    return Forest(tiers, tiers[-1].select("grp", "root"), bits)


def led(requests: DataFrame, logs: DataFrame, bits: int, keep: str) -> DataFrame:
    """The path of every request (grp, idx, ...) to the top, by the logs (grp, block, n, size, log, above, ...).

    A block's log comes first in its block, then its requests, one after the other; a task holds one log."""
    extra = [c for c in logs.columns if c not in ("grp", "block", "n", "size", "log", "above")]
    both = logs.withColumn("turn", F.lit(0)).unionByName(
        requests.withColumn("block", F.shiftright("idx", bits)).withColumn("turn", F.lit(1)).drop("n"), allowMissingColumns=True)
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(parts, "grp", "block").sortWithinPartitions("grp", "block", "turn")
    names = [f.split()[0] for f in keep.split(", ")]
    inputs = [c for c in names if c not in ("path", *extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log, above, size, height, more = b"", b"", 0, 0, ()
        for batch in batches:
            column = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            rows, paths, added = [], [], []
            for i, turn in enumerate(column["turn"]):
                if turn == 0:
                    log, above, size = column["log"][i], column["above"][i], column["size"][i]
                    height = block_height(column["n"][i], bits)
                    more = tuple(column[c][i] for c in extra)
                else:
                    rows.append(i)
                    paths.append(siblings(log, size, height, column["idx"][i] & ((1 << bits) - 1)) + above)
                    added.append(more)
            if rows:
                taken = batch.take(pa.array(rows))
                found = {c: taken.column(c) for c in inputs} | {"path": pa.array(paths, pa.binary())}
                found |= {c: pa.array([m[k] for m in added], pa.binary()) for k, c in enumerate(extra)}
                yield pa.RecordBatch.from_arrays([found[c] for c in names], names)

    return both.mapInArrow(run, keep)


def paths_to_blocks(forest: Forest, tops: DataFrame) -> DataFrame:
    """The logs of the first tier with above, every block's path to the very top; tops has it for the groups (grp,
    above), and what other binary columns it has are handed down too."""
    logs = forest.tiers[-1]
    g = F.col("grp").eqNullSafe(F.col("top"))
    logs = logs.drop("root").join(tops.withColumnRenamed("grp", "top"), g).drop("top")
    for below in reversed(forest.tiers[:-1]):
        extra = [c for c in logs.columns if c not in ("grp", "block", "n", "size", "log", "above")]
        asked = below.select("grp", F.col("block").alias("idx"), "size", "log", F.col("n").alias("m"))
        keep = "grp string, idx long, m long, size long, log binary, path binary" + "".join(f", {c} binary" for c in extra)
        held = asked.withColumnsRenamed({"size": "asked_size", "log": "asked_log"})
        found = led(held, logs, forest.bits, keep.replace("size long, log", "asked_size long, asked_log"))
        logs = found.select("grp", F.col("idx").alias("block"), F.col("m").alias("n"), F.col("asked_size").alias("size"),
                            F.col("asked_log").alias("log"), F.col("path").alias("above"), *extra)
        logs = common.stored(logs, "merkle-paths")
    return logs


def manifest(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """Proofs (key, leaf, shown, path, subroot, root) of the leaves (key, grp, leaf, shown): path leads from the leaf
    through its group's root to the root of all.

    Leaves ascend by key in their group, rows of one key by leaf and shown, null keys first; equal rows are leaves of
    their own.  Groups ascend bytewise, the null group first.  An empty table has no tree and no proof."""
    rows = numbered(leaves.select("key", F.col("grp").cast("string").alias("grp"), "leaf", "shown"), ["key", "leaf", "shown"])
    groups = grown(rows, bits)
    roots = groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("leaf"))
    # a null name sorts first by itself
    subroots = numbered(roots, ["name"])
    top = grown(subroots, bits)
    above = top.roots.select("grp", F.lit(b"").alias("above"), "root")
    found = led(subroots.withColumnRenamed("leaf", "subroot"), paths_to_blocks(top, above), bits,
                "name string, subroot binary, path binary, root binary")
    tops = common.stored(found.select(F.col("name").alias("grp"), F.col("path").alias("above"), "subroot", "root"), "merkle-tops")
    return led(rows, paths_to_blocks(groups, tops), bits, PROOF)


def checked(proofs: DataFrame) -> DataFrame:
    """Digests of the proofs, and whether the leaf that is shown (the leaf itself where that is null) leads to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, leaf, shown, path, subroot, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of = hashlib.sha256(b"".join(s.hex().encode() for _, s in steps(path) if s is not None)).hexdigest()
                reached = folded(leaf if shown is None else shown, path)
                out.append((key, leaf.hex(), subroot.hex(), root.hex(), of, reached.hex(), reached == root))
            if out:
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 [f.split()[0] for f in FOLDED.split(", ")])

    return proofs.select(*[f.split()[0] for f in PROOF.split(", ")]).mapInArrow(run, FOLDED)


def documents_manifest(docs: DataFrame, tampered: Column | None = None, bits: int = BITS) -> DataFrame:
    """Proofs of all documents by language, see manifest().  Where tampered holds, the leaf shown is that of the row with
    one more in n_chars; a null n_chars stays.  Whole texts are hashed where they are read; a null field differs from an
    empty one; columns other than the five are not read."""
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    more = [(F.col(c).cast("decimal(20,0)") + 1) if c == "n_chars" else F.col(c) for c in FIELDS]
    shown = F.lit(None).cast("binary") if tampered is None else F.when(tampered, leaf_digest(more))
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("lang").cast("string").alias("grp"),
                       leaf.alias("leaf"), shown.alias("shown"))
    return manifest(common.stored(rows, "merkle-leaves"), bits)
