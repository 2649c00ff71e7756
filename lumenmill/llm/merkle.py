"""Merkle manifest of a dataset: a tree for each source, one tree over their roots, and for every row the path that proves it.

A row's leaf is the hash of its columns, each with its byte count in front (null: ``-``). Nodes of a tree stand in runs of ``ARITY``; the last
run may be shorter, and a run of one is hashed too. Rows of a source ascend by id (null ids first, equal ids by their leaves; repeated
rows are leaves each); sources ascend by their bytes, null first. A digest is lower-case hex, and what is hashed are digests as text.

Leaves are ranked without a task per source (:func:`ordering.ranked`), and dealt out in aligned blocks of ``ARITY ** BLOCK_LEVELS``. Going up, each
block gives its root, and the roots are the nodes of the next round, until a tree has one. Going down, a task walks its block from left to
right with a fractal traversal and puts the path of the block's root, which came with the block, behind every path. A task holds one
block of digests and two small subtrees for every ``SPAN`` levels, whatever the size of a source.

A path is text: a level is the siblings before, a dot, the siblings after, and levels are joined by ``/``; a lone row of a lone source has the
empty path. An empty table gives no rows. Extra columns don't matter: only the named ones are read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage
from .ordering import ranked

ARITY, BLOCK_LEVELS, SPAN = 3, 6, 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(*columns: Column) -> Column:
    """The digest of a row."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def siblings_sha256(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.translate(path, "./", ""), 256)


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its path lead to."""
    up = F.aggregate(F.split(path, "/"), start, lambda node, level: F.sha2(F.concat(F.substring_index(level, ".", 1), node, F.substring_index(level, ".", -1)), 256))
    return F.when(path == "", start).otherwise(up)


def _hash(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


def widths(n: int, levels: int) -> list[int]:
    """Nodes at every level over n leaves."""
    out = [n]
    for _ in range(levels):
        out.append(-(-out[-1] // ARITY))
    return out


def height(n: int) -> int:
    """Levels until one node is left."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


class Subtree:
    """A subtree in the making, from one leaf at a time. Nodes from level ``low`` to below ``high`` stay; lower ones go when their run is hashed."""

    def __init__(self, number: int, low: int, high: int, wide: list[int]):
        self.number, self.low, self.high, self.wide = number, low, high, wide
        self.kept: list[list[bytes]] = [[] for _ in range(low, high)]
        self.runs: list[list[bytes]] = [[] for _ in range(high)]
        self.at = [number * ARITY ** (high - j) for j in range(high)]
        self.first, self.root = number * ARITY**high, b""

    def add(self, node: bytes) -> None:
        for j in range(self.high):
            if j >= self.low:
                self.kept[j - self.low].append(node)
            run = self.runs[j]
            run.append(node)
            self.at[j] += 1
            if len(run) < ARITY and self.at[j] < self.wide[j]:
                return
            node = _hash(run)
            run.clear()
        self.root = node

    def level(self, j: int, leaf_no: int) -> bytes:
        """Siblings of a leaf's ancestor at level j."""
        at = leaf_no // ARITY**j - self.number * ARITY ** (self.high - j)
        nodes, lo = self.kept[j - self.low], at - at % ARITY
        return b"".join(nodes[lo:at]) + b"." + b"".join(nodes[at + 1 : lo + ARITY])


def block_root(leaves: list[bytes], levels: int) -> bytes:
    tree = Subtree(0, levels, levels, widths(len(leaves), levels))
    for x in leaves:
        tree.add(x)
    return tree.root if levels else leaves[0]


def traverse(leaves: list[bytes], levels: int, span: int = SPAN) -> Iterator[bytes]:
    """Paths of all leaves, in order. Of every ``span`` levels one subtree exists, that above the present leaf, and the next one is desired: it gets a leaf for every path that is told, and is
    ready when the present one ends."""
    wide = widths(len(leaves), levels)
    bounds = [(low, min(low + span, levels)) for low in range(0, levels, span)]
    existing, desired = [Subtree(0, *b, wide) for b in bounds], [Subtree(1, *b, wide) for b in bounds]
    for tree in existing:
        for x in leaves[: ARITY**tree.high]:
            tree.add(x)
    parts = [b""] * levels
    for r in range(len(leaves)):
        for i, tree in enumerate(existing):
            if r and r % ARITY**tree.high == 0:
                existing[i], desired[i] = desired[i], Subtree(desired[i].number + 1, *bounds[i], wide)
        for j in range(levels):
            if j and r % ARITY**j:
                break  # the ancestors from here on are those of the leaf before
            parts[j] = existing[j // span].level(j, r)
        yield b"/".join(parts)
        for i, tree in enumerate(desired):
            at = tree.first + r - existing[i].first
            if at < len(leaves):
                tree.add(leaves[at])


def _groups(batches, keys: tuple[int, ...]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, across batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for b in batches:
        names, lo = list(zip(*(b.column(i).to_pylist() for i in keys), strict=True)), 0
        for i, k in enumerate(names):
            if k != key:
                if i > lo:
                    held.append(b.slice(lo, i - lo))
                if held:
                    yield pa.Table.from_batches(held)
                held, key, lo = [], k, i
        if b.num_rows > lo:
            held.append(b.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


def _gathered(tables: Iterator[pa.Table], most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Few batches of many small tables."""
    held, n = [], 0
    for t in tables:
        held.append(t)
        n += t.num_rows
        if n >= most:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _in_block(total: int, levels: int) -> int:
    return levels if total > ARITY**levels else height(total)


def _climb(nodes: DataFrame, folder: str, levels: int) -> list[DataFrame]:
    """The nodes (tree, rank, total, node), the roots of their blocks, and so on until every tree has one node."""
    out, size = [nodes], ARITY**levels

    def roots(batches):
        def rows():
            for t in _groups(batches, (0, 1)):
                total = t.column(2)[0].as_py()
                node = block_root([x.encode() for x in t.column(3).to_pylist()], _in_block(total, levels))
                yield pa.table({"tree": t.column(0).slice(0, 1), "rank": t.column(1).slice(0, 1), "total": pa.array([-(-total // size)], pa.int64()), "node": [node.decode()]})

        yield from _gathered(rows())

    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        at = out[-1].withColumn("block", F.floor(F.col("rank") / size)).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
        up = at.select("tree", "block", "total", "node").mapInArrow(roots, "tree string, rank long, total long, node string")
        out.append(storage.staged(up, f"{folder}/{len(out)}"))
    return out


def _descend(nodes: DataFrame, upper: DataFrame, carried: list[str], schema: str, levels: int) -> DataFrame:
    """The paths of nodes: within their block, then that of the block's root, which ``upper`` (tree, rank, path, subroot, root) has."""
    size = ARITY**levels
    row = nodes.select("tree", F.floor(F.col("rank") / size).alias("block"), "rank", "total", "node", F.lit("").alias("path"), F.lit("").alias("subroot"), F.lit("").alias("root"), *carried)
    head = upper.select("tree", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"), F.lit(0).cast("long").alias("total"), F.lit("").alias("node"), "path", "subroot", "root", *(F.lit(None).cast(row.schema[c].dataType).alias(c) for c in carried))
    rows = row.union(head).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")

    def run(batches):
        def paths():
            for t in _groups(batches, (0, 1)):
                above, n = t.slice(0, 1).to_pylist()[0], t.num_rows - 1
                own = t.slice(1)
                inner = _in_block(own.column("total")[0].as_py(), levels)
                tail = above["path"].encode()
                ends = (b"/" + tail if tail and inner else tail,) * n
                path = [(p + e).decode() for p, e in zip(traverse([x.encode() for x in own.column("node").to_pylist()], inner), ends, strict=True)]
                yield pa.table({"tree": own.column("tree"), "rank": own.column("rank"), "node": own.column("node"), "path": pa.array(path, pa.string()), "subroot": [above["subroot"]] * n, "root": [above["root"]] * n} | {c: own.column(c) for c in carried})

        yield from _gathered(paths())

    return rows.mapInArrow(run, "tree string, rank long, node string, path string, subroot string, root string" + schema)


def manifest(rows: DataFrame, folder: str, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Of ``rows`` (doc_id, source, leaf and any more columns, which are carried along) all columns with ``path``, ``subroot`` and ``root``."""
    carried = [c for c in rows.columns if c not in ("source", "leaf")]
    tree = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source")))  # null before every text
    leaves = storage.staged(rows.select(tree.alias("tree"), F.col("leaf").alias("node"), *carried), f"{folder}/leaves")
    own = _climb(ranked(leaves, ["tree"], ["doc_id", "node"], f"{folder}/order"), f"{folder}/nodes", levels)
    sources = ranked(own[-1].select(F.lit("").alias("one"), "tree", "node"), ["one"], ["tree"], f"{folder}/sources")
    over = _climb(sources.select(F.col("one").alias("tree"), "rank", "total", "node", F.col("tree").alias("of")), f"{folder}/upper", levels)
    paths = over[-1].select("tree", "rank", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for i in range(len(over) - 2, -1, -1):
        paths = _descend(over[i], paths, *((["of"], ", of string") if i == 0 else ([], "")), levels)
    if len(over) == 1:
        paths = over[0].select("of", "node", F.lit("").alias("path"), F.col("node").alias("root"))
    paths = storage.staged(paths.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("rank"), "path", F.col("node").alias("subroot"), "root"), f"{folder}/paths")
    for i in range(len(own) - 1, -1, -1):
        if i == len(own) - 1 and i:
            continue  # the roots of the sources, whose paths are known
        names = carried if i == 0 else []
        paths = _descend(own[i], paths, names, "".join(f", {c} {own[i].schema[c].dataType.simpleString()}" for c in names), levels)
    source = F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30)).alias("source")
    return paths.select(*carried, source, F.col("node").alias("leaf"), "subroot", "root", "path")


def proved(docs: DataFrame, folder: str, seen: Column | None = None, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """doc_id, source, leaf, subroot, root, path, and what a check of the path gives when a row's leaf is now ``seen`` (a column over ``docs``; the leaf, if not given):
    ``folded_root`` and ``verified``."""
    own = leaf(*(F.col(c) for c in columns))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), own.alias("leaf"), (own if seen is None else seen).alias("seen"))
    found = manifest(rows, folder).withColumn("folded_root", folded(F.col("path"), F.col("seen")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop("seen")
