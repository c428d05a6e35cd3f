"""Merkle manifest of a table: a tree of fan 16 per group, and one over the groups' roots.

The leaves of a group are numbered by one range sort. Aligned subtrees of 16 ** HEIGHT leaves are
built each in a group of its own and stored as a row whose nodes lie in van Emde Boas order: a tree is
split at half its height, the upper part stands first, then the lower ones in turn, each stored the
same way, so a path from leaf to root meets few stretches of memory whatever the size of a cache
line. Block roots are the leaves of the next stage, until one is left. Proofs go the other way:
a block that knows the path of its own root hands each of its leaves its siblings and that path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.frames import widened
from millrace.session import stage

FAN_BITS = 4
HEIGHT = 3
FAN = 1 << FAN_BITS
TAMPER_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- digests -----------------------------------------------------------------------------------

def field(value: Column) -> Column:
    """`-` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 over the fields of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def node_digest(children: bytes) -> bytes:
    """The digest over children given as hex text."""
    return hashlib.sha256(children).hexdigest().encode()


# --- van Emde Boas order -----------------------------------------------------------------------

def widths(leaves: int, levels: int) -> list[int]:
    """Nodes at each depth, from the root, of a tree of so many levels whose leaves stand left."""
    return [-(-leaves >> FAN_BITS * (levels - 1 - depth)) for depth in range(levels)]


def addresses(depth: int, index: np.ndarray, leaves: int, levels: int) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes `index` at `depth` (0 is the root) of a tree with
    `leaves` leaves, all of them to the left, on `levels` levels. Only nodes that exist have a place."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    count = widths(leaves, levels)
    if depth < top:
        return addresses(depth, index, count[top - 1], top)
    low = levels - top
    whole = sum(widths(1 << FAN_BITS * (low - 1), low))
    tree = index >> FAN_BITS * (depth - top)
    inner = index - (tree << FAN_BITS * (depth - top))
    out = sum(count[:top]) + tree * whole
    # all lower trees but the last are complete
    last = count[top] - 1
    own = leaves - (last << FAN_BITS * (low - 1))
    full = tree < last
    out[full] += addresses(depth - top, inner[full], 1 << FAN_BITS * (low - 1), low)
    out[~full] += addresses(depth - top, inner[~full], own, low)
    return out


def levels_of(leaves: int, tall: bool, height: int = HEIGHT) -> int:
    """Levels of a block's tree: height + 1 in a group of several blocks, else as few as do."""
    if tall:
        return height + 1
    levels = 1
    while widths(leaves, levels)[0] > 1:
        levels += 1
    return levels


def build_nodes(leaves: list[bytes], levels: int) -> bytes:
    """All nodes over leaves (hex), as 32 bytes each in van Emde Boas order; the root is the first."""
    out = np.empty((sum(widths(len(leaves), levels)), 32), dtype=np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        raw = np.frombuffer(bytes.fromhex(b"".join(row).decode()), dtype=np.uint8).reshape(-1, 32)
        out[addresses(depth, np.arange(len(row)), len(leaves), levels)] = raw
        if depth:
            row = [node_digest(b"".join(row[k : k + FAN])) for k in range(0, len(row), FAN)]
    return out.tobytes()


def runs_of(nodes: bytes, leaves: int, levels: int) -> list[list[bytes]]:
    """Per level from the leaves, below the root, the hex text of each run of siblings."""
    held = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, 32)
    out = []
    for depth in range(levels - 1, 0, -1):
        count = widths(leaves, levels)[depth]
        text = held[addresses(depth, np.arange(count), leaves, levels)].tobytes().hex().encode()
        out.append([text[k : k + 64 * FAN] for k in range(0, len(text), 64 * FAN)])
    return out


# --- paths -------------------------------------------------------------------------------------

Path = list[tuple[int, bytes]]  # per level: the place in the run, the run's digests as hex text


def pack_path(path: Path) -> bytes:
    return b"".join(bytes((place, len(run) // 64)) + bytes.fromhex(run.decode()) for place, run in path)


def unpack_path(raw: bytes) -> Path:
    out, at = [], 0
    while at < len(raw):
        end = at + 2 + 32 * raw[at + 1]
        out.append((raw[at], raw[at + 2 : end].hex().encode()))
        at = end
    return out


def siblings(place: int, run: bytes) -> bytes:
    return run[: 64 * place] + run[64 * place + 64 :]


def fold(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf and its siblings give, all as hex text."""
    for place, run in path:
        leaf = node_digest(run[: 64 * place] + leaf + run[64 * place + 64 :])
    return leaf


def path_in_block(runs: list[list[bytes]], index: int) -> Path:
    """Levels of a block's leaf, up to the block's root."""
    return [(index >> FAN_BITS * k & FAN - 1, level[index >> FAN_BITS * (k + 1)]) for k, level in enumerate(runs)]


# --- building ----------------------------------------------------------------------------------

@dataclass
class Manifest:
    """stages: frames (grp, block, n, nodes[, members]), the leaves' blocks first;
    roots: (grp, stage, subroot), the stage being that at which the group's last block lies."""

    stages: list[DataFrame]
    roots: DataFrame
    height: int


def _numbered(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """`rows` with `block`, the place among the rows of its `grp` by `order`, over `size`, and `at`,
    the place in that block.

    One range sort lays them out and is written; the rows of a partition's first group may continue
    earlier partitions, which takes one number a partition.
    """
    schema = pa.schema([("part", pa.int64()), ("place", pa.int64())])
    at = rows.columns.index("grp")

    def number(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in them:
            places = []
            for name, same in groupby(batch.column(at).to_pylist()):
                more = sum(1 for _ in same)
                count = count if name == last else 0
                places.append(np.arange(count, count + more))
                last, count = name, count + more
            if places:
                own = [pa.array(np.full(batch.num_rows, part)), pa.array(np.concatenate(places).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, *schema.names])

    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    laid = stage(ranged.mapInArrow(number, widened(rows.schema, "part long, place long")), "manifest-rows")
    ends = laid.groupBy("part").agg(F.min("grp").alias("low"), F.max(F.struct("grp", "place")).alias("high"))
    carries, name, count = [], None, 0
    for r in sorted(ends.collect()):  # a row a partition
        carry = count if r["low"] == name else 0
        carries.append((r["part"], r["low"], carry))
        name = r["high"]["grp"]
        count = r["high"]["place"] + 1 + (carry if name == r["low"] else 0)
    carried = F.broadcast(rows.sparkSession.createDataFrame(carries, "part long, low string, carry long"))
    whole = F.col("place") + F.when(F.col("grp") == F.col("low"), F.col("carry")).otherwise(0)
    return laid.join(carried, "part").select(
        *rows.columns, F.floor(whole / size).cast("long").alias("block"), (whole % size).cast("int").alias("at")
    )


def _blocks(leaves: DataFrame, members: list[str], height: int) -> DataFrame:
    """(grp, block, n, nodes, members): a row a block of leaves (grp, block, at, digest, members...)."""
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in leaves.schema.fields if f.name in members]
    ddl = "grp string, block long, n int, nodes binary" + (f", members array<struct<{', '.join(k.replace(' ', ':', 1) for k in kinds)}>>" if members else "")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block = table["block"][0].as_py()
        leaves = [x.hex().encode() for x in table["digest"].to_pylist()]
        out = {"grp": [table["grp"][0].as_py()], "block": [block], "n": pa.array([len(leaves)], pa.int32()),
               "nodes": pa.array([build_nodes(leaves, levels_of(len(leaves), block > 0, height))], pa.binary())}
        if members:
            columns = [table[m].combine_chunks() for m in members]
            rows = pa.StructArray.from_arrays(columns, names=members)
            out["members"] = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        return pa.table(out)

    return leaves.groupBy("grp", "block").applyInArrow(build, ddl)


def build_manifest(rows: DataFrame, order: list[str], members: list[str], height: int = HEIGHT) -> Manifest:
    """The trees of all groups. rows: grp (string, not null), digest (32 bytes), the columns of
    `order`, by which a group's leaves stand (then by digest), and those of `members`, which the
    leaf blocks keep."""
    size = 1 << FAN_BITS * height
    blocks = stage(_blocks(_numbered(rows, [*order, "digest"], size), members, height), "manifest-blocks")
    stages, roots = [blocks], []
    while True:
        # a group whose first block isn't full has no other; the rest goes on
        roots.append(blocks.filter((F.col("block") == 0) & (F.col("n") < size)).select(
            "grp", F.lit(len(stages) - 1).alias("stage"), F.substring("nodes", 1, 32).alias("subroot")))
        going = blocks.filter((F.col("block") > 0) | (F.col("n") == size))
        if going.isEmpty():
            break
        up = going.select("grp", F.floor(F.col("block") / size).cast("long").alias("block"),
                          (F.col("block") % size).cast("int").alias("at"), F.substring("nodes", 1, 32).alias("digest"))
        blocks = stage(_blocks(up, [], height), "manifest-blocks")
        stages.append(blocks)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Manifest(stages, found, height)


def build_top(manifest: Manifest) -> Manifest:
    """The tree over the groups' roots, in the order of the groups' names (UTF-8 bytes)."""
    rows = manifest.roots.select(F.lit("").alias("grp"), F.col("subroot").alias("digest"), F.col("grp").alias("name"), "stage")
    return build_manifest(rows, ["name"], ["name", "stage"], manifest.height)


# --- proofs ------------------------------------------------------------------------------------

def _handed_down(blocks: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(grp, block, path, subroot, root) of the blocks below, from the paths of these blocks' roots."""

    def hand(table: pa.Table) -> pa.Table:
        out = []
        for r in table.to_pylist():
            runs = runs_of(r["nodes"], r["n"], levels_of(r["n"], r["block"] > 0, height))
            for k in range(r["n"]):
                out.append({"grp": r["grp"], "block": (r["block"] << FAN_BITS * height) + k, "path": pack_path(path_in_block(runs, k)) + r["path"],
                            "subroot": r["subroot"], "root": r["root"]})
        return pa.Table.from_pylist(out, schema=_PATHS)

    return blocks.join(paths, ["grp", "block"]).groupBy("grp", "block").applyInArrow(hand, _PATHS_DDL)


_PATHS_DDL = "grp string, block long, path binary, subroot binary, root binary"
_PATHS = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])


def _leaf_paths(manifest: Manifest, starts: DataFrame) -> DataFrame:
    """Paths (grp, block, path, subroot, root) of the leaf blocks' roots. starts: (grp, stage, path,
    subroot, root) of each group's last block."""
    columns = ["grp", "block", "path", "subroot", "root"]
    first = starts.withColumn("block", F.lit(0).cast("long"))
    paths = None
    for k in range(len(manifest.stages) - 1, -1, -1):
        own = first.filter(F.col("stage") == k).select(*columns)
        paths = own if paths is None else own.unionByName(paths)
        if k:
            paths = stage(_handed_down(manifest.stages[k], paths, manifest.height), "manifest-paths")
    return paths


def group_paths(manifest: Manifest, top: Manifest) -> DataFrame:
    """(grp, stage, path, subroot, root): for each group the path of its root to the table's root."""
    root = top.roots.select("grp", "stage", F.expr("cast('' as binary)").alias("path"), "subroot", F.col("subroot").alias("root"))
    above, height = _leaf_paths(top, root), top.height

    def hand(table: pa.Table) -> pa.Table:
        out = []
        for r in table.to_pylist():
            levels = levels_of(r["n"], r["block"] > 0, height)
            runs = runs_of(r["nodes"], r["n"], levels)
            held = np.frombuffer(r["nodes"], dtype=np.uint8).reshape(-1, 32)[
                addresses(levels - 1, np.arange(r["n"]), r["n"], levels)]
            for k, m in enumerate(r["members"]):
                out.append({"grp": m["name"], "stage": m["stage"], "path": pack_path(path_in_block(runs, k)) + r["path"],
                            "subroot": held[k].tobytes(), "root": r["root"]})
        return pa.Table.from_pylist(out, schema=schema)

    schema = pa.schema([("grp", pa.string()), ("stage", pa.int32()), ("path", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])
    found = top.stages[0].join(above, ["grp", "block"]).groupBy("grp", "block").applyInArrow(
        hand, "grp string, stage int, path binary, subroot binary, root binary")
    return stage(found, "manifest-groups")


def prove(manifest: Manifest, paths: DataFrame, ddl: str) -> DataFrame:
    """A row per leaf: its members (`ddl`), leaf, subroot, root, proof_sha256 (over all siblings from
    the leaf to the root), folded_root (from `altered` where a member of that name isn't null, else
    from the leaf) and verified. paths: as of group_paths."""

    def check(table: pa.Table) -> pa.Table:
        out = []
        for r in table.to_pylist():
            levels = levels_of(r["n"], r["block"] > 0, height)
            runs = runs_of(r["nodes"], r["n"], levels)
            held = np.frombuffer(r["nodes"], dtype=np.uint8).reshape(-1, 32)
            text = held[addresses(levels - 1, np.arange(r["n"]), r["n"], levels)].tobytes().hex().encode()
            above = unpack_path(r["path"])
            subroot, root = r["subroot"].hex(), r["root"].hex()
            shared: dict[int, tuple[Path, bytes]] = {}  # per run of leaves, what all its leaves have above them
            for k, member in enumerate(r["members"]):
                leaf = text[64 * k : 64 * k + 64]
                if k >> FAN_BITS not in shared:
                    path = [*path_in_block(runs, k)[1:], *above]
                    shared[k >> FAN_BITS] = path, b"".join(siblings(*x) for x in path)
                path, upper = shared[k >> FAN_BITS]
                own = path_in_block(runs[:1], k)
                altered = member.pop("altered", None)
                folded = fold(leaf if altered is None else altered.hex().encode(), [*own, *path]).decode()
                lower = siblings(*own[0]) if own else b""
                out.append({**member, "leaf": leaf.decode(), "subroot": subroot, "root": root,
                            "proof_sha256": hashlib.sha256(lower + upper).hexdigest(), "folded_root": folded, "verified": folded == root})
        return pa.Table.from_pylist(out, schema=schema)

    height = manifest.height
    full = f"{ddl}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema = to_arrow_schema(StructType.fromDDL(full))
    blocks = manifest.stages[0].join(_leaf_paths(manifest, paths), ["grp", "block"])
    return blocks.groupBy("grp", "block").applyInArrow(check, full)


def group_name(value: Column) -> Column:
    """A name that isn't null and keeps the order of values, null first."""
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value.cast("string")))


def prove_documents(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row per row of `docs` (doc_id, source, lang, n_chars, text; others take no part) with its
    leaf, its source's root, the table's root, the digest of its proof and the check of a copy in
    which every fifth document (by the crc32 of its doc_id) has its text's A-Z lower-cased.

    Null values count as `-`. Rows without a doc_id stand first in their source and aren't
    tampered with; rows that share a doc_id stand by their digests, and equal rows are leaves of
    their own. Null texts stay null when tampered with. An empty table gives an empty table. Texts
    are hashed whole, whatever their length, and go no further than the leaf. `height` is that of a
    block: 16 ** height leaves are built in one group.
    """
    text = F.col("text")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    rows = docs.select(
        group_name(F.col("source")).alias("grp"), "doc_id", leaf_digest(*others, text).alias("digest"),
        F.when(chosen, leaf_digest(*others, F.translate(text, _UPPER, _LOWER))).alias("altered"),
    )
    rows = stage(rows, "manifest-leaves")
    kind = rows.schema["doc_id"].dataType.simpleString()
    manifest = build_manifest(rows, ["doc_id"], ["doc_id", "altered"], height)
    return prove(manifest, group_paths(manifest, build_top(manifest)), f"doc_id {kind}")
