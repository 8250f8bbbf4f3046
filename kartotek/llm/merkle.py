"""A Merkle tree over a dataset, and octopus multiproofs of its rows.

Rows are leaves, in order of their id in one tree for each group; the group roots, in order of the
group, are the leaves of the top tree. Every FAN consecutive nodes become one node a level up (the
last run may be shorter, even one node), until one is left.

Building: rows are placed by a range sort of (group, id) and the counts of its partitions, so a group
with a third of all rows spreads over many tasks. Blocks of FAN^DEPTH nodes are folded by DEPTH levels
at once; the block roots are the next, FAN^DEPTH times smaller, table.

Proving: the leaves asked for are taken in partitions of PART positions. Each partition works out the
least set of nodes that its leaves need and cannot derive from each other (the octopus), all of these
are fetched in one join, and the partition derives the shared interior nodes and writes down the proof
of each leaf. Nodes high up, which many partitions fetch, are dealt out in copies, one for
each READERS partitions. Top paths are proved once for each group and then handed to its partitions.

A proof is an array of (left, right) from the leaf to the root: the digests of the run's other nodes
before and after, joined; both are empty where the run has one node. ``fold`` and ``proof_digest`` are
column expressions over it.

Defined results: null group: a group of its own, the first; null ids come first in their group; rows
that repeat an id are leaves of their own, in the order of their digests; equal rows are equal leaves, one
behind the other; an empty table has no root; a single row is its own root, with an empty proof;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from kartotek.llm.store import written

#: Nodes of a run; levels folded at once; positions of a leaf partition; partitions that read one copy of a node.
FAN, DEPTH, PART, READERS = 3, 6, 3 ** 7, 1000


# --- digests as columns -----------------------------------------------------------------------

def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# --- nodes of one tree ------------------------------------------------------------------------

def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def widths(n: int) -> list[int]:
    """Nodes on each level of a tree of n leaves, leaves first."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def parents(nodes: dict[int, str], width: int) -> dict[int, str]:
    """Nodes a level up whose whole run is known."""
    out = {}
    for run in sorted({i // FAN for i in nodes}):
        members = range(run * FAN, min(run * FAN + FAN, width))
        if all(i in nodes for i in members):
            out[run] = hashlib.sha256("".join(nodes[i] for i in members).encode()).hexdigest()
    return out


def missing(positions: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The octopus: (level, index) of the nodes that the leaves at ``positions`` need and do not give."""
    known, out = set(positions), []
    for level, width in enumerate(widths(n)[:-1]):
        runs = {i // FAN for i in known}
        out += [(level, i) for r in sorted(runs) for i in range(r * FAN, min(r * FAN + FAN, width)) if i not in known]
        known = runs
    return out


def interiors(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """Known nodes of every level, derived from leaves and fetched nodes."""
    levels = []
    known = dict(leaves)
    for level, width in enumerate(widths(n)):
        known |= {i: d for (at, i), d in fetched.items() if at == level}
        levels.append(known)
        known = parents(known, width)
    return levels


def steps(position: int, levels: list[dict[int, str]], wide: list[int]) -> Iterator[tuple[str, str]]:
    """The proof of one leaf, as (left, right) of each level."""
    for known, width in zip(levels, wide[:-1], strict=False):
        start = position // FAN * FAN
        yield ("".join(known[i] for i in range(start, position)),
               "".join(known[i] for i in range(position + 1, min(start + FAN, width))))
        position //= FAN


# --- places -----------------------------------------------------------------------------------

def placed(rows: DataFrame, group: list[str], order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pos``, zero-based in their group; group columns with ``n``). No group is gathered."""
    # One partition and the running number in it: the high and low bits of the monotonic id.
    stored = written(
        rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*group, *order]])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in [*group, *order]])
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), label)
    runs = stored.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    everything = Window.partitionBy(*(group or [F.lit(0)]))
    before = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sizes = runs.groupBy(*group).agg(F.sum("_n").alias("n"))
    here, there = stored.alias("a"), runs.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for c in group:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = here.join(there, same).select(
        *[F.col(f"a.{c}") for c in rows.columns], (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"))
    return joined, sizes


# --- trees ------------------------------------------------------------------------------------

_NODE = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()),
                   ("digest", pa.string()), ("last", pa.bool_())])


def _fold_blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Nodes of the next DEPTH levels over those of level ``base`` (tree, n: leaves of the tree, idx, digest)."""

    def up(block: pa.Table) -> pa.Table:
        tree, n = block.column("tree")[0].as_py(), block.column("n")[0].as_py()
        wide = widths(n)
        known = dict(zip(block.column("idx").to_pylist(), block.column("digest").to_pylist(), strict=True))
        out = []
        for level in range(base, min(base + DEPTH, len(wide) - 1)):
            known = parents(known, wide[level])
            out += [(tree, n, level + 1, i, d, level + 2 == len(wide)) for i, d in known.items()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _NODE, strict=True)], _NODE)

    block = F.floor(F.col("idx") / FAN ** DEPTH).alias("block")
    return nodes.select("tree", "n", "idx", "digest", block).groupBy("tree", "block").applyInArrow(
        up, "tree long, n long, level int, idx long, digest string, last boolean")


def grown(leaves: DataFrame, most: int) -> DataFrame:
    """All nodes of the trees over leaves (tree, n, pos, digest); ``most``: the largest n. ``last``
    marks the one that is left of each tree."""
    nodes = leaves.select("tree", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest", (F.col("n") == 1).alias("last"))
    layer = nodes
    for base in range(0, height(most), DEPTH):
        added = written(_fold_blocks(layer.where("NOT last"), base), "nodes")
        layer = added.where(F.col("level") == base + DEPTH)
        nodes = nodes.unionByName(added)
    return nodes


@dataclass
class Manifest:
    """``leaves``: the rows given, with tree (place of the group), n (leaves of the tree) and pos;
    ``nodes``: all nodes of the trees; ``groups``: grp, tree, n, subroot; ``top``: nodes of the tree
    over ``n_groups`` subroots; ``root``: null for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    top: DataFrame
    n_groups: int
    most: int
    root: str | None


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows (grp, id, digest and columns to keep)."""
    clash = {"tree", "n", "pos", "part", "proof", "subroot"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns of the manifest's own: {sorted(clash)}")
    digests = written(rows, "digests")  # or else the range sort would make them twice
    rows, sizes = placed(digests, ["grp"], ["id", "digest"], "rows")
    groups = written(placed(sizes, [], ["grp"], "groups")[0].withColumnRenamed("pos", "tree"), "trees")
    facts = groups.agg(F.count("*").alias("k"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    k, most = facts["k"], facts["most"]
    leaves = written(
        rows.join(groups.withColumnRenamed("grp", "_grp"), F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp"), "leaves")
    nodes = grown(leaves, most)
    subroots = nodes.where("last").select("tree", F.col("digest").alias("subroot"))
    groups = written(groups.join(subroots, "tree"), "subroots")
    top = grown(_as_leaves(groups, k), k)
    root = top.where("last").first()
    return Manifest(leaves, nodes, groups, top, k, most, root["digest"] if root else None)


def _as_leaves(groups: DataFrame, k: int) -> DataFrame:
    return groups.select(F.lit(0).cast("long").alias("tree"), F.lit(k).cast("long").alias("n"), F.col("tree").alias("pos"),
                         F.col("subroot").alias("digest"))


# --- proofs -----------------------------------------------------------------------------------

_PROOF = ArrayType(StructType().add("left", "string").add("right", "string"))
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def _needs(wanted: DataFrame) -> DataFrame:
    """tree, part, level, idx of the nodes that each partition fetches."""

    def octopus(part: pa.Table) -> pa.Table:
        tree, number, n = (part.column(c)[0].as_py() for c in ("tree", "part", "n"))
        found = missing(part.column("pos").to_pylist(), n)
        return pa.table({"tree": pa.array([tree] * len(found), pa.int64()), "part": pa.array([number] * len(found), pa.int64()),
                         "level": pa.array([at for at, _ in found], pa.int32()), "idx": pa.array([i for _, i in found], pa.int64())})

    return wanted.select("tree", "part", "n", "pos").groupBy("tree", "part").applyInArrow(
        octopus, "tree long, part long, level int, idx long")


def _fetched(needs: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """The needed nodes with their digests: one join; nodes that many partitions need stand in copies."""
    copies = F.element_at(F.array(*[F.lit(max(1, FAN ** at // (PART * READERS))) for at in range(height(most) + 1)]), F.col("level") + 1)
    needs = written(needs, "needs")
    low = needs.agg(F.min("level")).first()[0]
    if low is None:
        return needs.withColumn("node", F.lit(None).cast("string"))
    asked = needs.withColumn("copy", F.pmod("part", copies).cast("int"))
    given = nodes.where(F.col("level") >= low).select(
        "tree", "level", "idx", F.col("digest").alias("node"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    return asked.join(given, ["tree", "level", "idx", "copy"]).select("tree", "part", "level", "idx", "node")


def _proofs(wanted: DataFrame, nodes: DataFrame, most: int, heads: DataFrame | None = None) -> DataFrame:
    """``wanted`` (tree, n, pos, digest, columns to keep) with ``proof``, and with ``heads`` (tree,
    subroot, head) also ``subroot``, the head being the end of each proof of the tree."""
    wanted = wanted.withColumn("part", F.floor(F.col("pos") / PART))
    help_ = _fetched(_needs(wanted), nodes, most).withColumns({"subroot": F.lit(None).cast("string"), "head": F.lit(None).cast(_PROOF)})
    if heads is not None:
        parts = wanted.select("tree", "part").distinct().join(heads, "tree")
        help_ = help_.unionByName(parts.select("tree", "part", "subroot", "head"), allowMissingColumns=True)

    def expand(leaves: pa.Table, given: pa.Table) -> pa.Table:
        n = leaves.column("n")[0].as_py()
        fetched, subroot, head = {}, None, []
        for row in given.select(["level", "idx", "node", "subroot", "head"]).to_pylist():
            if row["level"] is None:
                subroot, head = row["subroot"], [(s["left"], s["right"]) for s in row["head"]]
            else:
                fetched[row["level"], row["idx"]] = row["node"]
        at, wide = leaves.column("pos").to_pylist(), widths(n)
        levels = interiors(dict(zip(at, leaves.column("digest").to_pylist(), strict=True)), fetched, n)
        flat = [step for p in at for step in (*steps(p, levels, wide), *head)]
        ends = pa.array([i * (len(wide) - 1 + len(head)) for i in range(len(at) + 1)], pa.int32())
        sides = pa.StructArray.from_arrays(
            [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], fields=list(_STEP))
        return leaves.drop_columns(["part"]).append_column("proof", pa.ListArray.from_arrays(ends, sides)).append_column(
            "subroot", pa.array([subroot] * len(at), pa.string()))

    schema = wanted.drop("part").schema.add("proof", _PROOF).add("subroot", "string")
    return wanted.groupBy("tree", "part").cogroup(help_.groupBy("tree", "part")).applyInArrow(expand, schema)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``wanted``, by default all of ``manifest.leaves``, with ``subroot`` and ``proof`` (to the root)."""
    wanted = manifest.leaves if wanted is None else wanted
    heads = _proofs(_as_leaves(manifest.groups, manifest.n_groups), manifest.top, manifest.n_groups)
    heads = written(heads.select(F.col("pos").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("head")), "heads")
    return _proofs(wanted, manifest.nodes, manifest.most, heads)
