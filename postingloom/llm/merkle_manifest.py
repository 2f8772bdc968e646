"""Merkle manifest of a dataset: a hash tree per source under one root, stored in van Emde Boas order.

A tree is cut into blocks: aligned subtrees of ``BLOCK_HEIGHT`` levels of runs. The digests of a block lie in one
binary value at the addresses of the van Emde Boas layout, whose halves are subtrees again. Blocks are built from
their leaves; their roots are the leaves of the blocks above, until each tree has one block left. Sources' roots are
the leaves of one more such tree. No task holds more than the leaves and nodes of a block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import placed_in_order, shipped, stored

#: Nodes of a run, and runs from a block's leaves up to its root. Three make four levels of nodes, which halve evenly.
FAN, BLOCK_HEIGHT = 16, 3
BLOCK = FAN**BLOCK_HEIGHT
DIGEST, HEX = 32, 64


# ---- layout ---------------------------------------------------------------

def n_nodes(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


@lru_cache(maxsize=None)
def addresses(levels: int) -> list[np.ndarray]:
    """The van Emde Boas address of every node of a full tree, by depth from the root.

    The upper half of the levels comes first, then the subtrees of the lower half from left to right, each in the
    same order; so a path touches few stretches whatever the size of a page or cache line."""
    if levels == 1:
        return [np.zeros(1, np.int64)]
    upper = levels // 2
    lower = levels - upper
    below = n_nodes(upper) + n_nodes(lower) * np.arange(FAN**upper)
    return addresses(upper) + [(below[:, None] + place).ravel() for place in addresses(lower)]


def height_of(n_leaves: int) -> int:
    height = 0
    while FAN**height < n_leaves:
        height += 1
    return height


def widths(n_leaves: int, height: int) -> list[int]:
    """Nodes in use, from the leaves up."""
    found = [n_leaves]
    for _ in range(height):
        found.append(-(-found[-1] // FAN))
    return found


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def build_block(leaves: list[str], height: int) -> tuple[str, bytes]:
    """Root and stored nodes of a block; places after the last node in use are cut off."""
    place = addresses(height + 1)
    levels = ["".join(leaves)]
    for _ in range(height):
        below = levels[-1]
        levels.append("".join(hashed(below[at : at + HEX * FAN]) for at in range(0, len(below), HEX * FAN)))
    used = [place[height - k][: len(level) // HEX] for k, level in enumerate(levels)]
    nodes = np.zeros((1 + max(int(at.max()) for at in used), DIGEST), np.uint8)
    for at, level in zip(used, levels, strict=True):
        nodes[at] = np.frombuffer(bytes.fromhex(level), np.uint8).reshape(-1, DIGEST)
    return levels[-1], nodes.tobytes()


def stored_levels(nodes: bytes, n_leaves: int, height: int) -> list[str]:
    """The digests of each level below the root, fetched from their addresses, from the leaves up."""
    rows = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    place = addresses(height + 1)
    return [
        rows[place[height - k][:width]].tobytes().hex() for k, width in enumerate(widths(n_leaves, height)[:height])
    ]


def siblings(levels: list[str], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of a leaf's path within its runs, from the leaf up."""
    path = []
    for level in levels:
        run = level[slot // FAN * FAN * HEX : (slot // FAN + 1) * FAN * HEX]
        own = slot % FAN * HEX
        path.append((run[:own], run[own + HEX :]))
        slot //= FAN
    return path


# ---- blocks as groups of rows ---------------------------------------------

_BLOCKS = "owner string, block bigint, n bigint, n_leaves int, height int, root string, nodes binary"
_PATH = "array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _built(leaves: pa.Table) -> pa.Table:
    leaves = leaves.sort_by("slot")
    n = leaves["n"][0].as_py()
    height = BLOCK_HEIGHT if n > BLOCK else height_of(n)
    root, nodes = build_block(leaves["digest"].to_pylist(), height)
    return pa.table({
        "owner": leaves["owner"][:1],
        "block": leaves["block"][:1],
        "n": leaves["n"][:1],
        "n_leaves": pa.array([len(leaves)], pa.int32()),
        "height": pa.array([height], pa.int32()),
        "root": [root],
        "nodes": pa.array([nodes], pa.binary()),
    })


def _opened(block: pa.Table) -> pa.Table:
    """The path above each leaf of a block: its siblings in the block, then those above the block."""
    row = block.to_pylist()[0]
    levels = stored_levels(row["nodes"], row["n_leaves"], row["height"])
    above = [(step["left"], step["right"]) for step in row["above"]]
    paths = [siblings(levels, slot) + above for slot in range(row["n_leaves"])]
    return pa.table({
        "owner": pa.array([row["owner"]] * len(paths), pa.string()),
        "place": pa.array([row["block"] * BLOCK + slot for slot in range(len(paths))], pa.int64()),
        "above": pa.array([[{"left": left, "right": right} for left, right in path] for path in paths], _PATH_TYPE),
    })


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = hashed(left + digest + right)
    return digest


_PROOFS = "key {key}, leaf string, owner string, proof_sha256 string, folded_root string"


def _proved(leaves: pa.Table, block: pa.Table) -> pa.Table:
    row = block.to_pylist()[0]
    levels = stored_levels(row["nodes"], row["n_leaves"], row["height"])
    above = [(step["left"], step["right"]) for step in row["above"]]
    beyond = "".join(left + right for left, right in above).encode()
    ends: dict[str, str] = {}
    proofs, roots = [], []
    for slot, shown in zip(leaves["slot"].to_pylist(), leaves["shown"].to_pylist(), strict=True):
        path = siblings(levels, slot)
        proof = sha256("".join(left + right for left, right in path).encode())
        proof.update(beyond)
        proofs.append(proof.hexdigest())
        top = fold(shown, path)
        if top not in ends:
            ends[top] = fold(top, above)
        roots.append(ends[top])
    return pa.table({
        "key": leaves["key"],
        "leaf": leaves["digest"],
        "owner": leaves["owner"],
        "proof_sha256": pa.array(proofs, pa.string()),
        "folded_root": pa.array(roots, pa.string()),
    })


# ---- trees ----------------------------------------------------------------

def _blocked(leaves: DataFrame) -> DataFrame:
    return leaves.withColumns({
        "block": F.floor(F.col("place") / BLOCK).cast("long"), "slot": (F.col("place") % BLOCK).cast("int")
    })


def _grown(leaves: DataFrame, purpose: str) -> list[DataFrame]:
    """The blocks over leaves (owner, place, n, digest): those on the leaves first, then those on their roots."""
    stages = []
    while True:
        groups = _blocked(leaves).select("owner", "block", "slot", "n", "digest").groupBy("owner", "block")
        stages.append(stored(groups.applyInArrow(_built, _BLOCKS), f"manifest-{purpose}-{len(stages)}"))
        above = stages[-1].where(F.col("n") > BLOCK)
        if above.isEmpty():
            return stages
        leaves = above.select(
            "owner", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("digest")
        )


def _tops(stages: list[DataFrame]) -> DataFrame:
    """(owner, root) of every tree: the root of its only block in the last stage that it reaches."""
    found = [stage.where(F.col("n") <= BLOCK).select("owner", "root") for stage in stages]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _with_paths(stages: list[DataFrame], above_tops: DataFrame, purpose: str) -> DataFrame:
    """The lowest blocks with ``above``, the path from their root on; ``above_tops`` (owner, above) goes on from the trees' roots."""
    paths = None
    for k, stage in reversed(list(enumerate(stages))):
        tops = stage.where(F.col("n") <= BLOCK).join(above_tops, "owner")
        if paths is None:
            known = tops
        else:
            own = stage.where(F.col("n") > BLOCK).join(paths.withColumnRenamed("place", "block"), ["owner", "block"])
            known = own.unionByName(tops.select(*own.columns))
        if k == 0:
            return known
        paths = stored(
            known.groupBy("owner", "block").applyInArrow(_opened, f"owner string, place bigint, above {_PATH}"),
            f"manifest-{purpose}-paths-{k}",
        )
    raise AssertionError("a forest has at least one stage")


@dataclass(frozen=True)
class Manifest:
    """Stored tables of a manifest.

    leaves (owner, place, n, key, digest, shown); trees and top are lists of block tables (owner, block, n, n_leaves,
    height, root, nodes), lowest first; subroots (owner, place, n, digest). owner is ``-`` for rows without a
    source, else ``=`` and the source."""

    leaves: DataFrame
    trees: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]

    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        return _tops(self.top).select("root")

    def proofs(self) -> DataFrame:
        """(key, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of the table.

        proof_sha256 is over the siblings on the way from the leaf to the root; folded_root is what the leaf of the row
        as shown gives with these siblings, and verified whether that is the root."""
        nothing = F.array().cast(_PATH).alias("above")
        top = _with_paths(self.top, _tops(self.top).select("owner", nothing), "top")
        ways = stored(
            top.groupBy("owner", "block").applyInArrow(_opened, f"owner string, place bigint, above {_PATH}"), "manifest-top-paths"
        )
        of_source = self.subroots.select(F.col("owner").alias("of"), F.col("place").alias("at"))
        above = ways.join(of_source, F.col("place") == F.col("at")).select(F.col("of").alias("owner"), "above")
        lowest = stored(_with_paths(self.trees, above, "trees"), "manifest-ways")
        key = self.leaves.schema["key"].dataType.simpleString()
        proved = (
            _blocked(self.leaves)
            .select("owner", "block", "slot", "key", "digest", "shown")
            .groupBy("owner", "block")
            .cogroup(lowest.groupBy("owner", "block"))
            .applyInArrow(_proved, _PROOFS.format(key=key))
        )
        subroots = self.subroots.select(F.col("owner").alias("of"), F.col("digest").alias("subroot"))
        return (
            proved.join(subroots, F.col("owner") == F.col("of"))
            .withColumn("root", self.root().scalar())
            .select(
                "key", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                (F.col("folded_root") == F.col("root")).alias("verified"),
            )
        )


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of a row: of each field ``-`` if it is null, else its bytes counted, ``:`` and itself as text."""
    spelled = []
    for field in fields:
        text = field.cast("string")
        spelled.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*spelled), 256)


def manifest(
    rows: DataFrame, fields: list[str], source: str, key: str, held: dict[str, Column] | None = None
) -> Manifest:
    """The hash trees over all rows, a tree per ``source`` in order of ``key`` (any type that sorts), one tree over their roots.

    A leaf is the hash of ``fields``. ``held`` replaces fields by what a copy of the rows shows instead; proofs
    check the copy's leaves. Rows without a key come first in their source; rows of equal key are ordered by
    their hash, and equal ones hold a leaf each. Rows without a source form a source of their own, the first. Null fields are
    told from empty ones. Texts of any length are hashed where they are read and not shuffled. Only ``fields``, ``source``
    and ``key`` are read, so further columns may have any name. No rows give no leaves, no root and no proofs."""
    shown = [(held or {}).get(field, F.col(field)) for field in fields]
    owner = F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    read = stored(
        rows.select(
            owner.alias("owner"),
            F.col(key).alias("key"),
            leaf_hash([F.col(field) for field in fields]).alias("digest"),
            leaf_hash(shown).alias("shown"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "manifest-leaves",
    )
    # The row breaks ties between equal rows, so that these, however many, are spread over partitions too.
    leaves = stored(placed_in_order(read, "owner", ["key", "digest", "row"], "manifest-leaves-order").drop("row"), "manifest-placed")
    trees = _grown(leaves, "trees")
    roots = _tops(trees).select(F.lit("").alias("owner"), F.col("owner").alias("name"), F.col("root").alias("digest"))
    placed = stored(placed_in_order(roots, "owner", ["name"], "manifest-sources-order"), "manifest-sources")
    top = _grown(placed, "top")
    return Manifest(leaves, trees, placed.select(F.col("name").alias("owner"), "place", "n", "digest"), top)


shipped(__name__)
