"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import running_before, whole_text
from questmart.session import stage

# A row costs this much beside its text.
ROW_BYTES = 16
SLOT_SLICES = 1_024


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``name`` seeds its draws, so it must never change or be given again."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight


@dataclass(frozen=True)
class ShardTree:
    """Regions of racks of shards. A row descends level by level; at each one the child with the best weighted draw wins.

    A draw is log(u) / weight, u a hash of the row's id and the child's name. It changes only with the child's own weight,
    so a change of weight moves rows only into or out of the subtrees that hold the changed shard. ``grown`` adds a shard
    in a region of its own: no other weight changes at any level, so rows move into the new shard and nowhere else.
    """

    regions: tuple[Node, ...]

    @staticmethod
    def regular(regions: int, racks: int, shards: int) -> "ShardTree":
        number = iter(range(regions * racks * shards))
        return ShardTree(
            tuple(
                Node(f"{r}", tuple(Node(f"{r}/{k}", tuple(Node(f"{r}/{k}/{s}", shard=next(number)) for s in range(shards))) for k in range(racks)))
                for r in range(regions)
            )
        )

    @property
    def count(self) -> int:
        return sum(len(rack.children) for region in self.regions for rack in region.children)

    def grown(self) -> "ShardTree":
        name = f"added-{self.count}"
        shard = Node(f"{name}/0/0", shard=self.count)
        return ShardTree((*self.regions, Node(name, (Node(f"{name}/0", (shard,)),))))

    def with_weight(self, shard: int, weight: float) -> "ShardTree":
        def change(node: Node) -> Node:
            if node.children:
                return replace(node, children=tuple(change(child) for child in node.children))
            return replace(node, own_weight=weight) if node.shard == shard else node

        return ShardTree(tuple(change(region) for region in self.regions))

    def place(self, key: Column) -> Column:
        """The shard of a row; null keys are a key like any other."""
        return _descend(self.regions, key.cast("long"))


def _descend(nodes: tuple[Node, ...], key: Column) -> Column:
    if len(nodes) == 1:
        chosen = nodes[0]
        return _descend(chosen.children, key) if chosen.children else F.lit(chosen.shard)
    draws = F.array(*[F.struct(_draw(key, node).alias("draw"), F.lit(i).alias("child")) for i, node in enumerate(nodes)])
    best = F.array_max(draws)["child"]
    if not nodes[0].children:
        # Shards of a rack: the winner's number is looked up, nothing is below.
        return F.element_at(F.array(*[F.lit(node.shard) for node in nodes]), best + 1)
    below = F.element_at(F.array(F.lit(0)), 1)
    for i, node in reversed(list(enumerate(nodes))):
        below = F.when(best == i, _descend(node.children, key)).otherwise(below)
    return below


def _draw(key: Column, node: Node) -> Column:
    # 53 bits of the hash as a number inside (0, 1).
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 11)
    return F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(node.weight)


def shard_rows(
    docs: DataFrame, tree: ShardTree, grown: ShardTree | None = None, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard: one row per input row.

    Size is the text's bytes plus a fixed cost (null: no text). Slots number the rows of each shard from 0 without gaps, in
    order of a hash of the row, so no shard is ever sorted by one task. Repeated rows get the same shard and neighbouring
    slots; an empty table gives an empty result. Other columns are not read.
    """
    key, raw = F.col(id_column), whole_text(text)
    placed = docs.select(
        key.cast("long").alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        tree.place(key).cast("int").alias("shard"),
        (grown.place(key) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    spread = F.xxhash64("doc_id", "text_crc32", "size")
    placed = stage(placed.withColumn("spread", spread).withColumn("slice", F.pmod("spread", F.lit(SLOT_SLICES)).cast("int")), "shards")
    numbered = running_before(placed.withColumn("one", F.lit(1)), ["shard"], "slice", ["spread", "doc_id", "text_crc32"], "one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, tree: ShardTree, path: str, id_column: str = "doc_id") -> None:
    """The documents in one folder per shard. Large shards are written by several tasks."""
    name = "_shard"
    docs.withColumn(name, tree.place(F.col(id_column))).write.partitionBy(name).parquet(path)
