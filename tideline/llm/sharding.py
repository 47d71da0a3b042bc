"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards carries weights.  A row descends it: on
each level every child draws a number from the hash of (doc_id, child), scaled
by its weight, and the smallest draw wins; a child of twice the weight wins
twice as often.  A draw depends on nothing but the row and the child, so a
change of weights moves rows only into or out of the subtrees whose weights
change.  One more shard comes as a region of its own: no other weight changes,
so rows move into it and nowhere else.

Drawing is arithmetic in the row: no shuffle.  Slots number the rows of a
shard from 0.  A first pass writes each row with its number among those of its
task and shard; the counts, a few for each task, then give every task its
offset.  No shard is ever gathered in one task.

Defined results: a null text has no bytes and so size 1; a null id is drawn
like the empty text; equal ids go to the same shard, each row with a slot of
its own; an empty table gives an empty result; input columns named like a
result give way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tideline.llm.frames import free_name, replace, stored
from tideline.plans.tables import table


@dataclass(frozen=True)
class Shard:
    number: int
    weight: float = 1.0


@dataclass(frozen=True)
class Branch:
    """A region or a rack; its weight is that of its shards."""

    name: str
    children: tuple["Branch | Shard", ...]

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children)


def even_tree(shards: int = 8, regions: int = 2, racks: int = 2) -> Branch:
    """Shards of equal weight dealt to racks and regions."""
    cells = [[[Shard(n) for n in range(shards) if n % (regions * racks) == r * racks + k] for k in range(racks)] for r in range(regions)]
    return Branch("root", tuple(
        Branch(f"region{r}", tuple(Branch(f"region{r}/rack{k}", tuple(rack)) for k, rack in enumerate(region) if rack))
        for r, region in enumerate(cells) if any(region)
    ))


def grown(tree: Branch, shard: Shard) -> Branch:
    """The tree with one more shard, in a region of its own so that no other weight changes."""
    name = f"region{len(tree.children)}"
    return Branch(tree.name, (*tree.children, Branch(name, (Branch(f"{name}/rack0", (shard,)),))))


def draw(key: Column, child: Branch | Shard) -> Column:
    """An exponential draw of rate ``weight``: the smallest of several wins in proportion to the weights."""
    name = f"shard{child.number}" if isinstance(child, Shard) else child.name
    # 52 bits, moved off 0 and 1 by half a step.
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 12) + 0.5) / float(1 << 52)
    return -F.log(uniform) / float(child.weight)


def shard_of(key: Column, tree: Branch | Shard) -> Column:
    """The shard that ``key`` descends to."""
    if isinstance(tree, Shard):
        return F.lit(tree.number)
    if len(tree.children) == 1:
        return shard_of(key, tree.children[0])
    draws = [draw(key, c) for c in tree.children]
    least = F.least(*draws)
    chosen = shard_of(key, tree.children[-1])
    for c, d in list(zip(tree.children, draws))[-2::-1]:
        chosen = F.when(d == least, shard_of(key, c)).otherwise(chosen)
    return chosen


#: Rows numbered together.
RUN = 1 << 16


def place(docs: DataFrame, tree: Branch, extra: Shard | None = None) -> DataFrame:
    """The documents with ``size``, ``text_crc32``, ``law``, ``shard`` and, with ``extra``, ``grown_shard``."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return replace(docs, {
        "size": (F.length(text) + 1).cast("long"),
        "text_crc32": F.crc32(text),
        "law": F.lit("key"),
        "shard": shard_of(key, tree).cast("int"),
        "grown_shard": (shard_of(key, grown(tree, extra)) if extra else F.lit(None)).cast("int"),
    })


def with_slots(placed: DataFrame) -> DataFrame:
    """Rows with a ``shard`` and their ``slot`` in it, gapless from 0, in the order of tasks and rows."""
    task, at, run, within, first = (free_name(placed, n) for n in ("_task", "_at", "_run", "_within", "_first"))
    numbered = stored(placed.withColumns({task: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "shards")
    # A task may hold many rows of a shard: they are numbered in runs of bounded length.
    rows = numbered.withColumn(run, F.floor(F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) / RUN))
    before = Window.partitionBy("shard").orderBy(task, run).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", task, run).count().select(
        "shard", task, run, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(first)
    )
    inside = F.row_number().over(Window.partitionBy("shard", task, run).orderBy(at))
    joined = rows.withColumn(within, inside).join(offsets, ["shard", task, run])
    slot = F.col(first) + F.col(within) - 1
    return joined.select(*[F.col(f"`{c}`") for c in placed.columns if c.lower() != "slot"], slot.alias("slot"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = with_slots(place(docs, even_tree(8), Shard(8)).drop("text"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


QUERIES = {"op9_sharding": op9_sharding}
ORACLE: dict[str, str] = {}
