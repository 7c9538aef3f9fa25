"""Shards of nearly equal bytes: minimax contiguous partition of ordered groups of equal texts.

Groups stand in the order of a hash of their text. The smallest capacity for which the groups fit into the shards,
filled one after the other, is found by binary search; a capacity is checked by going greedily through running sums.

The driver sees the order only as sums over cells of hash values: `CELLS` at first, and a cell is split further only
where a cut of the capacity that is found, or of the one just below it, falls inside it. So it holds some hundred
thousand numbers at most, whatever the table, and the answer is that of the groups themselves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import stage

#: Groups are ordered by so many bits of the hash; texts alike in them stay together.
BITS = 60
STEP_BITS = 12
CELLS = 1 << STEP_BITS


class Order:
    """Running sums over cells of ordered groups; `split(cells)` gives the sums inside cells."""

    def __init__(self, split):
        self._split = split
        self.start, self.width, self.weight, self.groups = (np.empty(0, np.int64) for _ in range(4))
        self._put(np.zeros(1, np.int64), np.full(1, BITS, np.int64))

    def _put(self, start: np.ndarray, width: np.ndarray) -> None:
        """Replace cells (first hash, bits of width) by the cells inside them that hold groups."""
        gone = np.isin(self.start, start)
        new_start, new_width, weight, groups = self._split(start, width)
        for name, new in (("start", new_start), ("width", new_width), ("weight", weight), ("groups", groups)):
            setattr(self, name, np.concatenate([getattr(self, name)[~gone], new]))
        by = np.argsort(self.start)
        for name in ("start", "width", "weight", "groups"):
            setattr(self, name, getattr(self, name)[by])
        self.ends = np.concatenate([[0], np.cumsum(self.weight)])
        self.inside: set[int] = set()

    def floor(self, value: int) -> int:
        """Index of the last known boundary at or below `value`; notes the cell that `value` falls into."""
        at = int(np.searchsorted(self.ends, value, "right")) - 1
        self._note(at, value)
        return at

    def ceil(self, value: int) -> int:
        at = int(np.searchsorted(self.ends, value, "left"))
        self._note(at - 1, value)
        return at

    def _note(self, cell: int, value: int) -> None:
        if 0 <= cell < len(self.weight) and self.ends[cell] < value < self.ends[cell + 1] and self.groups[cell] > 1:
            self.inside.add(cell)

    def refine(self) -> bool:
        """Split the noted cells; false if none was noted."""
        cells = np.array(sorted(c for c in self.inside if self.width[c] > 0), np.int64)
        self.inside = set()
        if len(cells):
            self._put(self.start[cells], self.width[cells])
        return len(cells) > 0


def fits(order: Order, capacity: int, shards: int) -> bool:
    """Whether greedy filling needs at most `shards` shards."""
    at = 0
    for _ in range(shards):
        at = order.floor(int(order.ends[at]) + capacity)
        if at == len(order.weight):
            return True
    return False


def smallest_capacity(order: Order, shards: int) -> int:
    total = int(order.ends[-1])
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(order, middle, shards) else (middle + 1, high)
    return low


def cut_places(order: Order, capacity: int, shards: int) -> list[int]:
    """First cell of shards 1 and up: as even as the capacity allows, each shard within it."""
    total, latest = int(order.ends[-1]), [len(order.weight)]
    for _ in range(shards - 1):
        latest.append(order.ceil(max(int(order.ends[latest[-1]]) - capacity, 0)))
    cuts, at = [], 0
    for shard, least in zip(range(1, shards), reversed(latest[1:]), strict=True):
        even = order.floor(total * shard // shards)
        at = min(max(at, least, even), order.floor(int(order.ends[at]) + capacity))
        cuts.append(at)
    return cuts


def find_cuts(order: Order, shards: int) -> tuple[int, list[int]]:
    """(capacity, first hash of shards 1 and up), refined until exact."""
    while True:
        capacity = smallest_capacity(order, shards)
        order.inside = set()
        # Only what proves this capacity, and that none below will do, has to be exact.
        fits(order, capacity, shards)
        if capacity > 1:
            fits(order, capacity - 1, shards)
        cuts = cut_places(order, capacity, shards)
        if not order.refine():
            starts = np.append(order.start, 1 << BITS)
            return capacity, [int(starts[c]) for c in cuts]


def _splitter(groups: DataFrame):
    def split(start: np.ndarray, width: np.ndarray):
        inner = np.maximum(width - STEP_BITS, 0)
        wanted = groups
        if len(start) > 1 or width[0] < BITS:
            inside = [F.col("h").between(int(s), int(s + (1 << int(w)) - 1)) for s, w in zip(start, width, strict=True)]
            any_ = inside[0]
            for x in inside[1:]:
                any_ = any_ | x
            wanted = groups.where(any_)
            bits = F.lit(None).cast("int")
            for x, b in zip(inside, inner, strict=True):
                bits = F.when(x, int(b)).otherwise(bits)
        else:
            bits = F.lit(int(inner[0]))
        cell = F.expr("shiftleft(shiftright(h, b), b)")
        sums = wanted.withColumn("b", bits).groupBy(cell.alias("start"), "b").agg(
            F.sum("weight").alias("weight"), F.count("*").alias("groups")
        )
        found = sums.toArrow()
        return tuple(found.column(c).to_numpy().astype(np.int64) for c in ("start", "b", "weight", "groups"))

    return split


def shard(documents: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, law, shard, slot (gapless from 0), grown_shard (null by this law).

    Equal texts are in the same shard, null and empty ones too. Repeated rows and rows without doc_id are rows of their
    own; other columns are ignored. A text that alone is larger than an even share makes its shard larger. With fewer
    groups than shards some stay empty. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint").alias("h"),
        # The number of a row is fixed once the table is written.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "sizes")
    groups = stage(rows.groupBy("h").agg(F.sum("size").alias("weight")), "groups")
    _, cuts = find_cuts(Order(_splitter(groups)), shards)
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.col("h") >= cut, 1).otherwise(0)
    # Slots count within the part of a shard that one input task wrote, then over the parts.
    placed = rows.select("doc_id", "size", "text_crc32", "row", number.alias("shard"), F.shiftright("row", 33).alias("part"))
    parts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return placed.withColumn("within", within).join(parts, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("within")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
