"""Fixity audit of replicated WARC archives with Merkle trees over offset ranges.

An archive is a table of records with their offsets. Every record is hashed together with its number and place; the records that
start in one range of offsets make a leaf, and `FANOUT` neighbouring ranges a node of the next level, up to one root. The
roots of two replicas are compared, and only below nodes that differ are children read; the records of the ranges that
are left tell what is altered, missing, added or moved.

A node is made by sums, whatever the number of records in its range, so records that share a place cannot fill a task.
The tree has as many levels as the archive's length in bytes needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hourgrid.llm.common import fresh, stage

FANOUT = 16
_BITS = FANOUT.bit_length() - 1
#: Bits of the offsets in a leaf: 64 KB, some dozen pages.
LEAF_BITS = 16
DATE = "1970-01-01T00:00:00Z"


def record(number: Column, url: Column, payload: Column, date: str = DATE) -> Column:
    """A WARC resource record, as bytes. Null url and payload are written as empty."""
    body = F.coalesce(payload.cast("binary"), F.lit("").cast("binary"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(number.cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(number, record) of every row of `pages` (page_id, url, html)."""
    parts = F.col("page_id"), F.col("url"), F.col("html")
    return pages.select(F.col("page_id").cast("bigint").alias("number"), record(*parts, date).alias("record"))


def hashed(written: DataFrame) -> DataFrame:
    """(number, bytes, digest) of records (number, record)."""
    return written.select("number", F.octet_length("record").cast("bigint").alias("bytes"), F.sha2("record", 256).alias("digest"))


def laid_out(rows: DataFrame) -> DataFrame:
    """`rows` (number, bytes, digest, ...) one after the other in order of number, with `offset`; those without number last.

    Rows are sorted in ranges; each task adds up its own, and only one sum a task comes to the driver.
    """
    part, local = fresh(rows, "part", "local")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = at + np.cumsum(batch.column("bytes").to_numpy())
            starts = np.concatenate([[at], ends[:-1]]) if len(ends) else ends
            at = int(ends[-1]) if len(ends) else at
            batch = batch.append_column(part, pa.array(np.full(len(ends), task, np.int64)))
            yield batch.append_column(local, pa.array(starts.astype(np.int64)))

    order = [F.col("number").isNull(), F.col("number"), F.col("digest")]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*rows.schema, StructField(part, LongType()), StructField(local, LongType())])
    placed = stage(sorted_.mapInArrow(added, schema), "placed")
    sums = placed.groupBy(part).agg(F.sum("bytes").alias("size")).orderBy(part).collect()
    starts, at = [], 0
    for r in sums:
        starts.append((r[part], at))
        at += r["size"]
    if not starts:
        return placed.withColumn("offset", F.col(local)).drop(part, local)
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, f"{part} bigint, {local}0 bigint"))
    moved = placed.join(table, part).withColumn("offset", F.col(local) + F.col(f"{local}0"))
    return moved.select(*rows.columns, "offset")


def _ranged(archive: DataFrame) -> DataFrame:
    """With the leaf of each record; records without an offset share one beside the others."""
    return archive.select(
        "number", "offset", "bytes", "digest",
        F.col("offset").isNull().alias("unplaced"), F.coalesce(F.shiftright("offset", LEAF_BITS), F.lit(0)).alias("node"),
    )


def _sum_digest(*parts: str) -> list[Column]:
    """Two halves of a hash as sums, which do not depend on the order of records."""
    whole = F.sha2(F.to_json(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in parts))), 256)
    return [
        F.sum(F.conv(F.substring(whole, s, 15), 16, 10).cast("decimal(38,0)")).alias(f"h{i}") for i, s in enumerate((1, 16))
    ]


def _leaves(archive: DataFrame) -> DataFrame:
    grouped = _ranged(archive).groupBy("unplaced", "node").agg(
        F.count("*").alias("records"), F.sum("bytes").alias("bytes"), *_sum_digest("number", "offset", "bytes", "digest")
    )
    named = F.sha2(F.concat_ws("|", "records", "bytes", "h0", "h1"), 256)
    return grouped.select("unplaced", "node", "records", "bytes", named.alias("digest"))


def _parents(level: DataFrame) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("node", "records", "bytes", "digest")))
    grouped = level.groupBy("unplaced", F.shiftright("node", _BITS).alias("parent")).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), children.alias("children")
    )
    return grouped.select(
        "unplaced", F.col("parent").alias("node"), "records", "bytes", F.sha2(F.to_json("children"), 256).alias("digest")
    )


def height(*archives: DataFrame) -> int:
    """Levels above the leaves until every offset falls into node 0."""
    largest = max((a.agg(F.max("offset")).first()[0] or 0 for a in archives), default=0)
    levels = 0
    while largest >> (LEAF_BITS + _BITS * levels):
        levels += 1
    return levels


def merkle_tree(archive: DataFrame, levels: int, label: str = "tree") -> list[DataFrame]:
    """The stored levels of the tree, leaves first: (unplaced, node, records, bytes, digest)."""
    tree = [stage(_leaves(archive), f"{label}-0")]
    for level in range(1, levels + 1):
        tree.append(stage(_parents(tree[-1]), f"{label}-{level}"))
    return tree


def compare(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """(unplaced, node) of the differing leaves of two trees of the same height; a range that one replica lacks differs."""
    branches = None
    for a, b in zip(reversed(first), reversed(second), strict=True):
        sides = []
        for level, name in ((a, "a"), (b, "b")):
            if branches is not None:
                parents = branches.withColumnRenamed("node", "parent")
                level = level.withColumn("parent", F.shiftright("node", _BITS)).join(parents, ["unplaced", "parent"], "left_semi")
            sides.append(level.select("unplaced", "node", F.col("digest").alias(name)))
        both = sides[0].join(sides[1], ["unplaced", "node"], "full")
        branches = stage(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("unplaced", "node"), "branches")
    return branches


def _entries(archive: DataFrame, ranges: DataFrame, side: str) -> DataFrame:
    """Records of the given ranges by number and offset; several that share both are one entry."""
    here = _ranged(archive).join(ranges, ["unplaced", "node"], "left_semi")
    grouped = here.groupBy("number", "offset").agg(
        F.count("*").alias("records"), F.sum("bytes").alias("bytes"), *_sum_digest("bytes", "digest")
    )
    return grouped.select(
        "number", "offset", F.struct("records", "offset", "bytes").alias(side),
        F.concat_ws("|", "records", "bytes", "h0", "h1").alias(f"content_{side}"),
    )


def _alone(both: DataFrame, side: str, other: str) -> DataFrame:
    """Entries of one replica only, numbered among those of the same number and content."""
    order = Window.partitionBy("number", f"content_{side}").orderBy("offset")
    own = both.where(F.col(other).isNull()).select("number", "offset", side, F.col(f"content_{side}"))
    own = own.withColumn("turn", F.row_number().over(order))
    return own.select("number", side, F.col(f"content_{side}").alias("content"), "turn")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Where two replicas (number, offset, bytes, digest) of an archive differ.

    page_id, status (altered, missing or added in the second, moved to another offset), records, offset and bytes of both. Records that
    share number and offset are one entry: it differs unless both replicas hold the same records equally often. An entry
    that is both moved and altered is missing at one place and added at the other. Null numbers and offsets are values
    like others. Equal replicas, two empty ones too, give no rows; against an empty one everything is missing or added.
    """
    levels = height(first, second)
    ranges = compare(merkle_tree(first, levels, "first"), merkle_tree(second, levels, "second"))
    a, b = _entries(first, ranges, "a"), _entries(second, ranges, "b")
    b = b.withColumnsRenamed({"number": "number_b", "offset": "offset_b"})
    same = F.col("number").eqNullSafe(F.col("number_b")) & F.col("offset").eqNullSafe(F.col("offset_b"))
    both = a.join(b, same, "full").select(
        F.when(F.col("a").isNull(), F.col("number_b")).otherwise(F.col("number")).alias("number"),
        F.when(F.col("a").isNull(), F.col("offset_b")).otherwise(F.col("offset")).alias("offset"),
        "a", "b", "content_a", "content_b",
    )
    both = stage(both.where(~F.col("content_a").eqNullSafe(F.col("content_b"))), "differing")
    gone, new = _alone(both, "a", "b"), _alone(both, "b", "a")
    new = new.withColumnsRenamed({c: f"{c}_new" for c in ("number", "content", "turn")})
    pairs = F.col("number").eqNullSafe(F.col("number_new"))
    for c in ("content", "turn"):
        pairs = pairs & (F.col(c) == F.col(f"{c}_new"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "added").otherwise("moved")
    elsewhere = gone.join(new, pairs, "full").select(
        F.when(F.col("a").isNull(), F.col("number_new")).otherwise(F.col("number")).alias("page_id"), status.alias("status"), "a", "b"
    )
    here = both.where("a is not null and b is not null").select(F.col("number").alias("page_id"), F.lit("altered").alias("status"), "a", "b")
    return here.unionByName(elsewhere).select(
        "page_id", "status", *(F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in ("a", "b") for c in ("records", "offset", "bytes"))
    )
