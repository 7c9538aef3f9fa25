"""How filters interact: what each order of them removes at each step, by recursive enumeration of orders.

`failures` turns a text into a bit mask, one bit for each filter that it fails. Documents are then only counts: one cell
for each part and mask. `audit` extends filter prefixes in a recursive SQL query; each level adds one unused letter,
carries the bits applied so far and emits, for each mask, whether this step removes it, finds it gone already, or is the
only one to remove it. The number of prefixes and masks depends on the filters alone (325 prefixes and 32 masks for five),
so the recursion and its broadcast have a fixed size, and parts come in by one join on the mask.

Texts are read once. Copies are found by the SHA-256 of the text: sums by hash are made before the shuffle, and a document is
compared with the first one of its text by an equality of (hash, doc_id), so a text that a third of all rows share goes
to no single task.

Nulls: a null text is empty, a null part is the empty string; a null doc_id has no labels and is no copy, nor makes
others one. Repeated rows of a doc_id count as rows; those of the smallest doc_id of a text are all first ones. Labels
of a document that come more than once count if any row says 1. An empty table has no parts and gives no rows. Only the
columns named here are read, so others do not matter. Texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import stage

#: The last letter is the one for copies.
LETTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "[#$%&*|]"
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column, min_words: int = 50, distinct_percent: int = 65, capital_percent: int = 5) -> Column:
    """Bits 0 to 3: too few words, too few distinct words, too many capitals, a symbol."""

    def mask(words: Column) -> Column:
        count = F.size(words)
        chars = F.length(text)
        capitals = chars - F.length(F.translate(text, CAPITALS, ""))
        fails = (
            count < min_words,
            F.size(F.array_distinct(words)) * 100 < count * distinct_percent,
            capitals * 100 > chars * capital_percent,
            text.rlike(SYMBOLS),
        )
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))

    split = F.filter(F.split(text, SPACE), lambda word: word != "")
    # One element: the words are split once, whatever reads them.
    return F.transform(F.array(split), mask)[0]


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, those of quality 1 and toxic ones, by source and failed filters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = documents.select(
        "doc_id",
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("copy"),
    )
    read = stage(read, "masks")
    first = read.where("doc_id is not null").groupBy("copy").agg(F.min("doc_id").alias("doc_id"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = (
        read.where("doc_id is not null")
        .join(first.withColumn("is_first", F.lit(True)), ["copy", "doc_id"], "left")
        .join(marks, "doc_id", "left")
        .select(
            "part",
            (F.col("mask") + F.when(F.col("is_first"), 0).otherwise(1 << LETTERS.index("E"))).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )
    unknown = read.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(unknown).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )


def walk(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """All prefixes of all orders with every mask: (prefix, step, letter, before, mask) and the flags of that step.

    `before` holds the bits applied before the step. Meant for up to six letters: their orders are all enumerated.
    """
    unused = ", ".join(f"struct('{x}' AS letter, {1 << i} AS bit)" for i, x in enumerate(letters))
    return masks.sparkSession.sql(
        f"""
        WITH RECURSIVE walk(prefix, step, letter, before, applied, mask, removed, redundant, unique_fails) AS (
          SELECT '', 0, '', 0, 0, mask, false, false, false FROM {{masks}}
          UNION ALL
          SELECT concat(prefix, f.letter), step + 1, f.letter, applied, applied | f.bit, mask,
                 (mask & f.bit) != 0 AND (mask & applied) = 0, (mask & f.bit) != 0 AND (mask & applied) != 0, mask = f.bit
          FROM (
            SELECT prefix, step, applied, mask,
                   explode(filter(array({unused}), x -> (applied & x.bit) = 0)) AS f
            FROM walk WHERE step < {len(letters)}
          )
        )
        SELECT *, (mask & applied) = 0 AS kept FROM walk WHERE step > 0
        """,
        masks=masks,
    )


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, mask, n, good, toxic) to one row for each part, order and step with what the step does there."""
    counted = stage(counted, "cells")
    walked = stage(walk(counted.select("mask").distinct(), letters), "walk")
    prefixes = walked.select("prefix", "step", "before", "letter").distinct()
    orders = prefixes.where(F.col("step") == len(letters)).select(
        F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("at")
    )
    orders = orders.select("filter_order", F.expr("substring(filter_order, 1, at)").alias("prefix")).join(prefixes, "prefix")
    orders = stage(orders.drop("prefix"), "orders")

    # What a step does depends on the bits before it, not on their order.
    moves = walked.select("before", "letter", "mask", "kept", "removed", "redundant", "unique_fails").distinct()
    moves = moves.join(orders.groupBy("before", "letter").agg(F.count("*").alias("times")), ["before", "letter"])
    lost = F.col("removed")

    def total(flag: Column, value: str) -> Column:
        return F.sum(F.when(flag, F.col(value)).otherwise(0))

    done = (
        counted.join(F.broadcast(moves), "mask")
        .groupBy("part", "before", "letter")
        .agg(
            F.first("times").alias("times"),
            *(total(F.col(m), "n").alias(m) for m in METRICS[:4]),
            total(lost, "good").alias("good_lost"),
            total(lost, "toxic").alias("toxic_lost"),
        )
    )
    by_filter = Window.partitionBy("part", "letter")
    done = done.withColumn("shapley", F.sum(F.col("removed") * F.col("times")).over(by_filter))
    return done.join(F.broadcast(orders), ["before", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), *METRICS, "shapley"
    )
