"""How filters act on each other in every order in which they can be applied.

A document fails a set of filters, its mask. In one order of the filters it is removed at the first step whose filter
is in the mask. Orders are numbered by Lehmer rank, that is lexicographically, so all orders that begin alike are one
interval of ranks: a beginning of k letters covers (n - k)! ranks. A mask's removal at step k is then a few intervals,
those of the beginnings whose last letter is its first one in the mask. Counts by mask are added where an interval
begins and taken off where it ends; prefix sums over the ranks give every order's figures at once.

The documents are read once. After that only counts travel: by text and id, by id, and at last 2^n by part.
"""

from __future__ import annotations

from collections import Counter
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravia.session import cut_lineage

COPY = "E"
WORD = r"[^\x20\x09-\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D of a text that is not null: short, repetitive, capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def intervals(n: int) -> list[tuple[int, str, int, int, int]]:
    """(mask, kind, step, rank, change) of the difference arrays of all masks of ``n`` filters.

    Kinds: ``removed``, at the mask's first step; ``redundant``, at its later ones. Bit i of a mask is filter i.
    """
    place = {p: r for r, p in enumerate(permutations(range(n)))}
    change: Counter = Counter()
    for step in range(1, n + 1):
        for begin in permutations(range(n), step):
            rank = place[begin + tuple(i for i in range(n) if i not in begin)]
            before = sum(1 << i for i in begin[:-1])
            for mask in range(1, 1 << n):
                if mask >> begin[-1] & 1:
                    kind = "redundant" if mask & before else "removed"
                    change[mask, kind, step, rank] += 1
                    change[mask, kind, step, rank + factorial(n - step)] -= 1
    # Where one interval ends and the next begins the changes cancel: neighbours are one interval.
    return sorted((*k, v) for k, v in change.items() if v and k[3] < factorial(n))


def mask_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part``, ``mask``, ``n``, ``good``, ``toxic``: documents by part and failed filters (A is bit 0, E bit 4)."""
    said = labels.groupBy(F.col(doc_id).alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    fails = text_failures(whole)
    mask = sum((F.when(fails[c], 1 << i).otherwise(0) for i, c in enumerate("ABCD")), F.lit(0))
    narrow = docs.select(
        F.unhex(F.sha2(whole, 256)).alias("_text"), F.col(doc_id).alias("_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("_mask"),
    )
    # Equal rows are counted before the shuffle, so a text that a third of the rows share is few rows of a key.
    rows = cut_lineage(narrow.groupBy("_text", "_id", "part", "_mask").agg(F.count(F.lit(1)).alias("_n")), "filter-audit")
    # A text's least id is a row of its own: joined by text and id, so that no group of copies is one key.
    least = rows.groupBy("_text").agg(F.min("_id").alias("_id")).withColumn("_least", F.lit(True))
    copy = F.col("_id").isNotNull() & F.col("_least").isNull()
    counted = rows.join(least, ["_text", "_id"], "left").groupBy(
        "_id", "part", (F.col("_mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask")
    ).agg(F.sum("_n").alias("_n"))
    counted = cut_lineage(counted, "filter-audit-ids")
    # Null ids have no label and would be one key of the join.
    with_id = counted.filter(F.col("_id").isNotNull()).join(said, "_id", "left")
    no_id = counted.filter(F.col("_id").isNull()).withColumn("_good", F.lit(0)).withColumn("_toxic", F.lit(0))
    return with_id.unionByName(no_id).groupBy("part", "mask").agg(
        F.sum("_n").alias("n"),
        F.sum(F.when(F.col("_good") == 1, F.col("_n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic") == 1, F.col("_n")).otherwise(0)).alias("toxic"),
    )


def interactions(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """From counts by ``part`` and ``mask``: one row per part, order of the filters and step."""
    spark, n = counts.sparkSession, len(letters)
    changes = spark.createDataFrame(intervals(n), "mask int, kind string, step int, rank int, change int")
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    # Every step of every order of a part, with the figures that do not depend on the order.
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("_all"), F.array(*alone).alias("_alone"))
    grid = parts.select("part", "_all", "_alone", F.posexplode(orders).alias("rank", "filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    grid = grid.withColumn("_letter", letter)
    removed, again = F.col("kind") == "removed", F.col("kind") == "redundant"
    # The table of changes has a fixed size, given by the number of filters.
    moved = counts.join(F.broadcast(changes), "mask").groupBy("part", "rank", "step").agg(
        *[F.sum(F.when(on, F.col("change") * F.col(c)).otherwise(0)).alias(name)
          for name, on, c in (("removed", removed, "n"), ("redundant", again, "n"), ("good_lost", removed, "good"), ("toxic_lost", removed, "toxic"))]
    )
    by_step = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    by_order = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = [F.sum(F.coalesce(F.col(c), F.lit(0))).over(by_step).alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")]
    steps = grid.join(moved, ["part", "rank", "step"], "left").select(
        "part", "filter_order", "rank", "step", "_all", "_alone", "_letter", *summed
    )
    unique = F.element_at("_alone", F.instr(F.lit(letters), F.col("_letter")))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("_all") - F.sum("removed").over(by_order)).alias("kept"), "removed", "redundant",
        unique.alias("unique_fails"), "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "_letter")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley`` of the filters A to E over all documents: 600 rows a part.

    A null text is empty; null and empty sources are the part ''. A null id has no smaller one and is none, so such a
    row does not fail E and makes no other fail it; equal rows with one id do not fail E either, each is counted. A
    document is good or toxic if any label of its id says so. No documents give no rows. Other columns, also such with
    names of the result, are not read.
    """
    return interactions(mask_counts(docs, labels, doc_id, text, part))


AUDIT_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT t.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM t LEFT JOIN said ON t.doc_id = said.doc_id),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
hit AS (
  SELECT g.*, filter_order, step, letter, contains(fails, letter) AS failing,
         regexp_matches(fails, '[' || earlier || 'x]') AS gone
  FROM g, steps),
sums AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
         CAST(sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN failing AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN failing AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM hit GROUP BY ALL)
SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM sums
"""
