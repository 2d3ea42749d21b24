"""URL filter: a sort-merge range join of addresses with nested host rules, in DataFrame functions only.

A host is turned round, label by label, with a dot after each label: ``blog.example.com`` is ``com.example.blog.``.
A rule for a host and its subdomains then is the interval [``com.example.``, ``com.example/``) of keys, as '/' is the
byte after '.'. Such intervals nest or are apart. Each group of a top label is sorted by key and swept once; a rule
host that comes up carries its stack, that is its own rules and those of the intervals round it, and an address takes
the last stack before it, from which the intervals that have ended and the paths that do not fit are popped.

Intervals never cross top labels, so a group is swept alone. A top label with many addresses is salted: each salt has
its share of the addresses and all rule hosts of the label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravia.llm.rows import without
from terravia.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Addresses of one top label that one sweep takes, about.
SWEEP_ROWS = 200_000
ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """From after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without '://' or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end; empty without '://' or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the top down, a dot after each; empty for the empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def top_label(key: Column) -> Column:
    return F.substring_index(key, ".", 1)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key and the rules of it and of the hosts above it, the winner of all first.

    ``rules`` has host, path and verdict. Longest means the text host + path; at equal length the deeper host goes
    first, then block. Rules with a null are left out.
    """
    own = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("host"), F.col("path").alias("path"), F.col("verdict").alias("verdict")
        )
        .dropna()
        .filter(F.col("host") != "")
        .distinct()
        .withColumn("key", host_key(F.col("host")))
        .withColumn("rule", F.concat("host", "path"))
    )
    entry = F.struct(
        (-F.length("rule")).alias("order"),
        (-F.length("key")).alias("depth"),
        (F.col("verdict") != BLOCK).alias("open"),
        "key",
        "path",
        "rule",
        "verdict",
    )
    # The hosts above a host are its own leading labels, so an equi-join finds the nesting.
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    leading = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.concat_ws(".", F.slice(labels, 1, n)), F.lit("."))
    )
    above = own.select("key").distinct().select(F.col("key").alias("at"), F.explode(leading).alias("key"))
    stacks = above.join(own, "key").groupBy("at").agg(F.sort_array(F.collect_list(entry)).alias("stack"))
    return stacks.withColumnRenamed("at", "key")


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, sweep_rows: int = SWEEP_ROWS
) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    A rule fits its host and all subdomains if the url's path starts with the rule's path. The longest fitting rule
    decides (see ``rule_stacks`` for ties); ``rule`` is its host + path, null where none fits, and the verdict is then
    ``default``. A null url or one without '://' has an empty host and path and no rule. Every input row gives one row,
    equal ones too; input columns named like a result are replaced. Without rules every row gets the default.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "_key", "_top", "_salt", "_stack", "_sweep", "_page")
    host = url_host(F.col(url))
    points = (
        pages.select(F.struct("*").alias("_page"), host.alias("host"), url_path(F.col(url)).alias("path"))
        .withColumn("_key", host_key(F.col("host")))
        .withColumn("_top", top_label(F.col("_key")))
    )

    # Written once: the planner then knows the sizes and broadcasts what is small.
    stacks = cut_lineage(rule_stacks(rules).withColumn("_top", top_label(F.col("key"))), "rule-stacks")
    # How many sweeps a top label with rules is dealt to: a row per such label.
    tops = stacks.select("_top").distinct()
    sweeps = cut_lineage(
        pages.select(top_label(host_key(host)).alias("_top"))
        .groupBy("_top")
        .count()
        .join(tops, "_top")
        .select("_top", F.ceil(F.col("count") / sweep_rows).cast("int").alias("_sweep")),
        "rule-sweeps",
    )
    spread = F.pmod(F.xxhash64("_key", "path", F.monotonically_increasing_id()), F.coalesce("_sweep", F.lit(1)))
    # Labels without rules need no sweep, so they are not sorted.
    dealt = points.join(sweeps, "_top", "left")
    ruled, free = dealt.filter(F.col("_sweep").isNotNull()), dealt.filter(F.col("_sweep").isNull())
    right = ruled.select(
        "_top",
        spread.cast("int").alias("_salt"),
        "_key",
        "_page",
        "host",
        "path",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("_stack"),
    )
    left = stacks.join(sweeps, "_top").select(
        "_top",
        F.explode(F.sequence(F.lit(0), F.col("_sweep") - 1)).alias("_salt"),
        F.col("key").alias("_key"),
        F.lit(None).cast(points.schema["_page"].dataType).alias("_page"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        F.col("stack").alias("_stack"),
    )
    # A rule host goes before the addresses with the same key.
    order = (
        Window.partitionBy("_top", "_salt")
        .orderBy("_key", F.col("_page").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = left.unionByName(right).withColumn("_stack", F.last("_stack", ignorenulls=True).over(order))
    fits = F.filter("_stack", lambda r: F.col("_key").startswith(r["key"]) & F.col("path").startswith(r["path"]))
    swept = swept.filter(F.col("_page").isNotNull()).withColumn("_best", F.get(fits, F.lit(0)))
    done = swept.select(
        "_page",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
    rest = free.select("_page", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return done.unionByName(rest).select("_page.*", "host", "path", "rule", "verdict")
