"""URL filters (operator 9): sort-merge range join of hosts and rules.

A host's canonical key is its labels from the last to the first, each with a
dot after it, so a rule's host and all its subdomains are the interval of keys
with one prefix. Intervals of two rules are nested or apart. Rules' openings
and the pages' distinct hosts are sorted into ranges of keys and swept: every
opening carries the stack of rules that enclose it, a host takes the stack of
the last opening before it (of its range, or carried over from an earlier
one) and pops the rules that have ended. A page then takes, of its host's
active rules, the longest whose path its own starts with.

All steps are DataFrame functions. The stack is as deep as a host has labels
and as wide as these labels have rules; hosts are swept once each, however
many pages they have.

Defined results: a null url or one without ``://`` has empty host and path;
no rule fits an empty host; without a fitting rule the verdict is
``default``; of rules that are equally long the longer host's wins, then block
before allow; rules without host or path are left out; repeated pages each get
a row; empty tables give no rows, or only default verdicts; other columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialize


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A DataFrame (host, path, verdict) of literal rules."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)\z", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def host_key(host: Column) -> Column:
    """``a.example.net`` to ``net.example.a.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _prefixes(key: Column) -> Column:
    """Keys of a host's own and all its parent domains."""
    labels = F.slice(F.split(key, r"\."), 1, F.size(F.split(key, r"\.")) - 1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda k: F.concat(F.array_join(F.slice(labels, F.lit(1), k), "."), F.lit(".")))


def _openings(rules: DataFrame) -> DataFrame:
    """key and the stack of rules whose intervals enclose it, its own included."""
    host = lower_ascii(F.col("host"))
    r = rules.where("length(host) > 0 and path is not null and verdict is not null").select(
        host_key(host).alias("key"),
        F.struct(F.length(F.concat(host, "path")).alias("size"), F.length(host).alias("host_size"),
                 (F.col("verdict") == "block").alias("block"), host_key(host).alias("key"), F.col("path").alias("path"),
                 F.concat(host, "path").alias("rule"), F.col("verdict").alias("verdict")).alias("r")).distinct()
    up = r.select("key").distinct().select("key", F.explode(_prefixes(F.col("key"))).alias("_above"))
    return up.join(r.select(F.col("key").alias("_above"), "r"), "_above").groupBy("key").agg(F.collect_list("r").alias("stack"))


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts``: distinct ``key``s. Returns key and ``stack`` (the rules whose
    intervals hold it) for keys that have any."""
    n = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    openings = _openings(rules)
    empty = F.lit(None).cast(openings.schema["stack"].dataType)
    events = openings.select("key", F.lit(0).alias("kind"), "stack").unionByName(
        hosts.select("key", F.lit(1).alias("kind"), empty.alias("stack")))
    swept, _ = materialize(events.repartitionByRange(n, "key", "kind").withColumn("part", F.spark_partition_id()), "url-events")
    order = Window.partitionBy("part").orderBy("key", "kind")
    # one row for each range: the last stack that it opens, carried to the ranges after it
    ends = swept.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("_last"))
    carried = ends.select("part", F.last("_last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    rows = swept.withColumn("stack", F.last("stack", ignorenulls=True).over(order)).where("kind = 1").join(carried, "part")
    return rows.select("key", F.filter(F.coalesce("stack", "_carried"), lambda r: F.startswith(F.col("key"), r["key"])).alias("stack")) \
        .where(F.size("stack") > 0)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per row of pages: page_id, host, path, rule, verdict."""
    host, path = host_and_path(pages["url"].cast("string"))
    split = pages.select(pages["page_id"].cast("long").alias("page_id"), host.alias("host"), path.alias("path")) \
        .withColumn("key", F.when(F.col("host") != "", host_key(F.col("host"))))
    found = active_rules(split.select("key").where("key is not null").distinct(), rules)
    fits = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    best = split.join(found, "key", "left").withColumn("_best", F.array_max(fits))
    return best.select("page_id", "host", "path", F.col("_best.rule").alias("rule"),
                       F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
