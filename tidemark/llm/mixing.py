"""Mixing sources to target weights (operator 11), by entropy balancing.

Every document gets a rate, the number of times that it should be taken. Among
all rates from 0 to ``cap`` that give each source its target of tokens, those
of least relative entropy against one copy each are wanted. They are
exponentially tilted: ``min(cap, exp(lambda * tokens / mean tokens))``, with
one ``lambda`` for each source, the solution of the convex dual. Newton's
iterations find all of them together (``solve``): each is one aggregation, the
gradient (tokens at the present rates, less the target) and the Hessian of each
source, over the table of (source, size, documents). That table is no larger
than the sizes that occur, whatever the number of documents, and a source that
holds most documents is spread over its sizes. A step out of the bracket known
to hold the solution halves the bracket instead.

Rates are rounded into copies within buckets of about ``BUCKET`` documents of a
source, from the longest to the shortest: the tokens that the documents before
were given too few or too many decide whether a document gets the copy more.
What remains of a bucket is about half of its shortest document.

All is exact and repeatable: rates are multiples of 2**-30, sums are decimals.

Defined results: a null text has no tokens, its rate is 1 (nothing to take);
null is a source of its own, the last in order; a null doc_id is an id; equal
(doc_id, source, size) rows are rounded together, each gets a whole number of
copies; a target is never above ``cap`` times the tokens of its source, the rest
goes to the others by weight; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, release

#: Documents that are rounded together.
BUCKET = 4096
#: Fraction bits of a rate.
BITS = 30
#: Sources in one partition while they are put in order.
RANGE = 100_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


# -- targets -----------------------------------------------------------------

def in_order(sources: DataFrame) -> DataFrame:
    """sources with ``place``, from 0, by code point, null last. Ranges are
    counted where they lie; only their counts meet in one task."""
    parts = max(1, math.ceil(sources.count() / RANGE))
    keys = [F.col("source").isNull(), F.col("source")]
    ranged, _ = materialize(sources.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                            .withColumn("_at", F.monotonically_increasing_id()), "mix-sources")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    before = ranged.groupBy("_range").agg(F.count("*").alias("_n")) \
        .withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n"))
    return ranged.join(before, "_range").withColumn("place", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)) \
        .drop("_at", "_range", "_n", "_before")


def targets(sources: DataFrame, weights: list[int], cap: int) -> DataFrame:
    """sources (source, tokens, documents) with weight and target. All tokens
    are shared by weight; a share above ``cap`` times its source's tokens stops
    there, and what is over is shared again among the rest, until none is."""
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed, _ = materialize(in_order(sources).withColumn("weight", weight.cast("long")), "mix-weights")
    total = placed.agg(F.sum("tokens")).first()[0] or 0
    unit, stopped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(unit) >= cap * F.col("tokens")
        if stopped < 0:
            full = F.lit(False)
        n, held, free = placed.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, cap * F.col("tokens"))), F.lit(0)),
                                   F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not free:
            break
        unit, stopped = (total - held) / free, n
    share = F.col("weight") * F.lit(unit)
    whole = (cap * F.col("tokens")).cast("double")
    return placed.withColumn("target", F.least(share, whole))


# -- the dual ----------------------------------------------------------------

def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    """Rate in units of 2**-BITS; sources that are taken ``cap`` times have no tilt."""
    exact = F.least(F.lit(float(cap)), F.exp(F.least(tilt * size / mean, F.lit(50.0))))
    return F.round(F.coalesce(exact, F.lit(float(cap))) * (1 << BITS)).cast("long")


def solve(sizes: DataFrame, sources: DataFrame, cap: int, tolerance: float = 1e-7, rounds: int = 100) -> DataFrame:
    """sources with ``tilt`` (null: every document is taken ``cap`` times), at
    which a source's tokens are its target but for a quarter of a token or
    ``tolerance`` of it. ``sizes``: a written table of place, size, n (size over
    0); ``sources``: place, tokens, documents, target."""
    spark = sizes.sparkSession
    mean = F.col("tokens") / F.col("documents")
    full = F.col("target") >= cap * F.col("tokens")
    least = sizes.groupBy("place").agg(F.min("size").alias("least"))
    ratio = F.log(F.col("target") / F.col("tokens")) * mean / F.col("least")
    # all rates of a source lie between those of its shortest documents
    start = sources.join(least, "place").withColumn("mean", mean).select(
        "place", "target", "mean", F.when(~full, F.lit(0.0)).alias("tilt"),
        F.least(ratio, F.lit(0.0)).alias("lo"),
        F.when(ratio > 0, math.log(cap) * F.col("mean") / F.col("least")).otherwise(0.0).alias("hi"), F.lit(1.0).alias("error"))
    state, path = materialize(start, "mix-tilt")
    unit = F.lit(float(1 << BITS))
    for k in range(rounds):
        units = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
        tokens = F.col("n").cast("decimal(18,0)") * F.col("size").cast("decimal(12,0)")
        rated = sizes.join(state, "place").select("place", units.alias("units"), tokens.alias("tokens"), F.col("size").alias("size"))
        slope = F.when(F.col("units") < cap << BITS, F.col("size"))
        sums = rated.groupBy("place").agg(
            F.sum((F.col("tokens").cast("decimal(22,0)") * F.col("units").cast("decimal(15,0)")).cast("decimal(38,0)")).alias("given"),
            F.sum((F.col("tokens").cast("decimal(22,0)") * (slope * F.col("units")).cast("decimal(15,0)")).cast("decimal(38,0)")).alias("slope"))
        gradient = F.col("given").cast("double") / unit - F.col("target")
        hessian = F.col("slope").cast("double") / unit / F.col("mean")
        error = F.abs(F.col("gradient")) / F.greatest(F.col("target") * tolerance, F.lit(0.25))
        stepped = state.join(sums, "place").withColumn("gradient", gradient).withColumn("hessian", hessian) \
            .withColumn("lo", F.when(F.col("gradient") < 0, F.col("tilt")).otherwise(F.col("lo"))) \
            .withColumn("hi", F.when(F.col("gradient") > 0, F.col("tilt")).otherwise(F.col("hi"))) \
            .withColumn("_newton", F.col("tilt") - F.col("gradient") / F.nullif(F.col("hessian"), F.lit(0.0)))
        inside = F.col("_newton").isNotNull() & (F.col("_newton") > F.col("lo")) & (F.col("_newton") < F.col("hi"))
        # a tilt that meets its target stays
        moved = F.when(F.col("tilt").isNull() | (error < 1), F.col("tilt")) \
            .when(inside, F.col("_newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        after, new = materialize(stepped.select(
            "place", "target", "mean", moved.alias("tilt"), "lo", "hi",
            F.when(F.col("tilt").isNotNull() & (F.col("hi") - F.col("lo") > 1e-13 * F.abs(F.col("hi"))), error).otherwise(0.0).alias("error")), f"mix-tilt{k}")
        release(spark, path)
        state, path = after, new
        if (state.agg(F.max("error")).first()[0] or 0.0) < 1:
            break
    return sources.join(state.select("place", "tilt"), "place", "left")


# -- copies ------------------------------------------------------------------

def _rounded(cap: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], na_position="first")
        owed, copies, extra = 0, [], []
        for size, n, units in zip(rows["size"].tolist(), rows["n"].tolist(), rows["units"].tolist()):
            whole, part = units >> BITS, units & (1 << BITS) - 1
            more = 0
            if part and size:
                owed += n * size * part
                more = min(n, max(0, ((owed << 1) // (size << BITS) + 1) >> 1))
                owed -= more * size << BITS
            copies.append(whole)
            extra.append(more)
        return rows[["doc_id", "place", "size", "n"]].assign(copies=copies, extra=extra)

    return run


def mix(rows: DataFrame, weights: list[int], cap: int = 3) -> DataFrame:
    """``rows``: doc_id, source, size (tokens). Returns, for each of them,
    doc_id, source, size, source_size, target, rate and copies (0 to ``cap``).

    ``weights`` go round the sources in order and share out the tokens of all."""
    spark = rows.sparkSession
    keys = rows.select(rows["doc_id"], rows["source"].cast("string").alias("source"), rows["size"].cast("long").alias("size")) \
        .groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    keys, keys_path = materialize(keys, "mix-documents")
    per_source = keys.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"),
                                            F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("documents"), F.sum("n").alias("rows"))
    sources, sources_path = materialize(targets(per_source, weights, cap), "mix-targets")
    # Spark broadcasts the sources by their measured size, or joins by shuffle
    name = sources.select(F.col("source").alias("_source"), "place")
    sizes = keys.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes, sizes_path = materialize(sizes.join(name, F.col("source").eqNullSafe(F.col("_source"))).select("place", "size", "n"), "mix-sizes")
    solved, solved_path = materialize(solve(sizes, sources, cap), "mix-solved")
    known = solved.withColumnRenamed("source", "_source").withColumn("mean", F.col("tokens") / F.nullif(F.col("documents"), F.lit(0)))
    units = F.when(F.col("size") > 0, _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)).otherwise(1 << BITS)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET))
    rated = keys.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "place", "size", "n", units.alias("units"), F.pmod(F.xxhash64("doc_id", "size"), buckets).alias("bucket"))
    rounded = rated.groupBy("place", "bucket").applyInPandas(
        _rounded(cap), f"doc_id {dict(keys.dtypes)['doc_id']}, place long, size long, n long, copies long, extra long")
    # of n equal rows, the first ``extra`` have a copy more
    each = rounded.select("doc_id", "place", "size", "copies", "extra", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_k"))
    each = each.select("doc_id", F.col("place").alias("_place"), "size", (F.col("copies") + (F.col("_k") <= F.col("extra")).cast("long")).alias("copies"))
    facts = solved.select("place", "source", F.col("tokens").alias("source_size"), "target", "tilt",
                          (F.col("tokens") / F.nullif(F.col("documents"), F.lit(0))).alias("mean"))
    rate = F.when(F.col("size") > 0, _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap) / F.lit(float(1 << BITS))).otherwise(1.0)
    out, _ = materialize(each.join(facts, F.col("_place") == F.col("place")).select(
        "doc_id", "source", "size", "source_size", "target", rate.alias("rate"), "copies"), "mix")
    for path in (keys_path, sources_path, sizes_path, solved_path):
        release(spark, path)
    return out


def mix_documents(docs: DataFrame, weights: list[int], cap: int = 3) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken. Columns as
    they were."""
    size = word_count(docs["text"])
    names = docs.columns
    key = [docs["doc_id"], docs["source"].cast("string").alias("source"), size.alias("size")]
    plan = mix(docs.select(*key), weights, cap).groupBy("doc_id", "source", "size").agg(
        F.min("copies").alias("_copies"), F.sum("copies").alias("_sum"), F.count("*").alias("_n")) \
        .withColumnsRenamed({"doc_id": "_id", "source": "_source", "size": "_size"})
    held = docs.select(F.struct(*(docs[c] for c in names)).alias("_row"), docs["doc_id"].alias("_doc"), docs["source"].cast("string").alias("_from"),
                       size.alias("_words"))
    joined = held.join(plan, F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_from").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")))
    order = Window.partitionBy("_doc", "_from", "_words").orderBy(F.xxhash64("_row.text"))
    extra = F.col("_sum") - F.col("_copies") * F.col("_n")
    times = F.col("_copies") + F.when((F.col("_n") > 1) & (F.row_number().over(order) <= extra), 1).otherwise(0)
    taken = joined.withColumn("_times", times).where("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return taken.select(*(F.col("_row").getField(c).alias(c) for c in names))
