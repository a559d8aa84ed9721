"""Conversation prefix trie (operator 12), by truncation peeling.

A node is a distinct sequence of a conversation's first turns. The descent
starts at the greatest depth: conversations that end there become nodes, every
node is counted once, loses its last turn, and is grouped anew with its
siblings and with the conversations that end one turn earlier, and so on up to
the root. A node's numbers are sums and minima over what reached it, so they
are complete when its depth's turn comes, and no prefix is emitted that isn't a
node. A very common opening is one row for each task in the shuffle.

Turns travel as 16-byte names of the prefix that they end (``_segments``): a
chain of digests in the conversation's order. A conversation is stored in
segments of ``BAND`` turns; a band's descent carries the names of that band
only, and takes the next band's from the segment of the node's least member.
The few longest conversations would need a job for each of very many depths:
bands that hold at most ``LOCAL_TURNS`` turns in all, counted beforehand, are
peeled inside tasks instead, grouped by the node in which they leave the first
band.

Defined results: a null role or text is empty; null turns come first, turns of
one number go by role and text digest, repeated rows each are a turn; rows
without a conv_id belong to no conversation; a conversation without turns ends
in the root; an empty table gives an empty result; other columns are ignored.
A conversation's turns pass through one task in order, one batch in memory at
a time, as do the ids of the conversations that end in one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, release, work_dir

#: Turns of a segment.
BAND = 8
#: Turns in all that may be peeled inside tasks.
LOCAL_TURNS = 200_000
#: Ids in one part of a node's list.
PART = 4096
#: Most nodes that are joined as parents by broadcast.
BROADCAST_PARENTS = 10_000


# -- turns -------------------------------------------------------------------

def ordered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), mark (digest of role and text) and size (code
    points of the text) of every row that has a conv_id."""
    role, text = F.coalesce(rows["role"].cast("string"), F.lit("")), F.coalesce(rows["text"].cast("string"), F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = rows.where(rows["conv_id"].isNotNull()).select(
        rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].alias("turn"), role.alias("role"), mark.alias("mark"),
        F.char_length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "mark")
    return turns.select("conv_id", F.row_number().over(order).alias("place"), "mark", "size")


def shared_openings(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) in which each conversation's first h turns are
    those of the first one of its block of ids, h being the checksum of its id
    modulo ``most``. A block's opening goes to at most ``block`` conversations."""
    conversations = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    named = conversations.select("conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("_base"), taken.alias("_h"))
    opening = turns.where((F.col("conv_id") % block == 0) & (F.col("place") < most)) \
        .select(F.col("conv_id").alias("_base"), "place", "mark", "size")
    given = named.join(opening, "_base").where(F.col("place") <= F.col("_h")).select("conv_id", "place", "mark", "size")
    own = turns.where(F.col("place") > F.crc32(F.col("conv_id").cast("string")) % most)
    return given.unionByName(own), conversations.select("conv_id")


# -- segments ----------------------------------------------------------------

SEGMENT = "conv_id long, band int, ends boolean, stem binary, before binary, names array<binary>, sizes array<long>"


def _segments(width: int):
    """Sorted turns to segments of ``width``. ``before`` names the prefix in
    front of the segment, ``stem`` the one that the first band ends with."""
    columns = ["conv_id", "band", "ends", "stem", "before", "names", "sizes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, names, sizes, band, before, stem, last = None, [], [], 0, b"", b"", b""
        for batch in batches:
            out = []
            for c, mark, size in zip(batch["conv_id"], batch["mark"], batch["size"]):
                if c != conv:
                    if conv is not None:
                        out.append((conv, band, True, stem, before, names, sizes))
                    conv, names, sizes, band, before, stem, last = c, [], [], 0, b"", b"", b""
                if mark is None:  # stands for the conversation itself
                    continue
                if len(names) == width:
                    if not band:
                        stem = last
                    out.append((conv, band, False, stem, before, names, sizes))
                    names, sizes, band, before = [], [], band + 1, last
                last = hashlib.md5(last + mark).digest()
                names.append(last)
                sizes.append(size)
            yield pd.DataFrame(out, columns=columns)
        if conv is not None:
            yield pd.DataFrame([(conv, band, True, stem, before, names, sizes)], columns=columns)

    return run


# -- peeling -----------------------------------------------------------------

NODE = ("name binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens decimal(38,0)")


def _sums() -> list:
    """Of what reaches a node from below: ended conversations and child nodes."""
    return [F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("child").alias("n_children"),
            F.sum("leaves").alias("leaves"), F.sum("saved").cast("decimal(38,0)").alias("saved")]


def _arrivals(ended: DataFrame) -> DataFrame:
    """Ended conversations as rows that reach their node."""
    return ended.select("conv_id", "before", "names", "sizes", F.lit(1).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("child"),
                        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("decimal(38,0)").alias("saved"))


def _level(arrivals: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth, with the names and sizes of their band so far."""
    grouped = arrivals.groupBy("before", "names", "sizes").agg(*_sums())
    size = F.element_at("sizes", -1)
    return grouped.select(
        F.element_at("names", -1).alias("name"),
        F.when(F.size("names") > 1, F.element_at(F.col("names"), F.greatest(F.size("names") - 1, F.lit(1)))).otherwise(F.col("before")).alias("parent"),
        F.lit(depth).cast("long").alias("depth"), "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * size).cast("decimal(38,0)").alias("saved_tokens"), "before", "names", "sizes")


def _as_children(nodes: DataFrame, before, names, sizes) -> DataFrame:
    """Nodes stripped of their last turn, as rows that reach their parent."""
    return nodes.select("conv_id", before.alias("before"), names.alias("names"), sizes.alias("sizes"), "n_convs",
                        F.lit(1).cast("long").alias("child"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))


def _peel_inside(width: int):
    """The nodes of segments with one stem, down to the first band among them."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        paths: dict = {}
        for r in rows.sort_values("band").itertuples():
            paths.setdefault(r.conv_id, []).extend(zip(r.names, r.sizes, [r.before, *r.names[:-1]]))
        lowest = int(rows["band"].min()) * width
        by_depth: dict = {}
        for c, path in paths.items():
            by_depth.setdefault(len(path), []).append(c)
        out, alive = [], {}
        for d in range(max(by_depth), 0, -1):
            # name: conv_id, members, children, leaves, saved
            here: dict = {}
            for conv, n, child, leaves, saved in [*((c, 1, 0, 0, 0) for c in by_depth.get(d, ())), *alive.values()]:
                name = paths[conv][d - 1][0]
                c, m, k, l, s = here.get(name, (conv, 0, 0, 0, 0))
                here[name] = (min(c, conv), m + n, k + child, l + leaves, s + saved)
            alive = {}
            for name, (c, m, k, l, s) in here.items():
                _, size, parent = paths[c][d - 1]
                leaves, saved = (l if k else 1), s + (m - 1) * int(size)
                out.append((name, parent, lowest + d, c, m, k, leaves, saved))
                alive[name] = (c, m, 1, leaves, saved)
        nodes = pd.DataFrame(out, columns=["name", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])
        nodes["saved_tokens"] = nodes["saved_tokens"].map(str)
        return nodes

    return run


def _nodes(segments: DataFrame, local_turns: int, width: int) -> tuple[DataFrame, str]:
    """All nodes but the root, and the path of their copy; ``segments`` must be
    a written table."""
    spark, base = segments.sparkSession, work_dir(segments.sparkSession, "trie-nodes")
    per_band = sorted(((r["band"], r["n"]) for r in segments.groupBy("band").agg(F.sum(F.size("names")).alias("n")).collect()), reverse=True)
    turns, first_local, paths = 0, None, []
    for band, n in per_band:
        turns += n
        if band and turns <= local_turns:
            first_local = band
    keep = [c.split()[0] for c in NODE.split(", ")]
    carry = NODE + ", before binary, names array<binary>, sizes array<long>"

    def written(df, name, schema):
        path = f"{base}/{name}"
        df.write.parquet(path)
        paths.append(path)
        return spark.read.schema(schema).parquet(path)

    above = None  # nodes of the depth below, stripped
    if first_local is not None:
        deep = segments.where(F.col("band") >= first_local).groupBy("stem") \
            .applyInPandas(_peel_inside(width), NODE.replace("decimal(38,0)", "string")) \
            .withColumn("saved_tokens", F.col("saved_tokens").cast("decimal(38,0)"))
        deep = written(deep, "deep", NODE)
        above = deep.where(F.col("depth") == first_local * width + 1)
    top = per_band[0][0] if per_band else -1
    for band in range(top if first_local is None else first_local - 1, -1, -1):
        here = segments.where(F.col("band") == band)
        ended = _arrivals(here.where("ends"))
        if above is not None:  # they have had a whole band below them
            full = here.where(~F.col("ends")).select(F.col("conv_id").alias("_c"), F.col("before").alias("_b"), F.col("names").alias("_n"), F.col("sizes").alias("_s"))
            reached = above.select("conv_id", "n_convs", "n_leaves", "saved_tokens").join(full, F.col("conv_id") == F.col("_c"))
            above = _as_children(reached, F.col("_b"), F.col("_n"), F.col("_s"))
        for j in range(width, 0, -1):
            arrivals = ended.where(F.size("names") == j)
            if above is not None:
                arrivals = arrivals.unionByName(above)
            nodes = written(_level(arrivals, band * width + j), f"{band * width + j:09d}", carry)
            above = _as_children(nodes, F.col("before"), F.slice("names", 1, j - 1), F.slice("sizes", 1, j - 1)) if j > 1 else nodes
    none = spark.createDataFrame([], NODE)
    return (spark.read.schema(NODE).parquet(*paths).select(*keep) if paths else none), base


def _root(nodes: DataFrame, turnless: DataFrame) -> DataFrame:
    """The textless root, over the nodes of depth 1 and conversations without
    turns; no row when there is neither."""
    parts = nodes.where("depth = 1").select("conv_id", "n_convs", F.lit(1).cast("long").alias("child"), F.col("n_leaves").alias("leaves"),
                                            F.col("saved_tokens").alias("saved")) \
        .unionByName(turnless.select("conv_id", F.lit(1).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("child"),
                                     F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("decimal(38,0)").alias("saved")))
    return parts.agg(*_sums()).where("n_convs > 0").select(
        F.lit(b"").alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


# -- conversations that end in a node ------------------------------------------

def _parts(most: int):
    """Sorted (name, conv_id) rows to comma-joined parts of a name's list."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, ids = None, []
        for batch in batches:
            out = []
            for n, c in zip(batch["name"], batch["conv_id"]):
                if ids and (n != name or len(ids) == most):
                    out.append((name, ids[0], ",".join(map(str, ids))))
                    ids = []
                name = n
                ids.append(c)
            yield pd.DataFrame(out, columns=["name", "first", "part"])
        if ids:
            yield pd.DataFrame([(name, ids[0], ",".join(map(str, ids)))], columns=["name", "first", "part"])

    return run


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    name, sha = None, None
    for batch in batches:
        out = []
        for n, part in zip(batch["name"], batch["part"]):
            if sha is None or n != name:
                if sha is not None:
                    out.append((name, sha.hexdigest()))
                name, sha = n, hashlib.sha256(part.encode())
            else:
                sha.update(b"," + part.encode())
        yield pd.DataFrame(out, columns=["name", "ends_sha256"])
    if sha is not None:
        yield pd.DataFrame([(name, sha.hexdigest())], columns=["name", "ends_sha256"])


def _ends(segments: DataFrame, part: int) -> DataFrame:
    """Digest of the ids that end in each node. Ids are dealt out by ranges, so
    the ids of one node are joined into parts by several tasks; its parts then
    stream through one, as a digest must."""
    ended = segments.where("ends").select(F.when(F.size("names") > 0, F.element_at(F.col("names"), -1)).otherwise(F.lit(b"")).alias("name"), "conv_id")
    parts = ended.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id") \
        .mapInPandas(_parts(part), "name binary, first long, part string")
    return parts.repartition("name").sortWithinPartitions("name", "first").mapInPandas(_digests, "name binary, ends_sha256 string")


# -- the operator ------------------------------------------------------------

def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, local_turns: int = LOCAL_TURNS, band: int = BAND, part: int = PART
                ) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv_id, place, mark,
    size); ``conversations`` (conv_id) names members that may have no turn.

    Columns: conv_id (the least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves (of the subtree), saved_tokens (over the subtree: size
    of the last turn, once for each member but one), ends_sha256 (ids of the
    members that end here)."""
    rows = turns.select("conv_id", "place", "mark", "size")
    if conversations is not None:
        rows = rows.unionByName(conversations.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("mark"),
                                                     F.lit(0).cast("long").alias("size")))
    cut = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInPandas(_segments(band), SEGMENT)
    segments, held = materialize(cut, "trie-segments", partition_by=("band",))
    # a node needs a turn; conversations without any belong to the root only
    with_turns = segments.where(F.size("names") > 0)
    nodes, base = _nodes(with_turns, local_turns, band)
    every, path = materialize(nodes.unionByName(_root(nodes, segments.where(F.size("names") == 0))), "trie-nodes-all")
    ends, ends_path = materialize(_ends(segments, part), "trie-ends")
    # parents with many children are few: their children sum to the nodes
    many = max(1000, every.count() // BROADCAST_PARENTS)
    parents = every.select(F.col("name").alias("_p"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    big = F.broadcast(parents.where(F.col("n_children") > many).select("_p", F.col("parent_conv_id").alias("_big")))
    small = parents.where((F.col("n_children") > 0) & (F.col("n_children") <= many)).select("_p", F.col("parent_conv_id").alias("_small"))
    named = every.join(big, F.col("parent") == big["_p"], "left").drop("_p")
    # children of big parents find no partner: they needn't meet on their parent
    light = F.when(F.col("_big").isNull(), F.col("parent"))
    named = named.withColumn("_key", F.coalesce(light, F.concat(F.lit(b"-"), F.col("name"))))
    named = named.join(small, F.col("_key") == small["_p"], "left").drop("_p", "_key")
    out = named.join(ends.withColumnRenamed("name", "_e"), F.col("name") == F.col("_e"), "left").select(
        "conv_id", "depth", F.coalesce("_big", "_small").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    out, _ = materialize(out, "trie")
    for p in (held, base, path, ends_path):
        release(turns.sparkSession, p)
    return out


def block_trie(rows: DataFrame, block: int = 100, most: int = 6, **parameters) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) rebuilt with
    ``shared_openings``."""
    turns, path = materialize(ordered_turns(rows), "trie-turns")
    out = prefix_trie(*shared_openings(turns, block, most), **parameters)
    release(rows.sparkSession, path)
    return out
