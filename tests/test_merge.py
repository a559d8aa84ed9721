import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_by_key
from tidemark.operators.merge import (
    ACTION, GOLD_ONLY, INSERT, KEEP_MATCHED, UPDATE, merge_insert_only, merge_plan,
)
from tidemark.operators.quality import key_gate

SCHEMA = "record_id string, status string, ingestion_timestamp timestamp"
COLS = ["record_id", "status", "ingestion_timestamp"]
T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


def plan(spark, gold, src, strategy):
    g = spark.createDataFrame([(k, s, ts(h)) for k, s, h in gold], SCHEMA)
    s = spark.createDataFrame([(k, v, ts(h)) for k, v, h in src], SCHEMA)
    return merge_plan(g, s, "record_id", "ingestion_timestamp", COLS, strategy)


def rows(df):
    return sorted((r["record_id"], r["status"], r[ACTION]) for r in df.collect())


GOLD = [("a", "g", 1), ("b", "g", 5), ("c", "g", 3), ("d", "g", None), ("e", "g", 2)]
SRC = [("a", "s", 2), ("b", "s", 4), ("c", "s", 3), ("d", "s", 9), ("f", "s", 1)]
EXPECTED = [
    ("a", "s", UPDATE),          # newer
    ("b", "g", KEEP_MATCHED),    # older
    ("c", "g", KEEP_MATCHED),    # equal: strict comparison keeps gold
    ("d", "g", KEEP_MATCHED),    # NULL on one side: no update
    ("e", "g", GOLD_ONLY),
    ("f", "s", INSERT),
]


def test_merge_branches_shuffle(spark):
    assert rows(plan(spark, GOLD, SRC, "shuffle")) == EXPECTED


def test_merge_branches_broadcast(spark):
    assert rows(plan(spark, GOLD, SRC, "broadcast")) == EXPECTED


def test_broadcast_plan_never_shuffles_gold(spark):
    p = plan(spark, GOLD, SRC, "broadcast")
    text = p._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


def test_key_gate_routes_null_keys(spark):
    df = spark.createDataFrame([("a", "x", T0), (None, "y", T0)], SCHEMA)
    ok, bad = key_gate(df, "record_id")
    assert ok.count() == 1
    assert bad.collect()[0]["error"] == "missing key: record_id is NULL"


def test_insert_only_merge(spark):
    g = spark.createDataFrame([('{"a":1}', "f1", T0)], "payload string, source_file string, "
                              "ingestion_timestamp timestamp").withColumn("_identity", F.col("payload"))
    s = spark.createDataFrame([('{"a":1}', "f2", ts(5)), ('{"b":2}', "f3", ts(6))],
                              "payload string, source_file string, ingestion_timestamp timestamp"
                              ).withColumn("_identity", F.col("payload"))
    now = dt.datetime(2024, 2, 1)
    for strategy in ("broadcast", "shuffle"):
        out = merge_insert_only(g, s, "_identity", ["payload", "source_file", "ingestion_timestamp"],
                                now, strategy=strategy).collect()
        assert [(r["payload"], r["_last_updated"]) for r in out] == [('{"b":2}', now)]


keys = st.sampled_from(list("abcdefgh"))
hours = st.one_of(st.none(), st.integers(0, 6))
row = st.tuples(keys, st.sampled_from(["x", "y", "z"]), hours)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(gold=st.lists(row, max_size=8, unique_by=lambda r: r[0]), stage=st.lists(row, max_size=12))
def test_merge_properties(spark, gold, stage):
    g = spark.createDataFrame([(k, v, ts(h)) for k, v, h in gold], SCHEMA)
    st_df = spark.createDataFrame([(k, v, ts(h)) for k, v, h in stage], SCHEMA)
    src = latest_by_key(st_df, "record_id", "ingestion_timestamp", ["status"])
    once = merge_plan(g, src, "record_id", "ingestion_timestamp", COLS, "shuffle").drop(ACTION)
    once_b = merge_plan(g, src, "record_id", "ingestion_timestamp", COLS, "broadcast").drop(ACTION)
    twice = merge_plan(once, src, "record_id", "ingestion_timestamp", COLS, "shuffle").drop(ACTION)
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in once_b.collect())
    assert a == sorted(tuple(r) for r in twice.collect())            # idempotent
    ks = [r[0] for r in a]
    assert len(ks) == len(set(ks))                                   # one row per key
    before = {k: ts(h) for k, _, h in gold}
    after = {r[0]: r[2] for r in a}
    for k, t in before.items():                                      # never goes back in time
        if t is not None:
            assert after[k] is not None and after[k] >= t


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_merging_slices_in_order_equals_merging_once(spark, data):
    n_g = data.draw(st.integers(0, 5))
    n_s = data.draw(st.integers(1, 10))
    hours_all = data.draw(st.lists(st.integers(0, 500), min_size=n_g + n_s, max_size=n_g + n_s,
                                   unique=True))
    gkeys = data.draw(st.lists(st.sampled_from(list("abcdefgh")), min_size=n_g, max_size=n_g,
                               unique=True))
    skeys = data.draw(st.lists(st.sampled_from(list("abcdefgh")), min_size=n_s, max_size=n_s))
    cut = data.draw(st.integers(0, n_s))
    gold = [(k, "g", h) for k, h in zip(gkeys, hours_all[:n_g])]
    stage = [(k, f"s{i}", h) for i, (k, h) in enumerate(zip(skeys, hours_all[n_g:]))]

    def df(rows):
        return spark.createDataFrame([(k, v, ts(h)) for k, v, h in rows], SCHEMA)

    def merge(g, s):
        src = latest_by_key(s, "record_id", "ingestion_timestamp", ["status"])
        return merge_plan(g, src, "record_id", "ingestion_timestamp", COLS, "shuffle").drop(ACTION)

    once = merge(df(gold), df(stage))
    sliced = merge(merge(df(gold), df(stage[:cut])), df(stage[cut:]))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, sliced.collect()))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_view_equals_merge_on_unique_times(spark, data):
    from tidemark.operators.views import unified_view
    from tidemark.specs import FolderSpec

    spec = FolderSpec(folder="F", stage_table="S", gold_table="G", key="record_id",
                      columns=(("record_id", "STRING"), ("status", "STRING")), view_days=1)
    n_g = data.draw(st.integers(0, 5))
    n_s = data.draw(st.integers(0, 8))
    hours_all = data.draw(st.lists(st.integers(0, 40), min_size=n_g + n_s, max_size=n_g + n_s,
                                   unique=True))
    gkeys = data.draw(st.lists(st.sampled_from(list("abcdef")), min_size=n_g, max_size=n_g,
                               unique=True))
    skeys = data.draw(st.lists(st.sampled_from(list("abcdef")), min_size=n_s, max_size=n_s))
    schema = "record_id string, status string, source_file string, ingestion_timestamp timestamp"
    g = spark.createDataFrame([(k, "g", "f", ts(h)) for k, h in zip(gkeys, hours_all[:n_g])], schema)
    s = spark.createDataFrame([(k, f"s{i}", "f", ts(h), ts(h).date())
                               for i, (k, h) in enumerate(zip(skeys, hours_all[n_g:]))],
                              schema + ", p_date date")
    as_of = T0.date()  # window of 1 day before T0: every stage row (no upper bound)
    view = unified_view(spec, g, s, as_of, strategy="window")
    src = latest_by_key(s, "record_id", "ingestion_timestamp", ["source_file", "status"])
    merged = merge_plan(g, src, "record_id", "ingestion_timestamp", spec.row_columns, "shuffle")
    a = sorted(map(tuple, view.collect()))
    b = sorted(map(tuple, merged.select(*spec.business_columns).collect()))
    assert a == b
