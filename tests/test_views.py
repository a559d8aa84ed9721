import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.views import unified_view
from tidemark.specs import FolderSpec

SPEC = FolderSpec(folder="F", stage_table="STG_F", gold_table="F", key="record_id",
                  columns=(("record_id", "STRING"), ("status", "STRING")), view_days=2)
SCHEMA = "record_id string, status string, source_file string, ingestion_timestamp timestamp"
STAGE_SCHEMA = SCHEMA + ", p_date date"
T0 = dt.datetime(2024, 1, 28)

keys = st.one_of(st.none(), st.sampled_from(list("abcde")))
vals = st.one_of(st.none(), st.sampled_from(["x", "y"]))
files = st.sampled_from(["f1", "f2"])
hours = st.one_of(st.none(), st.integers(0, 60))


def ts(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(gold=st.lists(st.tuples(st.sampled_from(list("abcde")), vals, files, hours), max_size=6,
                     unique_by=lambda r: r[0]),
       stage=st.lists(st.tuples(keys, vals, files, hours), max_size=12))
def test_view_strategies_agree(spark, gold, stage):
    g = spark.createDataFrame([(k, v, f, ts(h)) for k, v, f, h in gold], SCHEMA)
    s = spark.createDataFrame(
        [(k, v, f, ts(h), (ts(h) or T0).date()) for k, v, f, h in stage], STAGE_SCHEMA)
    as_of = dt.date(2024, 1, 30)
    w = sorted(map(tuple, unified_view(SPEC, g, s, as_of, strategy="window").collect()),
               key=repr)
    a = sorted(map(tuple, unified_view(SPEC, g, s, as_of, strategy="auto").collect()), key=repr)
    b = sorted(map(tuple, unified_view(SPEC, g, s, as_of, strategy="broadcast").collect()),
               key=repr)
    assert w == b == a


def test_view_keeps_one_null_key_row(spark):
    g = spark.createDataFrame([("a", "x", "f1", T0)], SCHEMA)
    s = spark.createDataFrame([(None, "y", "f1", T0, T0.date()), (None, "z", "f2", T0, T0.date())],
                              STAGE_SCHEMA)
    out = unified_view(SPEC, g, s, dt.date(2024, 1, 29), strategy="window").collect()
    assert sorted(((r["record_id"], r["status"]) for r in out), key=repr) == \
        [("a", "x"), (None, "z")]


def test_registered_view_runs_no_job_and_follows_its_stage(spark, tmp):
    """Building the default view starts no job; the same view is right after
    its stage has grown tenfold."""
    g = spark.createDataFrame([("a", "gold", "f1", T0)], SCHEMA)
    g.write.parquet(f"{tmp}/gold")
    row = lambda k, n: (f"k{k}", f"v{n}", "f1", T0 + dt.timedelta(hours=n), dt.date(2024, 1, 29))
    spark.createDataFrame([row(k, 1) for k in range(20)], STAGE_SCHEMA).write.parquet(f"{tmp}/stage")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("view", "view")
    try:
        view = unified_view(SPEC, spark.read.schema(SCHEMA).parquet(f"{tmp}/gold"),
                            spark.read.schema(STAGE_SCHEMA).parquet(f"{tmp}/stage"), dt.date(2024, 1, 30))
        assert list(tracker.getJobIdsForGroup("view")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert view.count() == 21
    spark.createDataFrame([row(k, 2) for k in range(200)] + [("a", "new", "f1", T0 + dt.timedelta(hours=3), dt.date(2024, 1, 29))],
                          STAGE_SCHEMA).write.mode("append").parquet(f"{tmp}/stage")
    again = unified_view(SPEC, spark.read.schema(SCHEMA).parquet(f"{tmp}/gold"),
                         spark.read.schema(STAGE_SCHEMA).parquet(f"{tmp}/stage"), dt.date(2024, 1, 30))
    rows = {r["record_id"]: r["status"] for r in again.collect()}
    assert len(rows) == 201 and rows["a"] == "new" and all(rows[f"k{k}"] == "v2" for k in range(200))
