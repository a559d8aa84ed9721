from tidemark import fixtures as fx
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.views import stage_window
from tidemark.plans.storage import StageStore
from tidemark.specs import ORDER_EVENTS as OE

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_key_limits_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = latest_by_key(fx.table(spark, SF, "events"), "user_id", "ts", ["event_id"])
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("WindowGroupLimit") == 2  # partial (map side) + final
    assert "Partial" in text


def test_stage_window_prunes_partitions(spark, tmp):
    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    store = StageStore(f"{tmp}/stage", OE)
    store.append(stage, "b1")
    df = stage_window(store.read(spark), fx.AS_OF, 1, "p_date").select("record_id")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in text and "2024-01-29" in text
    assert "ReadSchema: struct<record_id:string>" in text  # column pruning


def test_no_python_in_merge_plan(spark):
    import __spark_entry__ as E

    df = E.queries()["merge_upsert_1d"](spark, SF)
    text = plan_text(df)
    assert "Python" not in text and "ArrowEval" not in text


def _shuffle_records(df):
    """Rows written by each shuffle of the executed (adaptive) plan."""
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    out = []

    def walk(node):
        if "ShuffleQueryStage" in node.nodeName():
            out.append(node.plan().metrics().get("shuffleRecordsWritten").get().value())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())

    walk(final)
    return out


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key holds 60% of the rows; each map task forwards one row for it."""
    from pyspark.sql import functions as F

    ev = fx.table(spark, "/root/testdata/sf0.01", "events")
    hot = ev.withColumn("k", F.when(F.col("event_type").isin("click", "view", "error"),
                                    F.lit(-1)).otherwise(F.col("user_id")))
    maps = hot.rdd.getNumPartitions()
    keys = hot.select("k").distinct().count()
    df = latest_by_key(hot, "k", "ts", ["event_id"])
    assert df.count() == keys
    written = _shuffle_records(df)
    assert written and max(written) <= maps * keys < hot.filter("k = -1").count()
