import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.plans.storage import GoldStore, StageStore, create_tables
from tidemark.specs import ORDER_EVENTS as OE, default_registry

SF = "/root/testdata/sf0.001"


def test_stage_replay_is_idempotent(spark, tmp):
    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    store = StageStore(f"{tmp}/stage", OE)
    store.append(stage, "b1")
    store.append(stage, "b1")
    n = stage.count()
    assert store.read(spark).count() == n
    store.append(stage, "b2")  # a different batch is a real (duplicate) append
    assert store.read(spark).count() == 2 * n


def test_expire_and_read_time_retention(spark, tmp):
    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    store = StageStore(f"{tmp}/stage", OE)
    store.append(stage, "b1")
    kept = stage.filter("p_date > DATE'2024-01-23'").count()
    assert store.read(spark, fx.AS_OF).count() == kept
    gone = store.expire(spark, fx.AS_OF)
    assert "p_date=2024-01-23" in gone and "p_date=2024-01-24" not in gone
    assert store.read(spark).count() == kept


def test_gold_commit_pointer_and_failure(spark, tmp):
    gold, _ = fx.explicit_layers(fx.table(spark, SF, "events"))
    g = GoldStore(f"{tmp}/gold", OE)
    assert g.read(spark).count() == 0
    assert g.commit(spark, gold) == 1
    n = gold.count()
    bad = gold.withColumn(
        "record_id", F.expr("CASE WHEN record_id IS NOT NULL THEN raise_error('boom') END"))
    with pytest.raises(Exception):
        g.commit(spark, bad)
    assert g.current_version(spark) == 1 and g.read(spark).count() == n
    assert g.commit(spark, gold) == 2
    assert g.vacuum(spark, keep=1) == [1]
    assert g.read(spark).count() == n


def test_create_tables(spark, tmp):
    t = create_tables(spark, tmp, default_registry())
    rows = {(r["table"], r["kind"]) for r in t.collect()}
    assert ("STG_Order_Events", "stage") in rows and ("Order_Events", "gold") in rows
    assert GoldStore(f"{tmp}/gold/Order_Events", OE).current_version(spark) == 0


def test_catalog_gold_uses_row_level_merge(spark, tmp):
    """The catalog path issues Spark's MERGE; plain Parquet refuses it,
    which proves the call reaches the table format."""
    from tidemark.plans.storage import CatalogGoldStore

    spark.sql("DROP TABLE IF EXISTS tidemark_gold_probe")
    spark.createDataFrame([], OE.gold_schema()).write.format("parquet") \
        .option("path", f"{tmp}/probe").saveAsTable("tidemark_gold_probe")
    gold, _ = fx.explicit_layers(fx.table(spark, SF, "events"))
    with pytest.raises(Exception, match="MERGE"):
        CatalogGoldStore("tidemark_gold_probe", OE).upsert(gold)
    spark.sql("DROP TABLE IF EXISTS tidemark_gold_probe")


def test_append_stage_stream_and_read_layer(spark, tmp):
    from tidemark.sources.layers import read_layer
    from tidemark.streaming.ingest import append_stage_stream

    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    src = f"{tmp}/rows"
    stage.write.parquet(src)
    rows = spark.readStream.schema(stage.schema).parquet(src)
    q = append_stage_stream(rows, StageStore(f"{tmp}/stage", OE), f"{tmp}/ck", available_now=True)
    q.awaitTermination()
    assert read_layer(spark, f"{tmp}/stage", OE).count() == stage.count()


def _gold_rows(spark, n, start=0, stamp="2024-01-01 00:00:00"):
    cols = {"record_id": F.format_string("k%06d", F.col("id")), "ingestion_timestamp": F.lit(stamp).cast("timestamp"),
            "source_file": F.lit("f")}
    return spark.range(start, start + n).select(*(
        cols.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in OE.gold_schema().fields))


def test_upsert_rewrites_only_touched_files(spark, tmp):
    g = GoldStore(f"{tmp}/gold", OE)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        g.commit(spark, _gold_rows(spark, 4000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = set(g.files(spark, 1))
    assert len(before) >= 4
    new = _gold_rows(spark, 40, 100, "2024-01-02 00:00:00").unionByName(_gold_rows(spark, 5, 9000)).cache()
    for broadcast in (True, False):
        done = g.upsert(spark, new, broadcast, tmp)
    assert done["changed"] == 0 and done["version"] == 2  # the second found nothing to do
    after = set(g.files(spark, 2))
    assert len(before - after) < len(before) / 2 and before & after
    rows = g.read(spark)
    assert rows.count() == 4005 and rows.where("ingestion_timestamp > '2024-01-01'").count() == 40
    assert g.read(spark, 1).where("ingestion_timestamp > '2024-01-01'").count() == 0
    assert g.vacuum(spark, keep=1) == [1] and g.read(spark).count() == 4005


def test_two_writers_lose_no_update(spark, tmp):
    """Merges that start from one version: the second is done again."""
    from concurrent.futures import ThreadPoolExecutor

    g = GoldStore(f"{tmp}/gold", OE)
    g.commit(spark, _gold_rows(spark, 100))
    parts = [_gold_rows(spark, 60, 30 * k, f"2024-01-0{k + 2} 00:00:00") for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda p: GoldStore(f"{tmp}/gold", OE).upsert(spark, p, True, tmp)["version"], parts))
    assert sorted(versions) == [2, 3, 4, 5]
    got = {r[0]: r[1].day for r in g.read(spark).select("record_id", "ingestion_timestamp").collect()}
    want = {f"k{i:06d}": 1 for i in range(100)}
    for k in range(4):
        want.update({f"k{i:06d}": k + 2 for i in range(30 * k, 30 * k + 60)})
    assert got == want


def test_appends_see_each_other(spark, tmp):
    g = GoldStore(f"{tmp}/gold", OE)
    g.commit(spark, _gold_rows(spark, 10))
    calls = []

    def fresh(gold):
        if not calls:  # another writer inserts the same rows meanwhile
            GoldStore(f"{tmp}/gold", OE).append(spark, _gold_rows(spark, 5, 10))
        calls.append(1)
        return _gold_rows(spark, 8, 8).join(gold.select("record_id"), "record_id", "left_anti")

    assert g.append(spark, fresh) == 3 and len(calls) == 2
    assert g.read(spark).count() == g.read(spark).select("record_id").distinct().count() == 16


def test_compact_closed_dates(spark, tmp):
    from tidemark.plans.storage import list_dirs

    _, stage = fx.explicit_layers(fx.table(spark, SF, "events"))
    store = StageStore(f"{tmp}/stage", OE)
    for k in range(3):
        store.append(stage.where(f"cast(order_ref AS long) % 3 = {k}").where("p_date >= DATE'2024-01-28'"), f"b{k}")
    rows = sorted(map(tuple, store.read(spark).collect()), key=repr)
    done = store.compact(spark, "2024-01-30", min_batches=3)
    assert done == ["p_date=2024-01-28", "p_date=2024-01-29"]
    assert len(list_dirs(spark, f"{tmp}/stage/p_date=2024-01-29")) == 1
    assert len(list_dirs(spark, f"{tmp}/stage/p_date=2024-01-30")) == 3  # still open
    assert sorted(map(tuple, store.read(spark).collect()), key=repr) == rows
    assert store.compact(spark, "2024-01-30", min_batches=3) == []


def test_working_copies_go_but_for_the_kept(spark):
    import os

    from tidemark.session import materialize, working_copies

    df = spark.range(5)
    with working_copies(spark) as outer:
        _, first = materialize(df, "first")
        with working_copies(spark) as inner:
            _, dropped = materialize(df, "dropped")
            result, passed = materialize(df, "passed")
            inner.add(passed)
        assert os.path.exists(first) and not os.path.exists(dropped)
        assert result.count() == 5
        outer.add(first)
    assert os.path.exists(first) and not os.path.exists(passed)
    _, alone = materialize(df, "alone")
    assert os.path.exists(alone)
