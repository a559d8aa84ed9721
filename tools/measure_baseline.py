"""
writing is excluded from every timing."""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return out, round(time.perf_counter() - t, 2)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidemark import fixtures as fx
    from tidemark.plans.jobs import PipelineConfig, decode_listing, hourly_merge, shape_folder
    from tidemark.session import build_session, work_dir
    from tidemark.sources.objects import list_objects
    from tidemark.specs import NOTIFICATION_EVENTS as PAY, ORDER_EVENTS as OE, default_registry
    from tidemark.streaming.ingest import stream_ingest

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    ev = fx.table(spark, sf, "events")
    base = work_dir(spark, "baseline")
    cfg = PipelineConfig(f"{base}/lake", f"{base}/objects", default_registry())
    written = fx.write_event_objects(ev, cfg.objects_root)
    n_files, n_rec = written.count(), ev.count()
    res = {"objects": n_files, "records": n_rec}

    def decode_shape():
        dec = decode_listing(list_objects(spark, cfg.objects_root, OE.folder, "2000-01-01"),
                             cfg.objects_root)
        rows, _, _ = shape_folder(dec, OE, fx.NOW, cache=False)
        rows.write.format("noop").mode("overwrite").save()

    decode_shape()  # warm-up
    _, t = timed(decode_shape)
    res["decode_shape_sec"] = t
    res["files_per_sec"] = round(n_files / t)
    res["records_per_sec"] = round(n_rec / t)

    now = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)
    q, t = timed(lambda: stream_ingest(spark, cfg, f"{base}/ckpt", available_now=True,
                                       now_fn=lambda: now).awaitTermination())
    res["stream_microbatch_sec_all_objects"] = t

    gold, stage = fx.explicit_layers(ev)
    cfg.gold(OE).commit(spark, gold)
    cfg.stage(OE).append(stage, "seed")
    pgold, pstage = fx.payload_layers(ev)
    cfg.gold(PAY).commit(spark, pgold)
    cfg.stage(PAY).append(pstage, "seed")
    out, t = timed(lambda: hourly_merge(spark, cfg, fx.AS_OF, now))
    res["hourly_merge_sec"] = t
    res["hourly_merge"] = out
    _, t = timed(lambda: cfg.stage(OE).read(spark).filter("p_date >= DATE'2024-01-28'")
                 .write.format("noop").mode("overwrite").save())
    res["stage_window_scan_sec"] = t
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
