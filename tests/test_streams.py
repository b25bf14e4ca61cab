"""Spool streams: crashes between steps, replays, broken documents, late runs and retention."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from plumbline.operators import quality
from plumbline.plans import spool
from plumbline.sources import sinks
from plumbline.sources.versions import Store
from plumbline.streaming import ingest

QUOTE = "quote_id long, source string, carrier string, route_id int, apd int, fare_class string, collection_ts timestamp, total_fare string, run_id string"


def document(run, day, status="succeeded", source="s", **more):
    return {"run_id": run, "source": source, "started_at": f"{day}T06:00:00Z", "status": status, "quotes": [], **more}


def put(folder, name, *docs):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs) + "\n")


def ingest_all(spark, tmp_path, mark="mark", **options):
    store = Store(spark, str(tmp_path / "store"))
    q = ingest.ingest_spool(spark, str(tmp_path / "spool"), store, str(tmp_path / mark), **options)
    q.awaitTermination()
    return store, q


def test_stream_equals_batch_and_replay_adds_nothing(spark, tmp_path):
    q = spark.createDataFrame([(i, "s", "c", i % 5, 7, None, dt.datetime(2026, 9, 1 + i % 9, 5), f"{100 + i}.50", f"run{i % 4}") for i in range(60)], QUOTE)
    spool.write_spool(q, str(tmp_path / "spool"))
    for mark in ("m1", "m2"):  # a lost checkpoint replays everything
        store, _ = ingest_all(spark, tmp_path, mark)
    docs = ingest.read_spool(spark, str(tmp_path / "spool"))
    want = quality.keep_earliest(ingest.spooled_quotes(docs), ingest.KEYS, ["started_at", "quote_id"])
    assert sorted(r.quote_id for r in store.read("quotes", ingest.QUOTES).collect()) == sorted(r.quote_id for r in want.collect())
    assert sorted(r.run_id for r in store.read("runs", ingest.RUNS).collect()) == ["run0", "run1", "run2", "run3"]


def test_a_crash_between_tables_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    q = spark.createDataFrame([(i, "s", "c", i, 7, None, dt.datetime(2026, 9, 1, 5), "9.50", f"run{i % 3}") for i in range(12)], QUOTE)
    spool.write_spool(q, str(tmp_path / "spool"))
    plain, calls = Store._written, []

    def dies(self, name, change, write):
        calls.append(name)
        if name == "quotes":
            raise RuntimeError("the driver is gone")
        return plain(self, name, change, write)

    with monkeypatch.context() as m:
        m.setattr(Store, "_written", dies)
        with pytest.raises(Exception, match="the driver is gone"):
            ingest_all(spark, tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    assert calls == ["runs", "quotes"] and store.version() == 0 and store.read("runs", ingest.RUNS).count() == 0
    store, _ = ingest_all(spark, tmp_path)  # the same checkpoint
    assert store.read("runs", ingest.RUNS).count() == 3 and store.read("quotes", ingest.QUOTES).count() == 12
    docs = ingest.read_spool(spark, str(tmp_path / "spool"))
    assert ingest.land_batch(store, docs, ingest.stream_name(str(tmp_path / "mark")), 0) is None  # landed, but the checkpoint did not know


def test_broken_documents_are_kept_with_file_and_reason(spark, tmp_path):
    whole = json.dumps(document("a", "2026-09-01"))
    put(tmp_path / "spool", "1.json", whole, whole[:-9], {**document("b", "2026-09-01"), "quotes": None}, {**document("c", "soon")}, document("d", "2026-09-02", notes="fine"))
    put(tmp_path / "spool", "2.json", "")
    store, _ = ingest_all(spark, tmp_path)
    assert sorted(r.run_id for r in store.read("runs", ingest.RUNS).collect()) == ["a", "d"]
    rejects = {(r.reason, os.path.basename(r.file)): r.text for r in store.read("rejects", ingest.REJECTS).collect()}
    texts = [r.text for r in store.read("rejects", ingest.REJECTS).collect()]
    assert whole[:-9] in texts and len(texts) == 3 and {f for _, f in rejects} == {"1.json"}
    assert json.loads(rejects["lacks quotes", "1.json"])["run_id"] == "b"
    ingest_all(spark, tmp_path, "again")
    assert store.read("rejects", ingest.REJECTS).count() == 3


def test_late_runs_are_reported_as_the_watermark_drops_them(spark, tmp_path):
    put(tmp_path / "spool", "1.json", *[document(f"n{k}", f"2026-09-{k:02}") for k in range(18, 29)])
    store, _ = ingest_all(spark, tmp_path)
    late = [document(f"l{k}", f"2026-09-{k:02}", "failed", f"s{k}") for k in range(8, 21)]
    put(tmp_path / "spool", "2.json", *late)
    ingest_all(spark, tmp_path)
    got = {r.run_id: r for r in store.read("late", ingest.LATE).collect()}
    assert sorted(got) == ["l10", "l11", "l12", "l13", "l8", "l9"] and {r.watermark for r in got.values()} == {dt.datetime(2026, 9, 14, 6)}
    # Spark's own watermark drops as many (one group a run); it lags by a batch, so one more batch lies before the late one
    put(tmp_path / "own", "1.json", *[document(f"n{k}", f"2026-09-{k:02}") for k in range(18, 29)])
    os.utime(tmp_path / "own" / "1.json", (1, 1))
    put(tmp_path / "own", "2.json", document("n", "2026-09-27"))
    os.utime(tmp_path / "own" / "2.json", (2, 2))
    put(tmp_path / "own", "3.json", *late)
    docs = spark.readStream.option("maxFilesPerTrigger", "1").schema("source string, started_at timestamp, status string").json(str(tmp_path / "own"))
    q = ingest.daily_yield(docs).writeStream.outputMode("update").format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"]) == len(got)
    assert q.recentProgress[-1]["eventTime"]["watermark"] == "2026-09-14T06:00:00.000Z"
    want = ingest.daily_yield(store.read("runs", ingest.RUNS))
    key = lambda df: sorted(tuple(r) for r in df.select("day", "source", "n_runs", "n_done").collect())
    assert key(store.read("yield", ingest.YIELD)) == key(want) and want.count() == 11 + 13


def test_retention_takes_sent_records_only(spark, tmp_path):
    folder, archive = tmp_path / "spool", tmp_path / "archive"
    for k in (1, 2, 20, 28):
        put(folder, f"{k:02}.json", document(f"r{k}", f"2026-09-{k:02}"))
    put(folder, "mixed.json", document("r3", "2026-09-03"), document("r27", "2026-09-27"))
    store, _ = ingest_all(spark, tmp_path, per_batch=1, archive=str(archive))
    put(folder, "pending.json", document("old", "2026-08-01"))
    assert ingest.retain(store, [str(archive)], "2026-09-30") == 2
    names = {f for top in (folder, archive) for _, _, fs in os.walk(top) for f in fs if f.endswith(".json")}
    assert names == {"20.json", "28.json", "mixed.json", "pending.json"}
    assert sorted(r.run_id for r in store.read("sent", ingest.SENT).collect()) == ["r20", "r27", "r28"]
    assert store.read("runs", ingest.RUNS).count() == 6  # the warehouse keeps what it has
    assert ingest.retain(store, [str(archive)], "2026-09-30") == 0


def test_payloads_land_once_and_only_their_prefixes_are_read(spark, tmp_path):
    for i in range(40):
        put(tmp_path / "in" / str(i % 3), f"{i}.html", f"page {i % 30}")
    files, path = sinks.read_payloads(spark, str(tmp_path / "in")), str(tmp_path / "landing")
    assert sinks.land_payloads(files, path) == 30 and sinks.land_payloads(files, path) == 0
    new = spark.createDataFrame([("ab" * 32, b"x", "ab")], "hash string, content binary, prefix string")
    plan = sinks.stored_hashes(new, path)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(prefix" in plan and "ReadSchema: struct<hash:string>" in plan
