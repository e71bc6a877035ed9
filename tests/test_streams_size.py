"""What the streams and sinks read, shuffle and write once: messages, batches, folds."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerlake.fixtures import messages as made
from ledgerlake.operators import lifecycle, upsert
from ledgerlake.operators.dedup import dedup_history
from ledgerlake.plans import stages
from ledgerlake.schemas import K3
from ledgerlake.session import open_writers, work_dir
from ledgerlake.streaming import jobs
from ledgerlake.streaming.keyed import KeyedLog, read_metrics
from ledgerlake.streaming.store import FoldedStore


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return stages.raw_events(spark, sf_small)


@pytest.fixture(scope="module")
def written(spark, raw):
    """Message files in three chunks of any order of keys, and the chunk of a delivery."""
    path = f"{work_dir(spark, 'msgs')}/in"
    chunk = F.pmod(F.xxhash64("event_id", "copy_no"), F.lit(3))
    made.write_message_files(raw, path, chunk, 3, 4)
    return path, chunk


def test_messages_are_made_in_one_job_and_come_chunk_by_chunk(spark, raw, written, monkeypatch):
    path, chunk = written
    calls, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, p, **k: calls.append(p) or text(self, p, **k))
    again = f"{work_dir(spark, 'once')}/in"
    made.write_message_files(raw, again, chunk, 3, 4)
    assert calls == [again]
    assert spark.read.text(path).count() == raw.count()
    seen = []
    jobs.message_stream(spark, path, 4).withColumn("c", chunk).writeStream.trigger(availableNow=True).option(
        "checkpointLocation", f"{path}-ck").foreachBatch(
        lambda b, i: seen.append((i, b.columns, [r["c"] for r in b.select("c").distinct().collect()]))).start().awaitTermination()
    assert [(i, c) for i, _, c in seen] == [(0, [0]), (1, [1]), (2, [2])]
    assert made.CHUNK not in seen[0][1]


def test_chunks_outside_the_range_and_without_number_are_left_out(spark, raw):
    path = f"{work_dir(spark, 'range')}/in"
    made.write_message_files(raw, path, F.when(F.col("ord") == 1, 0).when(F.col("ord") == 2, 7), 2, 3)
    assert spark.read.text(path).count() == raw.where("ord = 1").count()


def test_open_writers_gives_the_setting_back(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), open_writers(spark, 5):
        assert spark.conf.get(key) == "5"
        raise ValueError
    assert spark.conf.get(key) == before


def test_a_late_split_reads_its_batch_once(spark, written, sf_small, monkeypatch):
    path, _ = written
    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: plans.append(
        self._df._jdf.queryExecution().optimizedPlan().toString()) or parquet(self, *a, **k))
    out = work_dir(spark, "late")
    jobs.start_late_split_stream(jobs.message_stream(spark, path, 4), f"{out}/rows", f"{out}/ck", 86400).awaitTermination()
    assert len(plans) == 3 and not any("Union" in p for p in plans)
    monkeypatch.undo()
    on_time, late = lifecycle.split_late(stages.events(spark, sf_small), 86400)
    got = spark.read.parquet(f"{out}/rows").select("_table", "event_id", "copy_no")
    assert _rows(got) == sorted(_rows(on_time.select(F.lit("on_time"), "event_id", "copy_no"))
                                + _rows(late.select(F.lit("late"), "event_id", "copy_no")), key=repr)


def test_a_batch_of_the_dedup_stream_is_folded_once(spark, written, sf_small, monkeypatch):
    path, _ = written
    asked, holding = [], KeyedLog.holding
    monkeypatch.setattr(KeyedLog, "holding", lambda self, keys, before: asked.append(keys.inputFiles()) or holding(self, keys, before))
    out = work_dir(spark, "folded")
    jobs.start_dedup_stream(jobs.message_stream(spark, path, 4), f"{out}/log", f"{out}/ck").awaitTermination()
    assert len(asked) == 2 and all(f and all("/_folded/" in x for x in f) for f in asked)   # not from the messages
    evs = stages.events(spark, sf_small)
    assert _rows(spark.read.parquet(f"{out}/log").select(*K3)) == _rows(dedup_history(evs, columns=[]).select(*K3))
    attempted, applied, no_ops = read_metrics(spark, f"{out}/log").first()
    assert attempted == evs.count() and applied + no_ops == attempted and applied == evs.select(*K3).distinct().count()


def test_a_fold_carries_the_arrival_once(spark, sf_small):
    evs = stages.events(spark, sf_small)
    plan = upsert.fold_events(evs, "users", keep_seq=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "max_by" not in plan


def test_a_store_keeps_only_columns_that_its_tables_take(spark, sf_small, monkeypatch):
    evs = stages.events(spark, sf_small)
    frame, kept = type(evs), []
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or persist(self, *a))
    store = FoldedStore(spark, work_dir(spark, "slim"))
    store.apply_events(evs, 0)
    assert len(kept) == 1 and "original_transaction_timestamp" not in kept[0] and "country" not in kept[0]
    for t in ("payment_intents", "refunds", "payment_status_history", "merchants"):
        assert _rows(store.read(t)) == _rows(upsert.fold_events(evs, t)), t


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_log_rows_of_a_span_are_the_log_cut_afterwards(spark, raw):
    """Cuts inside transactions, also with deliveries of no time; what a cut drops is not shuffled."""
    raw = raw.withColumn("ingestion_timestamp", F.when(F.pmod(F.xxhash64("event_id", "copy_no"), F.lit(7)) != 0,
                                                       F.col("ingestion_timestamp")))
    log, at = stages.status_log(raw), F.col("ingestion_timestamp")
    for cut in ("1995-06-01 12:00:00", "1998-06-01 00:00:00"):
        bound = F.lit(cut).cast("timestamp")
        assert _rows(stages.status_log(raw, since=cut).select(*log.columns)) == _rows(log.where(at >= bound))
        assert _rows(stages.status_log(raw, until=cut).select(*log.columns)) == _rows(log.where(at < bound))
    plan = _plan(stages.status_log(raw, ["status", "ingestion_timestamp"], until="1998-06-01 00:00:00"))
    assert "1998-06-01" in plan[plan.index("Aggregate"):]


def test_first_deliveries_of_unknown_and_missing_types(spark):
    fields = ["transaction_id", "idempotency_key", "event_type", "status", "event_id", "ingestion_timestamp", "ord", "copy_no"]
    rows = [("t", "k", None, "a", "e1", "2020-01-02T00:00:00+00:00", 1, 0), ("t", "k", None, "b", "e2", "2020-01-01T00:00:00+00:00", 1, 0),
            ("t", "k", "odd", "c", "e3", None, 1, 0), ("t", "k", "odd", "d", "e4", "2020-01-01T00:00:00+00:00", 1, 0),
            ("t", "k", "capture_succeeded", "e", "e5", "2020-01-01T00:00:00+00:00", 3, 1),
            ("t", "k", "capture_succeeded", "f", "e6", "2020-01-01T00:00:00+00:00", 3, 0),
            (None, "k", "capture_succeeded", "g", "e7", "x", 3, 0), (None, "k", "capture_succeeded", "h", "e8", "x", 3, 0),
            ("t", None, "refund_recorded", "i", "e9", "2020-01-01T00:00:00+00:00", 4, 0)]
    kinds = "string, ".join(f"{f} " for f in fields[:6]) + "string, ord int, copy_no int"
    first = stages.first_raw(spark.createDataFrame(rows, kinds), ["status", "ingestion_timestamp"])
    assert _rows(first.select(*K3, "status")) == sorted(
        [("t", "k", None, "b"), ("t", "k", "odd", "c"), ("t", "k", "capture_succeeded", "f"),
         (None, "k", "capture_succeeded", "g"), ("t", None, "refund_recorded", "i")], key=repr)


def test_deliveries_of_a_transaction_travel_in_one_row(spark, raw):
    plan = _plan(stages.status_log(raw))
    least = plan[plan.index("Aggregate"):]
    assert "Aggregate [transaction_id" in least and "Generate inline" in plan


def test_folded_tables_equal_the_folds_of_normalised_events(spark, sf_small):
    want = stages.entity_tables(stages.events(spark, sf_small))
    root = work_dir(spark, "folded-tables")
    got = stages.folded_tables(spark, sf_small, root)
    assert list(got) == list(want)
    for name, df in want.items():
        assert got[name].columns == df.columns and _rows(got[name]) == _rows(df), name
    assert "payload" not in spark.read.parquet(f"{root}/events").columns


def test_the_report_reads_tables_that_are_not_written(spark, sf_small, monkeypatch):
    from ledgerlake.plans.catalog_io import c12_constraint_report
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, p, *a, **k: written.append(p) or parquet(self, p, *a, **k))
    assert c12_constraint_report(spark, sf_small).count() == 108
    assert [p.rsplit("/", 1)[1] for p in written] == ["events"]


def test_a_wide_batch_is_folded_with_the_log_s_keys(spark, sf_small, monkeypatch):
    """A4 over three batches with null keys: no join of rows, no row that the log has, the same rows as a fold of all."""
    evs = stages.events(spark, sf_small, encode=False).drop("order_key").withColumn(
        "idempotency_key", F.when(F.col("ord") != 2, F.col("idempotency_key")))
    evs = stages.materialise_events(evs, f"{work_dir(spark, 'a4')}/events")
    path = f"{work_dir(spark, 'a4')}/log"
    plans, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, p, *a, **k: plans.append((p, _plan(self._df))) or parquet(self, p, *a, **k))
    part = F.pmod(F.xxhash64("event_id", "copy_no"), F.lit(3))
    for i in range(3):
        again = evs.where(part < i).withColumn("status", F.lit("changed"))
        jobs.append_status_history(evs.where(part == i).unionByName(again), path, i)
    monkeypatch.undo()
    rows = [p for at, p in plans if at.endswith(("/batch=0", "/batch=1", "/batch=2"))]
    assert len(rows) == 3 and not any("Join" in p or "Repartition" in p or "Rebalance" in p for p in rows)
    assert not any("/_folded/" in at for at, _ in plans)
    log = spark.read.parquet(path)
    first = {tuple(r): 0 for r in log.where("batch = 0").select(*K3).collect()}
    assert len(first) == evs.where(part == 0).select(*K3).distinct().count()
    assert log.count() == log.select(*K3).distinct().count() == evs.select(*K3).distinct().count()
    assert log.where("status = 'changed'").count() == 0
    attempted, applied, _ = read_metrics(spark, path).first()
    assert applied == log.count() and attempted > evs.count()
