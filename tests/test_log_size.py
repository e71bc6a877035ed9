"""What the derived log costs at size: rows a task, files a batch, payloads made from the rows that stay."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.fixtures import messages as made
from ledgerlake.operators import upsert
from ledgerlake.plans import stages
from ledgerlake.session import work_dir
from ledgerlake.streaming import jobs


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    return stages.raw_events(spark, sf_small)


def test_tasks_of_the_log_grow_with_the_orders(spark, sf_small, monkeypatch):
    monkeypatch.setattr(stages, "ORDERS_PER_TASK", 50)
    tasks = stages.log_tasks(spark, sf_small)
    orders = spark.read.parquet(f"{sf_small}/orders.parquet").count()
    assert tasks == -(-orders // 50) > spark.sparkContext.defaultParallelism
    seen = stages.raw_events(spark, sf_small).select("order_key", F.spark_partition_id().alias("p")).groupBy("p").agg(
        F.count_distinct("order_key").alias("n"))
    assert seen.agg(F.max("n")).first()[0] <= 60


def test_log_and_landing_rows_of_raw_deliveries(spark, raw, sf_small):
    events = stages.events(spark, sf_small)
    log = stages.status_history(events)
    assert _rows(stages.status_log(raw).select(*log.columns)) == _rows(log)
    some = ["transaction_id", "event_id", "event_type", "ingestion_timestamp"]
    assert _rows(stages.status_log(raw, ["ingestion_timestamp"]).select(*some)) == _rows(log.select(*some))
    land = jobs.land_raw(events)
    assert _rows(stages.landed(raw).select(*land.columns)) == _rows(land)
    assert _rows(stages.landed(raw, []).select("event_id", "event_type")) == _rows(land.select("event_id", "event_type"))


def test_payload_text_is_made_behind_the_shuffle(raw):
    """The encoding stands above the aggregation, so no task sorts or shuffles the text."""
    plan = stages.status_log(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("to_json" if "to_json" in plan else "StructsToJson") < plan.index("Aggregate")
    assert "to_json" not in plan[plan.index("Aggregate"):]


def test_struct_payloads_fold_to_the_same_tables(spark, sf_small):
    text = stages.entity_tables(stages.events(spark, sf_small))
    struct = stages.entity_tables(stages.events(spark, sf_small, encode=False))
    for name in ("refunds", "payment_status_history", "raw_payment_events"):
        assert _rows(struct[name]) == _rows(text[name]), name


@pytest.mark.parametrize("by", ["ids", "transaction", "event_time"])
def test_log_made_behind_the_split(spark, raw, by):
    root = work_dir(spark, "split")
    jobs.write_status_log(stages.status_log(raw), f"{root}/a", by)
    jobs.write_status_log(stages.first_raw(raw), f"{root}/b", by, make=stages.log_rows)
    a, b = spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")
    assert _rows(b.select(*a.columns)) == _rows(a)


def test_a_chunk_is_a_batch_however_few_rows_it_has(spark, raw):
    path = f"{work_dir(spark, 'few')}/in"
    few = raw.where("order_key in (1, 2, 3)")
    made.write_message_files(few, path, F.when(F.col("ord") == 1, 0).otherwise(2), 3, 6)
    files = spark.read.text(path).inputFiles()
    assert len(files) == 18 and all(f.endswith(".gz") for f in files)
    seen = []
    jobs.message_stream(spark, path, 6).writeStream.trigger(availableNow=True).option(
        "checkpointLocation", f"{path}-ck").foreachBatch(
        lambda b, i: seen.append((i, b.count()))).start().awaitTermination()
    first = few.where("ord = 1").count()
    assert seen == [(0, first), (1, 0), (2, few.count() - first)]


def test_a_store_of_one_table_keeps_no_copy_of_its_batch(spark, sf_small, monkeypatch):
    from pyspark.sql import DataFrame
    from ledgerlake.streaming.store import FoldedStore
    calls = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: calls.append(self) or self)
    events = stages.events(spark, sf_small)
    store = FoldedStore(spark, work_dir(spark, "one"), ["payment_intents"])
    store.apply_events(events, 0)
    assert not calls
    assert _rows(store.read("payment_intents")) == _rows(upsert.fold_events(events, "payment_intents"))
