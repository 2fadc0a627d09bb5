"""Streams: pinned dimensions, expectation counts, replay."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larchfield.operators.quality import expect_all, split_quarantine
from larchfield.plans.entities import CLAIMS
from larchfield.plans.fixtures import Lake
from larchfield.plans.registry import in_deliveries
from larchfield.streaming.facts import newest_version, publish_dim, stream_facts, write_facts
from larchfield.streaming.split import COUNTS, read_batches, split_stream

CLAIM = "claimid string, policyid string, incident_severity string, incident_date string, claim_processed_on string"


def land(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder))


def stream_of(spark, schema, folder):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(folder))


def with_names(batch, dims):
    return batch.join(dims["car"], "car_id", "left")


def test_facts_join_the_snapshot_of_their_batch(spark, rows, tmp_path):
    schema, car = "sales_id int, car_id int", "car_id int, name string"
    dims, target, checkpoint = {"car": f"{tmp_path}/car"}, f"{tmp_path}/facts", f"{tmp_path}/ck"
    publish_dim(spark.createDataFrame([(1, "old")], car), dims["car"], 0)
    land(spark, [(10, 1), (11, 2)], schema, tmp_path / "in/0")
    run = lambda: stream_facts(stream_of(spark, schema, tmp_path / "in"), dims, with_names, target, checkpoint)
    run().awaitTermination()
    publish_dim(spark.createDataFrame([(1, "new"), (2, "two")], car), dims["car"], 1)
    land(spark, [(20, 1), (21, 2)], schema, tmp_path / "in/1")
    run().awaitTermination()
    want = [(10, "old"), (11, None), (20, "new"), (21, "two")]
    assert rows(read_batches(spark, target), "sales_id", "name") == want
    # The first batch again, after the dimension has moved on: same snapshot, same rows.
    write_facts(spark.createDataFrame([(10, 1), (11, 2)], schema), 0, dims, with_names, target)
    assert rows(read_batches(spark, target), "sales_id", "name") == want
    assert newest_version(spark, dims["car"]) == 1


def test_unpublished_dimension_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no snapshot"):
        newest_version(spark, f"{tmp_path}/nothing")
    # A snapshot whose number was not made known yet is not read.
    spark.range(1).write.parquet(f"{tmp_path}/car/rows/version=7")
    with pytest.raises(ValueError, match="no snapshot"):
        newest_version(spark, f"{tmp_path}/car")


def claims(count, start):
    kinds = ["Major Damage", "odd", None]
    dates = ["2016-03-05", "27:00.0", "05-03-2016", "05-03-2016 14:10", None]
    return [
        (f"c{i}", None if i % 4 == 0 else "p", kinds[i % 3], dates[i % 5], "null" if i % 7 == 0 else "2016-04-01")
        for i in range(start, start + count)
    ]


def test_streamed_expectations_equal_the_batch_counts(spark, rows, tmp_path):
    paths = [f"{tmp_path}/{n}" for n in ("clean", "bad", "ck", "counts")]
    for delivery in range(2):
        land(spark, claims(40, 40 * delivery), CLAIM, tmp_path / f"in/{delivery}")
        split_stream(stream_of(spark, CLAIM, tmp_path / "in"), CLAIMS, *paths).awaitTermination()
    counts = read_batches(spark, paths[3], f"{COUNTS}, batch_id int", ids=True)
    want = []
    for delivery in range(2):
        frame = CLAIMS.prepare(spark.createDataFrame(claims(40, 40 * delivery), CLAIM))
        clean, bad = split_quarantine(frame, CLAIMS.rules)
        want += [(delivery, *r) for r in rows(expect_all(clean, CLAIMS.expectations), "rule_name", "failed_records", "total_records")]
        assert clean.count() + bad.count() == 40
    assert rows(counts, "batch_id", "rule_name", "failed_records", "total_records") == sorted(want, key=repr)
    assert read_batches(spark, paths[0]).count() + read_batches(spark, paths[1]).count() == 80


def test_streamed_text_is_parsed_like_a_batch(spark, rows, tmp_path):
    land(spark, claims(60, 0), CLAIM, tmp_path / "in/0")
    paths = [f"{tmp_path}/{n}" for n in ("clean", "bad", "ck")]
    split_stream(stream_of(spark, CLAIM, tmp_path / "in"), CLAIMS, *paths).awaitTermination()
    clean, bad = split_quarantine(CLAIMS.prepare(spark.createDataFrame(claims(60, 0), CLAIM)), CLAIMS.rules)
    shown = ["claimid", "incident_date", "claim_processed_on", "_is_corrupt_date"]
    assert rows(read_batches(spark, paths[0]), *shown) == rows(clean, *shown)
    assert rows(read_batches(spark, paths[1]), "claimid", "_reject_reason") == rows(bad, "claimid", "_reject_reason")
    day = read_batches(spark, paths[0]).where("claimid = 'c3'").select(F.col("incident_date").cast("timestamp_ntz")).first()[0]
    assert day == datetime(2016, 3, 5, 14, 10)


def test_deliveries_work_out_their_rows_once(spark, tmp_path):
    worked_out = spark.sparkContext.accumulator(0)

    def car(i):
        worked_out.add(1)
        return i

    cars = spark.range(10).select(F.udf(car, "long").asNondeterministic()("id").alias("car_id"))
    seen = []

    def load(stream, delivery):
        target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start(target).awaitTermination()
        seen.append(sorted(r.car_id for r in spark.read.parquet(target).collect()))

    in_deliveries(Lake(spark, str(tmp_path)), cars, load)
    assert seen == [[1, 3, 5, 7, 9], list(range(10))]
    assert worked_out.value == 10
