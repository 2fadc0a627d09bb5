import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larchfield.operators import history as history_module
from larchfield.operators.history import END, START, current_rows, latest_per, scd2, without_sequence
from larchfield.operators.ranking import global_rank_desc, global_row_number
from larchfield.operators.star import asof_dim_join, build_dim, enrich, fact_claims
from larchfield.streaming.history import bucket_of, merge_history, read_history, scd2_stream
from larchfield.streaming.split import read_batches, split_stream
from larchfield.plans.entities import CUSTOMERS

T0 = datetime(2020, 1, 1)


def expected_history(versions):
    """Brute force: (key, seq, id) -> {(key, id, start, end)}, highest id wins a tie."""
    best = {}
    for key, seq, i in versions:
        best[key, seq] = max(best.get((key, seq), -1), i)
    out = []
    for (key, seq), i in best.items():
        later = [s for k, s in best if k == key and s > seq]
        out.append((key, i, seq, min(later) if later else None))
    return sorted(out, key=repr)


def random_versions(count, seed):
    """A third of all rows belong to one key."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", T0 + timedelta(hours=rng.randrange(400)), i)
        for i in range(count)
    ]


def as_frame(spark, versions):
    return spark.createDataFrame(versions, "key string, seq timestamp_ntz, id int")


def test_history_with_a_hot_key_ties_and_gaps(spark, rows):
    versions = random_versions(600, 1)
    out = scd2(as_frame(spark, versions), ["key"], "seq", [F.desc("id")])
    assert rows(out, "key", "id", START, END) == expected_history(versions)


def test_one_open_row_per_key_and_closed_intervals(spark):
    out = scd2(as_frame(spark, random_versions(400, 2)), ["key"], "seq", [F.desc("id")])
    assert out.filter(F.col(END).isNull()).groupBy("key").count().filter("count <> 1").isEmpty()
    assert out.filter(F.col(END) <= F.col(START)).isEmpty()


def test_numeric_sequence(spark, rows):
    versions = [("a", 5, 1), ("a", 250_000, 2), ("a", 7, 3), ("b", 1, 4)]
    out = scd2(spark.createDataFrame(versions, "key string, seq long, id int"), ["key"], "seq")
    assert rows(out, "key", START, END) == sorted(
        [("a", 5, 7), ("a", 7, 250_000), ("a", 250_000, None), ("b", 1, None)], key=repr
    )


def test_current_rows_in_history_dimension_and_plain_table(spark):
    history = scd2(as_frame(spark, [("a", T0, 1), ("a", T0 + timedelta(1), 2)]), ["key"], "seq")
    dim = build_dim(history, "key", "key_sk")
    for frame in (history, dim):
        current = current_rows(frame)
        assert [r.id for r in current.collect()] == [2]
        assert not {START, END, "valid_from", "valid_to"} & set(current.columns)
    plain = spark.range(3)
    assert current_rows(plain) is plain


def stage(spark, folder, name, versions):
    as_frame(spark, versions).coalesce(1).write.parquet(f"{folder}/{name}")


def version_stream(spark, folder):
    reader = spark.readStream.schema("key string, seq timestamp_ntz, id int")
    return reader.option("recursiveFileLookup", True).parquet(str(folder))


def files_by_bucket(target):
    found = {}
    for path in Path(target).glob("_bucket=*/*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def test_stream_gives_the_batch_history_and_takes_late_rows(spark, rows, tmp_path):
    first, late = random_versions(120, 3), [("hot", T0 + timedelta(hours=3, minutes=30), 999)]
    target, checkpoint, order = f"{tmp_path}/target", f"{tmp_path}/ck", [F.desc("id")]
    stage(spark, tmp_path, "in/1", first)
    stream = version_stream(spark, f"{tmp_path}/in")
    once = scd2_stream(stream, target, ["key"], "seq", checkpoint, order, 16)
    assert rows(once, "key", "id", START, END) == expected_history(first)
    before = files_by_bucket(target)
    stage(spark, tmp_path, "in/2", late)
    twice = scd2_stream(stream, target, ["key"], "seq", checkpoint, order, 16)
    assert rows(twice, "key", "id", START, END) == expected_history(first + late)
    after = files_by_bucket(target)
    assert len(before) > 8 and [b for b in before if after[b] != before[b]] == [
        f"_bucket={as_frame(spark, late).select(bucket_of(['key'], 16)).first()[0]}"
    ]
    # A third batch with a new key, ties, and rows that no history can hold.
    third = [("new", T0, 1000), ("hot", late[0][1], 1001), ("hot", None, 1002), ("k1", None, 1003)]
    stage(spark, tmp_path, "in/3", third)
    thrice = scd2_stream(stream, target, ["key"], "seq", checkpoint, order, 16)
    assert rows(thrice, "key", "id", START, END) == expected_history(first + late + third[:2])
    assert rows(read_batches(spark, f"{target}-rejected"), "key", "id") == [("hot", 1002), ("k1", 1003)]


def test_merge_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    target = f"{tmp_path}/target"
    merge_history(as_frame(spark, random_versions(200, 4)), target, 0, ["key"], "seq", [F.desc("id")], 16)
    for path in Path(target).glob("_bucket=*"):
        if path.name != f"_bucket={as_frame(spark, [('hot', T0, 1)]).select(bucket_of(['key'], 16)).first()[0]}":
            for part in path.glob("*.parquet"):
                part.write_bytes(b"unreadable")
                path.joinpath(f".{part.name}.crc").unlink(missing_ok=True)
    merge_history(as_frame(spark, [("hot", T0, 5000)]), target, 1, ["key"], "seq", [F.desc("id")], 16)


def test_merge_repeated_or_resumed_gives_the_same_rows(spark, rows, tmp_path):
    target, first, second = f"{tmp_path}/target", random_versions(90, 5), random_versions(60, 6)
    second = [(k, s, i + 1000) for k, s, i in second]
    merge = lambda batch, i: merge_history(as_frame(spark, batch), target, i, ["key"], "seq", [F.desc("id")], 8)
    merge(first, 0)
    merge(second, 1)
    merge(second, 1)
    assert rows(read_history(spark, target), "key", "id", START, END) == expected_history(first + second)
    # Stopped between removing a bucket and putting the new one in place.
    shutil.rmtree(next(Path(target).glob("_bucket=*")))
    merge(second, 1)
    assert rows(read_history(spark, target), "key", "id", START, END) == expected_history(first + second)
    # Stopped while the new buckets were written aside.
    third = [("hot", T0 - timedelta(1), 5000)]
    as_frame(spark, third).write.parquet(f"{target}-staged/batch_id=2")
    Path(f"{target}-staged/batch_id=2/_SUCCESS").unlink()
    merge(third, 2)
    assert rows(read_history(spark, target), "key", "id", START, END) == expected_history(first + second + third)


def test_stream_split_writes_both_branches_once(spark, rows, tmp_path):
    spark.createDataFrame(
        [("1", "e"), (None, "w"), ("2", "zz")], "customerid string, reg string"
    ).coalesce(1).write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("customerid string, reg string").json(f"{tmp_path}/in")
    for _ in range(2):
        split_stream(
            stream, CUSTOMERS, f"{tmp_path}/clean", f"{tmp_path}/bad", f"{tmp_path}/ck"
        ).awaitTermination()
    assert rows(read_batches(spark, f"{tmp_path}/clean"), "customer_id", "region") == [("1", "East")]
    assert rows(read_batches(spark, f"{tmp_path}/bad"), "_reject_reason") == [
        ("R1: customer_id is null",), ("R2: invalid region code",)
    ]


def test_latest_row_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w")], "k string, t int, v string")
    assert rows(latest_per(df, ["k"], "t", [F.desc("v")])) == [("a", 3, "z"), ("b", 2, "w")]


def test_global_rank_equals_sql_rank(spark):
    rng = random.Random(4)
    scores = [None if rng.random() < 0.05 else (55.5 if rng.random() < 0.3 else round(rng.uniform(-30, 200), 1)) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(scores)), "id int, score double")
    got = {r.id: r.rank for r in global_rank_desc(df, "score", 10.0, "rank").collect()}
    order = lambda s: float("-inf") if s is None else s
    assert got == {i: 1 + sum(order(o) > order(s) for o in scores) for i, s in enumerate(scores)}


def test_global_row_number_is_one_sequence(spark):
    rng = random.Random(5)
    values = rng.sample(range(10_000), 300)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = global_row_number(df, {"_b": F.floor(F.col("v") / 100)}, [F.col("v")], "n")
    assert [(r.v, r.n) for r in got.orderBy("v").collect()] == [(v, i) for i, v in enumerate(sorted(values), 1)]


def dims(spark):
    policy = spark.createDataFrame([(1, 10, T0)], "policy_number int, customer_id int, seq timestamp_ntz")
    customer = spark.createDataFrame(
        [(10, "old", T0), (10, "new", T0 + timedelta(100))], "customer_id int, region string, seq timestamp_ntz"
    )
    return (
        build_dim(scd2(policy, ["policy_number"], "seq"), "policy_number", "policy_sk"),
        build_dim(scd2(customer, ["customer_id"], "seq"), "customer_id", "customer_sk"),
    )


CLAIM = (
    "claimid string, policyid int, incident_date timestamp_ntz, incident_state_full string,"
    " number_of_vehicles_involved int, incident_severity string, claim_processed_on timestamp_ntz,"
    " claim_logged_on timestamp_ntz, claim_rejected string"
)
CLAIMS = [
    ("c1", 1, T0 + timedelta(50), "Ohio", 1, "Major", T0 + timedelta(60), T0 + timedelta(50), "Y"),
    ("c2", 9, T0 + timedelta(50), "Ohio", 1, "Major", None, T0, "odd text"),
]


def test_facts_fan_out_over_versions_unless_asof(spark, rows):
    dim_policy, dim_customer = dims(spark)
    claims = spark.createDataFrame(CLAIMS, CLAIM)
    plain = fact_claims(claims, dim_policy, dim_customer)
    assert rows(plain.groupBy("claim_id").count()) == [("c1", 2), ("c2", 1)]
    exact = fact_claims(claims, dim_policy, dim_customer, asof=True)
    regions = exact.join(dim_customer, "customer_sk", "left")
    assert rows(regions, "claim_id", "region", "processing_time_days", "is_rejected_int") == [
        ("c1", "old", 10, 1), ("c2", None, None, 0)
    ]


def test_fact_from_a_stream(spark, rows, tmp_path):
    dim_policy, dim_customer = dims(spark)
    spark.createDataFrame(CLAIMS, CLAIM).write.parquet(f"{tmp_path}/claims")
    stream = spark.readStream.schema(CLAIM).parquet(f"{tmp_path}/claims")
    fact = fact_claims(stream, dim_policy, dim_customer)
    assert fact.isStreaming
    fact.writeStream.format("parquet").option("path", f"{tmp_path}/fact").option(
        "checkpointLocation", f"{tmp_path}/ck"
    ).trigger(availableNow=True).start().awaitTermination()
    batch = fact_claims(spark.createDataFrame(CLAIMS, CLAIM), dim_policy, dim_customer)
    assert rows(spark.read.parquet(f"{tmp_path}/fact")) == rows(batch)


def test_asof_interval_ends_where_the_next_version_begins(spark):
    _, dim_customer = dims(spark)
    fact = spark.createDataFrame([(10, T0 + timedelta(100)), (10, T0 - timedelta(1))], "cid int, at timestamp_ntz")
    joined = asof_dim_join(fact, dim_customer, ("cid", "customer_id"), "at", ["region"])
    assert sorted(str(r.dim_region) for r in joined.collect()) == ["None", "new"]


def test_enrich_without_dimension_keeps_the_schema(spark):
    df = spark.createDataFrame([(1,)], "policyid int")
    for dim in (None, spark.createDataFrame([(1,)], "other int")):
        out = enrich(df, dim, ("policyid", "policy_number"), {"policy_csl": "policy_csl"})
        assert out.first().asDict() == {"policyid": 1, "policy_csl": None}


def test_rows_without_sequence_are_shown(spark):
    rows = spark.createDataFrame([(1, T0), (2, None)], "customer_id int, seq timestamp_ntz")
    kept = scd2(rows, ["customer_id"], "seq").count()
    rejected = without_sequence(rows, "seq").collect()
    assert kept + len(rejected) == 2 and rejected[0].customer_id == 2


@pytest.mark.parametrize("most_rows", [1, 5, 40])
def test_split_days_give_the_same_history(spark, rows, most_rows):
    # Nine rows in ten belong to one key, most of them to two of its days.
    rng = random.Random(9)
    versions = [
        (
            "hot" if rng.random() < 0.9 else f"k{rng.randrange(5)}",
            T0 + timedelta(days=rng.choice([0, 0, 0, 1, 1, 40]), seconds=rng.randrange(30), milliseconds=rng.randrange(40)),
            i,
        )
        for i in range(500)
    ]
    out = scd2(as_frame(spark, versions), ["key"], "seq", [F.desc("id")], most_rows)
    assert rows(out, "key", "id", START, END) == expected_history(versions)


@pytest.mark.parametrize("kind", ["long", "date", "double"])
def test_split_spans_of_other_types(spark, rows, kind):
    rng = random.Random(2)
    pick = {
        "long": lambda: rng.choice([rng.randrange(-300_000, 300_000), rng.randrange(-(2**62), 2**62), -1, 0, 65_536]),
        "date": lambda: (T0 + timedelta(days=rng.randrange(90))).date(),
        "double": lambda: round(rng.uniform(-1e6, 1e6), 2),
    }[kind]
    versions = [(rng.choice("aab"), pick(), i) for i in range(200)]
    frame = spark.createDataFrame(versions, f"key string, seq {kind}, id int")
    out = scd2(frame, ["key"], "seq", [F.desc("id")], 3)
    assert rows(out, "key", "id", START, END) == expected_history(versions)


def test_keys_of_few_rows_cross_one_shuffle(spark):
    out = scd2(as_frame(spark, random_versions(300, 8)), ["key"], "seq", [F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


@pytest.mark.parametrize("key_rows", [0, 12, 150])
def test_large_buckets_are_ordered_by_day(spark, rows, monkeypatch, key_rows):
    versions = random_versions(600, 10)
    monkeypatch.setattr(history_module, "KEY_ROWS", key_rows)
    out = scd2(as_frame(spark, versions), ["key"], "seq", [F.desc("id")])
    assert "_marker" in out._jdf.queryExecution().analyzed().toString()
    assert rows(out, "key", "id", START, END) == expected_history(versions)
