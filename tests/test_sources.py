import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larchfield import session
from larchfield.sources import files, tables


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_files_with_different_headers_are_united_by_name(spark, rows, tmp_path):
    write(tmp_path, "Customers_1.csv", "CustomerID,Reg\n1,E\n2,W\n")
    write(tmp_path, "sub/customers_2.csv", "Reg,cust_id,Extra\nN,3,x\n")
    write(tmp_path, "sales_1.csv", "sales_id\n9\n")
    df = files.read_files(spark, str(tmp_path), "csv", files.any_case("customers", "csv"))
    assert rows(df, "CustomerID", "Reg", "cust_id", "Extra", "_source_file", "_rescued_data") == sorted(
        [
            ("1", "E", None, None, "Customers_1.csv", None),
            ("2", "W", None, None, "Customers_1.csv", None),
            (None, "N", "3", "x", "customers_2.csv", None),
        ],
        key=repr,
    )
    assert df.filter(F.col("_load_timestamp").isNull()).isEmpty()


def test_no_file_is_an_error(spark, tmp_path):
    write(tmp_path, "a.csv", "x\n1\n")
    with pytest.raises(FileNotFoundError):
        files.read_files(spark, str(tmp_path), "csv", "b*.csv")


def test_names_equal_up_to_case_in_one_header(spark, rows, tmp_path):
    write(tmp_path, "claims.csv", "ClaimID,claimid,Other\n1,,a\n,2,b\n")
    df = files.read_files(spark, str(tmp_path), "csv", "claims*.csv")
    assert rows(df, "claimid", "other") == [("1", "a"), ("2", "b")]


def test_rows_that_do_not_fit_are_rescued(spark, rows, tmp_path):
    write(tmp_path, "sales.csv", "a,b\n1,2\n3,4,5\n6\n")
    df = files.read_files(spark, str(tmp_path), "csv", "sales*.csv")
    assert rows(df, "a", "b", "_rescued_data") == sorted(
        [("1", "2", None), ("3", "4", "3,4,5"), ("6", None, "6")], key=repr
    )


def test_json_keeps_every_key_as_text_and_bad_lines(spark, rows, tmp_path):
    lines = [json.dumps({"ClaimID": 1, "injury": 2.5}), json.dumps({"ClaimID": 2, "extra": True}), "{broken"]
    write(tmp_path, "claims_1.json", "\n".join(lines))
    df = files.read_files(spark, str(tmp_path), "json", files.any_case("claims", "json"))
    assert rows(df, "ClaimID", "injury", "extra", "_rescued_data") == sorted(
        [("1", "2.5", None, None), ("2", None, "true", None), (None, None, None, "{broken")], key=repr
    )
    assert {t for c, t in df.dtypes if not c.startswith("_load")} == {"string"}


def test_new_files_are_loaded_once_and_columns_may_be_added(spark, rows, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ck")
    glob = files.any_case("sales", "csv")

    def load():
        return files.ingest_new_files(spark, str(raw), "csv", glob, target, checkpoint)

    write(raw, "Sales_1.csv", "sales_id,price\ns1,10\n")
    assert rows(load(), "sales_id", "price") == [("s1", "10")]
    write(raw, "sales_2.csv", "sales_id,price\ns2,20\n")
    write(raw, "sales_4.csv", "sales_id,price,car_id\ns4,40,c4\n")
    load()
    assert rows(load(), "sales_id", "price", "car_id", "_source_file") == [
        ("s1", "10", None, "Sales_1.csv"),
        ("s2", "20", None, "sales_2.csv"),
        ("s4", "40", "c4", "sales_4.csv"),
    ]


def test_new_json_files_are_loaded_once(spark, rows, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ck")
    write(raw, "claims_1.json", '{"claimid": "1"}')
    for _ in range(2):
        df = files.ingest_new_files(spark, str(raw), "json", "claims*.json", target, checkpoint)
    assert rows(df, "claimid") == [("1",)]


def both_ways(spark, base, fmt, glob, tmp_path):
    """The files read as a batch and as a stream."""
    target, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "ck")
    return [
        files.read_files(spark, str(base), fmt, glob),
        files.ingest_new_files(spark, str(base), fmt, glob, target, checkpoint),
    ]


def test_files_of_one_name_in_two_folders_keep_their_own_header(spark, rows, tmp_path):
    write(tmp_path, "raw/a/c.csv", "id,reg\n1,E\n")
    write(tmp_path, "raw/b/c.csv", "reg,id\nW,2\n")
    for df in both_ways(spark, tmp_path / "raw", "csv", "c*.csv", tmp_path):
        assert rows(df, "id", "reg", "_rescued_data") == [("1", "E", None), ("2", "W", None)]


def test_blank_first_lines_are_no_header(spark, rows, tmp_path):
    write(tmp_path, "raw/c1.csv", "\n  \nid,reg\n1,E\n\n")
    write(tmp_path, "raw/c2.csv", "\ufeffid,reg\n2,W\n")
    write(tmp_path, "raw/c3.csv", "")
    for df in both_ways(spark, tmp_path / "raw", "csv", "c*.csv", tmp_path):
        assert rows(df, "id", "reg") == [("1", "E"), ("2", "W")]


def test_odd_file_names(spark, rows, tmp_path):
    for i, name in enumerate(["c{1}.csv", "c,2.csv", "c[3].csv", "c 4%20.csv"]):
        write(tmp_path, f"raw/{name}", f"id\n{i}\n")
    for df in both_ways(spark, tmp_path / "raw", "csv", "c*.csv", tmp_path):
        assert rows(df, "id") == [("0",), ("1",), ("2",), ("3",)]


def test_json_keys_equal_up_to_case_are_one_column(spark, rows, tmp_path):
    write(tmp_path, "raw/a/claims.json", '{"ClaimID": 1, "x": {"y": 2}}\n')
    write(tmp_path, "raw/b/claims.json", '\n{"claimid": "2"}\n[{"CLAIMID": 3}, {"claimid": 4}]\n{"claimid": 5\n7\n')
    for df in both_ways(spark, tmp_path / "raw", "json", "claims*.json", tmp_path):
        assert rows(df, "claimid", "x", "_rescued_data") == sorted(
            [
                ("1", '{"y":2}', None),
                ("2", None, None),
                ("3", None, None),
                ("4", None, None),
                (None, None, '{"claimid": 5'),
                (None, None, "7"),
            ],
            key=repr,
        )


def test_headers_with_clashing_and_missing_names(spark, rows, tmp_path):
    write(tmp_path, "raw/c.csv", "id,,_source_file,ID\n1,x,y,\n,x,y,2\n")
    for df in both_ways(spark, tmp_path / "raw", "csv", "c*.csv", tmp_path):
        assert rows(df, "id", "_c1", "_source_file_in_file", "_source_file") == [
            ("1", "x", "y", "c.csv"), ("2", "x", "y", "c.csv")
        ]


def test_new_spellings_join_stored_columns(spark, rows, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ck")
    for i, text in enumerate(["Id,a\n1,x\n", "ID,b\n2,y\n"]):
        write(raw, f"c{i}.csv", text)
        df = files.ingest_new_files(spark, str(raw), "csv", "c*.csv", target, checkpoint)
    assert df.columns[:3] == ["Id", "a", "b"]
    assert rows(df, "id", "a", "b") == sorted([("1", "x", None), ("2", None, "y")], key=repr)


def test_reconciliation_finds_lost_rows_and_types(spark, tmp_path):
    raw = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "c")], "_source_file string, v string")
    good = {r._source_file: r for r in tables.reconcile(raw, raw.withColumn("_load_timestamp", F.lit(1))).collect()}
    assert good["f1"].passed and good["f1"].raw_count == 2
    lost = tables.reconcile(raw, raw.filter("v <> 'c'"))
    assert [r._source_file for r in lost.filter("NOT passed").collect()] == ["f2"]
    with pytest.raises(ValueError):
        tables.require_passed(lost)
    wrong = tables.reconcile(raw, raw.select("_source_file", F.lit(1).alias("v")))
    assert "type of v" in wrong.first().schema_problems
    assert "missing column v" in tables.reconcile(raw, raw.drop("v")).first().schema_problems


def test_overwrite_replaces_rows_and_columns(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    tables.overwrite_table(spark.createDataFrame([(1, "a")], "x int, y string"), path)
    for _ in range(2):
        out = tables.overwrite_table(spark.createDataFrame([(2.5,)], "z double"), path)
    assert out.columns == ["z"] and rows(out) == [(2.5,)]


def test_empty_tables_stop_the_run(spark):
    counts = tables.table_counts({"full": spark.range(2), "empty": spark.range(0)})
    assert {r.table_name: r.record_count for r in counts.collect()} == {"full": 2, "empty": 0}
    with pytest.raises(ValueError, match="empty"):
        tables.require_rows(counts)


def test_reconciliation_sees_changed_content(spark):
    raw = spark.createDataFrame(
        [("f1", "a", None, 1), ("f1", None, "b", 1), ("f1", "c", "c", 2), ("f2", "x", "y", 3), ("f2", "x", "y", 3)],
        "_source_file string, u string, v string, n int",
    )
    passed = lambda bronze: {r._source_file: r.passed for r in tables.reconcile(raw, bronze).collect()}
    assert passed(raw.orderBy(F.rand(1)).repartition(3)) == {"f1": True, "f2": True}
    # Two values swapped between rows, between columns, and a row doubled for another.
    swapped = raw.withColumn("n", F.when(F.col("u") == "c", 1).when(F.col("u") == "a", 2).otherwise(F.col("n")))
    assert passed(swapped) == {"f1": False, "f2": True}
    crossed = raw.select("_source_file", F.col("v").alias("u"), F.col("u").alias("v"), "n")
    assert passed(crossed)["f2"] is False
    doubled = raw.where("_source_file = 'f2'").union(raw.where("u = 'a'")).union(raw.where("u = 'a'")).union(raw.where("u = 'c'"))
    assert passed(doubled) == {"f1": False, "f2": True}


def test_a_table_written_in_slices_is_whole(spark, rows, tmp_path):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(100)], "k int, v int")
    for _ in range(2):
        assert rows(tables.overwrite_table(df, f"{tmp_path}/t", "k", 3)) == rows(df)
    assert rows(tables.overwrite_table(df.select("v"), f"{tmp_path}/t")) == rows(df, "v")


def test_written_tables_leave_no_shuffle_files(spark, rows):
    """They would lie on the disk until the driver collects its garbage."""

    def shuffles():
        store = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
        return {p.name for p in store.rglob("shuffle_*.data")}

    before = shuffles()
    df = spark.range(1000).groupBy(F.col("id") % 10).count()
    written = session.materialise(df, "counts")
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and rows(written) == rows(df)
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"
