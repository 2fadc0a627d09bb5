from datetime import datetime

from pyspark.sql import functions as F

from larchfield.functions import text
from larchfield.functions.text import is_valid_email, token_count
from larchfield.operators import cleanse
from larchfield.plans.entities import STATES, prepare_cars, prepare_claims, prepare_customers, prepare_sales


def test_columns_equal_up_to_case_are_merged(spark, rows):
    df = spark.createDataFrame([("a", "b", "x"), (None, "c", "y")], "one string, two string, three string")
    out = cleanse.unify_cased_columns(df.toDF("ClaimID", "claimid", "Other"))
    assert out.columns == ["claimid", "other"]
    assert rows(out) == [("a", "x"), ("c", "y")]


def test_synonyms_take_first_value_and_missing_targets_are_null(spark, rows):
    df = spark.createDataFrame([(None, "7", "E"), ("1", "2", "w")], "customerid string, cust_id string, reg string")
    out = cleanse.merge_synonyms(
        df, {"customer_id": ["customerid", "customer_id", "cust_id"], "region": ["region", "reg"], "city": ["city"]}
    )
    assert sorted(out.columns) == ["city", "customer_id", "region"]
    assert rows(out, "customer_id", "region", "city") == [("1", "w", None), ("7", "E", None)]


def test_codes_from_mapping_and_from_table_agree(spark, rows):
    df = spark.createDataFrame([("il",), ("ZZ",), ("new york",), (None,)], "state string")
    table = spark.createDataFrame(list(STATES.items()), "code string, name string")
    expected = [("ZZ", "Zz"), ("il", "Illinois"), ("new york", "New York"), (None, None)]
    for names in (STATES, table):
        assert rows(cleanse.expand_codes(df, "state", "full", names)) == sorted(expected, key=repr)


def test_timestamps_in_every_form_and_no_bare_clock_time(spark):
    texts = ["05-03-2016 14:10", "2016-03-05 01:02:03", "05-03-2016", "2016-03-05", "2016-03-05T10:00:00",
             "12:30", "27:00.0", "abc", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    parsed = cleanse.parse_timestamps(df, ["d", "absent"], as_type="timestamp_ntz").orderBy("i")
    assert [r.d for r in parsed.collect()] == [
        datetime(2016, 3, 5, 14, 10), datetime(2016, 3, 5, 1, 2, 3), datetime(2016, 3, 5),
        datetime(2016, 3, 5), datetime(2016, 3, 5, 10), None, None, None, None, None,
    ]


def test_corrupt_dates_are_seen_before_parsing(spark, rows):
    claims = spark.createDataFrame(
        [("c1", "p1", "27:00.0", "null", "?", "OH"), ("c2", "p2", "2016-03-05", "05-03-2016", "YES", "atlantis")],
        "ClaimID string, PolicyID string, incident_date string, claim_processed_on string,"
        " property_damage string, incident_state string",
    )
    out = prepare_claims(claims)
    assert rows(out, "claimid", "_is_corrupt_date", "property_damage", "incident_state_full") == [
        ("c1", True, None, "Ohio"),
        ("c2", False, "YES", "Atlantis"),
    ]
    assert out.filter("claimid = 'c1'").first().incident_date is None
    assert out.filter("claimid = 'c1'").first().claim_processed_on is None


def test_blank_rows_are_dropped_and_unsold_flagged(spark, rows):
    sales = spark.createDataFrame(
        [("s1", "2016-03-05", "100", "f"), (None, "  ", "", "f"), (None, None, None, "f"), ("s2", None, "abc", "f")],
        "Sales_ID string, sold_on string, original_selling_price string, _source_file string",
    )
    out = prepare_sales(sales)
    assert rows(out, "sales_id", "is_unsold", "original_selling_price") == [
        ("s1", False, 100.0),
        ("s2", True, None),
    ]


def test_measures_and_units(spark):
    cars = spark.createDataFrame(
        [("1", "23.4 kmpl", "1248 CC", "74 bhp", "12.7@ 2,700(kgm@ rpm)", "5"),
         ("2", "", None, " bhp", "190Nm@ 2000rpm", "x"), ("3", None, "CC", None, "", None)],
        "car_id string, mileage string, engine string, max_power string, torque string, km_driven string",
    )
    got = {r.car_id: r for r in prepare_cars(cars).collect()}
    one, two, three = got["1"], got["2"], got["3"]
    assert (one.mileage, one.mileage_unit, one.engine_cc, one.max_power_bhp) == (23.4, "kmpl", 1248, 74.0)
    assert (one.torque_nm, one.torque_raw) == (124.54, "12.7@ 2,700(kgm@ rpm)")
    assert (two.mileage, two.engine_cc, two.max_power_bhp, two.torque_nm, two.km_driven) == (None, None, None, 190.0, None)
    assert (three.engine_cc, three.torque_nm, three.torque_raw) == (None, None, "")


def test_customers_without_optional_columns_keep_their_schema(spark):
    out = prepare_customers(spark.createDataFrame([("1",)], "CustomerID string"))
    assert {"customer_id", "region", "education", "marital", "city"} <= set(out.columns)
    assert out.first().region is None


def test_mail_form_and_null(spark, rows):
    df = spark.createDataFrame([("a.b+c@x-y.org",), ("a@b",), ("@x.com",), ("",), (None,)], "m string")
    assert rows(df.select("m", is_valid_email("m"))) == sorted(
        [("a.b+c@x-y.org", True), ("a@b", False), ("@x.com", False), ("", False), (None, False)], key=repr
    )


def test_tokens_split_like_python(spark):
    texts = ["", "   ", "a  b\n c", " x y　", "p\x1cq\x1fr", "é ü", "tab\tend\x85"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", token_count("t").alias("n"))
    assert all(len(r.t.split()) == r.n for r in df.collect())


def test_null_tokens_with_and_without_case(spark, rows):
    df = spark.createDataFrame([("null", "?"), ("NULL", "a"), (None, None)], "d string, f string")
    out = cleanse.null_tokens(cleanse.null_tokens(df, {"d": ["NULL"]}, ignore_case=True), {"f": ["?"], "gone": ["?"]})
    assert rows(out) == sorted([(None, None), (None, "a"), (None, None)], key=repr)


def test_audit_stamp(spark):
    stamped = cleanse.add_audit(spark.range(1), "stage one", F.lit("2020-01-01").cast("timestamp_ntz"))
    assert stamped.first().asDict() == {"id": 0, "_silver_load_ts": datetime(2020, 1, 1), "_stage": "stage one"}


def test_only_texts_of_a_format_reach_its_parser(spark):
    """The patterns before the parsers let everything through that the parsers can read."""
    assert text.format_shape("dd-MM-yyyy HH:mm") == r"^\d\d-\d\d-[+-]?\d{4,19} \d\d:\d\d$"
    assert text.format_shape("yyyy/MM") is None and text.format_shape("d-MM") is None
    values = [
        "05-03-2016 14:10", "5-3-2016", "05-03-2016", "05-03--2016", "+12016-03-05", "-2016-03-05", "20160-03-05",
        "2016-03-05 01:02:03", "2016-03-05 1:02:03", "2016-02-30", "2016-03-05\n", " 2016-03-05", "27:00.0", "Null", "", None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for fmt in text.TIMESTAMP_FORMATS:
        plain = F.try_to_timestamp("v", F.lit(fmt)).cast("string")
        guarded = text.timestamp_in("v", fmt).cast("string")
        assert all(r.a == r.b for r in df.select(plain.alias("a"), guarded.alias("b")).collect())
