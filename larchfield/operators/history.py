"""Versioned history (SCD type 2) from a plain log of versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "__START_AT", "__END_AT"


#: A (key, day) with more rows than this is ordered second by second.
MOST_ROWS = 1_000_000
#: Keys are counted in so many buckets; those of a bucket with more rows than this are ordered by day.
KEY_BUCKETS, KEY_ROWS = 65_536, 100_000


def seq_spans(df: DataFrame, seq: str) -> tuple[Column, Column]:
    """A coarse and a fine form of ``seq``, both of which sort the same.

    Timestamps: day and second, so that a coarse span has at most 86,400 fine
    ones and a fine one at most 1,000,000 distinct values. Dates: month and day.
    Numbers: their whole part without its low 32 and 16 bits, which bounds a fine
    span to 65,536 distinct whole values whatever the range of the data.
    """
    dtype = dict(df.dtypes)[seq]
    if dtype.startswith("timestamp"):
        coarse, fine = (F.date_trunc(unit, seq).cast(dtype) for unit in ("DAY", "SECOND"))
        return coarse, fine
    if dtype == "date":
        return F.trunc(seq, "month"), F.col(seq)
    whole = F.floor(seq).cast("long")
    coarse, fine = (F.shiftleft(F.shiftright(whole, bits), bits) for bits in (32, 16))
    return coarse, fine


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Catalyst turns ``row_number() = 1`` into a group limit that already runs
    before the shuffle, so a hot key sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def scd2(
    versions: DataFrame,
    keys: Sequence[str],
    seq: str,
    tiebreak: Sequence[Column] = (),
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """History with ``__START_AT = seq`` and ``__END_AT`` = the key's next seq.

    Rows of one key with equal ``seq`` are one version: the first in the order
    of ``tiebreak`` wins. Without ``tiebreak`` the pair (key, seq) must be
    unique. Keys must not be NULL; rows with a NULL sequence are not versions:
    ``without_sequence`` returns them.

    A key may hold any share of all rows. Rows are counted per bucket of keys first,
    in a job of its own; only the numbers of large buckets reach the driver. Keys of
    the other buckets cross one shuffle and are ordered whole; the large buckets'
    keys are ordered by ``_by_span``.
    """
    ordered = versions.filter(F.col(seq).isNotNull())
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    counts = ordered.groupBy(bucket.alias("_bucket")).count()
    large = [row["_bucket"] for row in counts.filter(F.col("count") > min(most_rows, KEY_ROWS)).collect()]
    if not large:
        return _by_key(ordered, keys, seq, tiebreak)
    is_large = bucket.isin(large)
    spanned = _by_span(ordered.filter(is_large), keys, seq, tiebreak, most_rows)
    return _by_key(ordered.filter(~is_large), keys, seq, tiebreak).unionByName(spanned)


def _by_key(versions: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[Column]) -> DataFrame:
    """History of keys whose rows fit a task each; ties and ends are settled behind the same shuffle."""
    dealt = versions.repartition(*keys)
    if tiebreak:
        dealt = first_per(dealt, [*keys, seq], tiebreak)
    ends = F.lead(seq).over(Window.partitionBy(*keys).orderBy(seq))
    return dealt.withColumn(END, ends).withColumn(START, F.col(seq)).select(*versions.columns, END, START)


def _by_span(
    tagged: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[Column], most_rows: int
) -> DataFrame:
    """History of keys with any number of rows.

    Neither a key nor a day of it is put into one task. Versions are ordered inside
    spans of ``seq``: a key's day, or its seconds where the day has more than
    ``most_rows`` rows. A span gets an extra row that carries the start of the key's
    next span. Span starts, a few narrow columns, are ordered on two levels: days
    per key, and seconds per key and split day.
    """
    columns = tagged.columns
    coarse, fine = seq_spans(tagged, seq)
    tagged = tagged.withColumn("_coarse", coarse)

    # Ties do not move a span's start, so the starts need no tie-break.
    starts = tagged.groupBy(*keys, "_coarse").agg(F.min(seq).alias("_start"), F.count("*").alias("_rows"))
    after = F.lead("_start").over(Window.partitionBy(*keys).orderBy("_coarse"))
    starts = starts.withColumn("_after", after).withColumn("_split", F.col("_rows") > most_rows)
    # At most one row per ``most_rows`` rows of the input.
    split = starts.filter("_split").select(*keys, "_coarse", "_after", "_split")

    in_split = tagged.select(*keys, "_coarse", seq, fine.alias("_span")).join(split, [*keys, "_coarse"])
    inner = in_split.groupBy(*keys, "_coarse", "_span").agg(F.min(seq).alias("_start"), F.first("_after").alias("_after"))
    following = F.lead("_start").over(Window.partitionBy(*keys, "_coarse").orderBy("_span"))
    inner = inner.withColumn("_next", F.coalesce(following, "_after"))
    outer = starts.filter("NOT _split").select(*keys, F.col("_coarse").alias("_span"), F.col("_after").alias("_next"))
    markers = outer.unionByName(inner.select(*keys, "_span", "_next")).filter("_next IS NOT NULL")
    markers = markers.select(*keys, "_span", F.col("_next").alias(seq), F.lit(True).alias("_marker"))

    if tiebreak:
        tagged = first_per(tagged, [*keys, seq], tiebreak)
    spanned = tagged.join(split.select(*keys, "_coarse", "_split"), [*keys, "_coarse"], "left").withColumn(
        "_span", F.when(F.col("_split"), fine).otherwise(F.col("_coarse"))
    )
    in_span = Window.partitionBy(*keys, "_span").orderBy(seq)
    return (
        spanned.drop("_coarse", "_split")
        .withColumn("_marker", F.lit(False))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn(END, F.lead(seq).over(in_span))
        .filter(~F.col("_marker"))
        .withColumn(START, F.col(seq))
        .select(*columns, END, START)
    )


def without_sequence(versions: DataFrame, seq: str) -> DataFrame:
    """Rows that ``scd2`` cannot order, with a reason; the others are its versions."""
    return versions.filter(F.col(seq).isNull()).withColumn(
        "_reject_reason", F.lit(f"no version: {seq} is null")
    )


def current_rows(df: DataFrame) -> DataFrame:
    """Open rows without their history columns; a table without them is unchanged.

    Knows the names in the history table and those in a dimension.
    """
    for start, end in ((START, END), ("valid_from", "valid_to")):
        if end in df.columns:
            return df.filter(F.col(end).isNull()).drop(start, end)
    return df


def latest_per(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """Most recent row per key."""
    return first_per(df, keys, [F.desc(ts), *tiebreak])
