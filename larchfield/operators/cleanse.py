"""Standardising projections. All are narrow: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.functions.text import TIMESTAMP_FORMATS, code_name, timestamp_of

# Fixed value: what is left of a date after a spreadsheet kept only mm:ss.0.
CORRUPT_DATE = r"^\d{1,3}:\d{2}\.\d+$"


def unify_cased_columns(df: DataFrame) -> DataFrame:
    """Lower-case all names; columns equal up to case become one.

    The merged column holds the first non-NULL value in column order. Columns
    are addressed by position because names that differ only in case are
    ambiguous to the analyser.
    """
    positions: dict[str, list[str]] = {}
    slots = [f"slot_{i}" for i in range(len(df.columns))]
    for slot, name in zip(slots, df.columns):
        positions.setdefault(name.lower(), []).append(slot)
    return df.toDF(*slots).select(
        *(
            (F.coalesce(*map(F.col, found)) if len(found) > 1 else F.col(found[0])).alias(name)
            for name, found in positions.items()
        )
    )


def merge_synonyms(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column per target, the first non-NULL of its sources in list order.

    Sources are dropped. A target without any source becomes a NULL string.
    """
    present = {t: [c for c in sources if c in df.columns] for t, sources in synonyms.items()}
    used = {c for found in present.values() for c in found}
    kept = [F.col(c) for c in df.columns if c not in used and c not in synonyms]
    merged = []
    for target, found in present.items():
        if not found and target in df.columns:
            merged.append(F.col(target))
        elif not found:
            merged.append(F.lit(None).cast("string").alias(target))
        else:
            merged.append(F.coalesce(*map(F.col, found)).alias(target))
    return df.select(*kept, *merged)


def expand_codes(
    df: DataFrame, source: str, target: str, names: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Full name of a code. Unknown codes are title-cased.

    ``names`` is a small mapping, or a DataFrame ``(code, name)`` with upper-case
    unique codes when the list is long; Catalyst then picks the join by size.
    """
    if not isinstance(names, DataFrame):
        return df.withColumn(target, code_name(source, names))
    lookup = names.select(F.col("code").alias("_code"), F.col("name").alias("_code_name"))
    return (
        df.join(lookup, F.upper(F.col(source)) == F.col("_code"), "left")
        .withColumn(target, F.coalesce("_code_name", F.initcap(source)))
        .drop("_code", "_code_name")
    )


def null_tokens(
    df: DataFrame, placeholders: Mapping[str, Sequence[str]], ignore_case: bool = False
) -> DataFrame:
    """Placeholder texts become NULL. Columns that do not exist are skipped."""

    def cleaned(name: str, texts: Sequence[str]) -> Column:
        value = F.upper(name) if ignore_case else F.col(name)
        wanted = [t.upper() for t in texts] if ignore_case else list(texts)
        return F.when(value.isNull() | ~value.isin(wanted), F.col(name))

    return df.withColumns(
        {name: cleaned(name, texts) for name, texts in placeholders.items() if name in df.columns}
    )


def parse_timestamps(
    df: DataFrame,
    columns: Sequence[str],
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    as_type: str = "timestamp",
) -> DataFrame:
    """String columns become timestamps; columns of another type stay as they are."""
    texts = {name for name, dtype in df.dtypes if dtype == "string"}
    return df.withColumns(
        {c: timestamp_of(c, formats, as_type) for c in columns if c in texts}
    )


def flag_corrupt(
    df: DataFrame, columns: Sequence[str], pattern: str = CORRUPT_DATE, flag: str = "_is_corrupt_date"
) -> DataFrame:
    """True when any of the texts matches. Call it before the dates are parsed.

    Only string columns are looked at; a date that has a date type is whole.
    """
    texts = {name for name, dtype in df.dtypes if dtype == "string"}
    corrupt = F.lit(False)
    for name in (c for c in columns if c in texts):
        corrupt = corrupt | F.coalesce(F.col(name).rlike(pattern), F.lit(False))
    return df.withColumn(flag, corrupt)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose data columns are all NULL or blank.

    Columns that start with ``_`` are provenance and do not count.
    """
    filled = F.lit(False)
    for name in (c for c in df.columns if not c.startswith("_")):
        filled = filled | F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(False))
    return df.filter(filled)


def extract_measure(
    df: DataFrame,
    source: str,
    number: str,
    unit: str | None = None,
    as_type: str = "double",
    pattern: str = r"([\d.]+)",
) -> DataFrame:
    """First number in a text such as ``23.4 kmpl`` and, if asked for, its unit."""
    if source not in df.columns:
        return df
    text = F.col(source)
    found = {number: F.regexp_extract(text, pattern, 1).try_cast(as_type)}
    if unit:
        found[unit] = F.regexp_extract(text, r"([a-zA-Z/]+)", 1)
    out = df.withColumns(found)
    return out if source in found else out.drop(source)


def convert_units(
    df: DataFrame,
    source: str,
    target: str,
    token: str,
    factor: float,
    places: int = 2,
    raw: str | None = None,
) -> DataFrame:
    """Number in ``source``, times ``factor`` where the text names the unit ``token``.

    The text itself is kept under the name ``raw``.
    """
    if source not in df.columns:
        return df
    text = F.col(source)
    value = F.regexp_extract(text, r"(\d+\.?\d*)", 1).try_cast("double")
    out = df.withColumn(
        target,
        F.when(F.lower(text).contains(token), F.round(value * factor, places)).otherwise(value),
    )
    return out.withColumnRenamed(source, raw) if raw else out.drop(source)


def try_cast_cols(df: DataFrame, columns: Sequence[str], as_type: str = "double") -> DataFrame:
    """Cast; a text that does not fit becomes NULL instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(as_type) for c in columns if c in df.columns})


def with_flags(df: DataFrame, flags: Mapping[str, str | Column]) -> DataFrame:
    """Boolean columns from SQL predicates or column expressions."""
    return df.withColumns(
        {name: F.expr(test) if isinstance(test, str) else test for name, test in flags.items()}
    )


def add_audit(df: DataFrame, stage: str, at: Column | None = None) -> DataFrame:
    """Processing time and stage name."""
    return df.withColumns(
        {
            "_silver_load_ts": F.current_timestamp() if at is None else at,
            "_stage": F.lit(stage),
        }
    )
