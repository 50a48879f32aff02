"""Cell-level coercion shared by cleaning, feature building and input checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal number.  The cast alone is too lenient: it also reads "1d" and "1f".
NUMBER_TEXT = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$"
DAY_FIRST = r"^(\d{1,2})-(\d{1,2})-(\d{4})\s+(\d{1,2}):(\d{1,2})$"
COMPACT_DAY = r"^(\d{4})(\d{2})(\d{2})$"

WHOLE_NUMBERS = {"previous_txns", "account_age_days"}
FLAGS = {"is_intl"}


def clean_text(col: Column) -> Column:
    """Trim; blank becomes null."""
    return F.nullif(F.trim(col.cast("string")), F.lit(""))


def finite(col: Column) -> Column:
    """Null instead of NaN or infinity: Spark orders NaN above every number."""
    inf = float("inf")
    return F.when(~F.isnan(col) & (col < F.lit(inf)) & (col > F.lit(-inf)), col)


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a double, null where it is no number.

    The expression names the column once.  Rules that look at the value several times
    belong in a later projection over the result, so the cast is not repeated.
    """
    col = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.regexp_extract(col, NUMBER_TEXT, 1).try_cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    return F.lit(None).cast("double")


def in_domain(col: Column, name: str) -> Column:
    """Apply the domain rule of engine column ``name`` to a double (NaN and infinity fail it)."""
    ok = (col >= 0) & (col < F.lit(float("inf")))
    if name in FLAGS:
        ok = col.isin(0.0, 1.0)
    elif name in WHOLE_NUMBERS:
        ok = ok & (col % 1 == 0)
    return F.when(ok, col)


def with_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace ``names`` by in-domain doubles: one projection casts, the next applies the rules."""
    cast = df.withColumns({c: number(df, c) for c in names})
    return cast.withColumns({c: in_domain(F.col(c), c) for c in names})


def event_time(df: DataFrame, name: str) -> Column:
    """Timestamp without zone from day-first text, ISO-8601 text, or a typed column.

    Day-first text is rewritten to ISO and cast, so the result does not depend on
    the session's time zone.
    """
    col = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return col
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return col.cast("timestamp_ntz")
    if not isinstance(kind, T.StringType):
        return F.lit(None).cast("timestamp_ntz")
    iso = F.regexp_replace(col, DAY_FIRST, "$3-$2-$1 $4:$5")  # other texts pass unchanged
    iso = F.regexp_replace(iso, COMPACT_DAY, "$1-$2-$3")
    return iso.try_cast("timestamp_ntz")


def iso_text(col: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text, the form every file sink uses."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, null for a zero denominator."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
