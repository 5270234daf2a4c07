"""Column expressions for typing landed values.

Every function here maps Columns to Columns and stays inside Catalyst (no
Python UDF).  Parsing uses ``try_cast`` throughout: ANSI mode is on, so a
plain cast of a bad value would fail the whole job instead of one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def _text(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace of any kind (not only blanks)."""
    return F.regexp_replace(_text(c), r"^\s+|\s+$", "")


def try_long(c) -> Column:
    """Text -> BIGINT, NULL when the text is not an integer literal."""
    return strip_ws(c).try_cast("bigint")


# --------------------------------------------------------------------- owners
def owners_range(c) -> tuple[Column, Column]:
    """``"1,000 .. 2,000"`` -> (1000, 2000) as BIGINT.

    NULL, empty, no ``..``, not exactly two sides, or either side not an
    integer after removing commas and surrounding blanks -> (NULL, NULL).
    The caller range-checks against INT and rejects the row when a side does
    not fit (the table column is INT).
    """
    text = _text(c)
    parts = F.split(text, r"\.\.", -1)
    shaped = text.isNotNull() & (F.size(parts) == 2)
    lo = strip_ws(F.regexp_replace(F.get(parts, 0), ",", "")).try_cast("bigint")
    hi = strip_ws(F.regexp_replace(F.get(parts, 1), ",", "")).try_cast("bigint")
    ok = shaped & lo.isNotNull() & hi.isNotNull()
    return F.when(ok, lo), F.when(ok, hi)


# -------------------------------------------------------------------- decimal
_NAN_PATTERN = r"(?i)^[+-]?s?nan[0-9]*$"


def is_decimal_nan(c) -> Column:
    """True for the NaN spellings a decimal parser accepts (rejected rows)."""
    return F.coalesce(strip_ws(c).rlike(_NAN_PATTERN), F.lit(False))


def parse_money(c, scale: int = 100, precision: int = 12) -> Column:
    """Money / percent text -> DECIMAL(precision, 2).

    NULL, ``""`` and ``"0"`` -> 0.00; otherwise value / scale rounded
    half-even to two places; unparsable -> NULL.  The result is wide
    (DECIMAL(38, 2)) so that the caller can range-check before narrowing.
    """
    text = _text(c)
    if scale not in (1, 100):
        raise ValueError("scale is 1 or 100")
    raw = strip_ws(text)

    def rounded(value: Column) -> Column:
        # rounded once, at the place that is the second after dividing; the division then is exact
        if scale == 1:
            return F.bround(value, 2).cast("decimal(38,2)")
        return (F.bround(value, 0).try_cast("decimal(35,0)") * F.lit(1).cast("decimal(1,0)") / F.lit(100).cast("decimal(3,0)")) \
            .cast("decimal(38,2)")

    # 18 decimals decide the rounding; larger numbers keep 10, enough to be rejected by range
    scaled = F.coalesce(rounded(raw.try_cast("decimal(38,18)")), rounded(raw.try_cast("decimal(38,10)")))
    zero = F.lit(0).cast("decimal(38,2)")
    return F.when(text.isNull() | text.isin("", "0"), zero).otherwise(scaled)


def fits_decimal(c: Column, precision: int, scale: int = 2) -> Column:
    """NULL-tolerant range check for DECIMAL(precision, scale)."""
    bound = F.lit(10 ** (precision - scale)).cast(f"decimal({precision - scale + 1},0)")
    return c.isNull() | (F.abs(c) < bound)


# ------------------------------------------------------------------- integers
def parse_int_strict(c) -> tuple[Column, Column]:
    """Text -> (INT value, ok flag).

    ok is False when the source is present but is not an integer in INT
    range; such a row is rejected as a whole (the database refused it).
    """
    text = _text(c)
    wide = strip_ws(text).try_cast("bigint")
    in_range = wide.between(INT_MIN, INT_MAX)
    ok = text.isNull() | (wide.isNotNull() & in_range)
    return F.when(ok, wide.cast("int")), ok


def fits_int(c: Column) -> Column:
    return c.isNull() | c.between(INT_MIN, INT_MAX)


# ---------------------------------------------------------------------- time
def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive ``datetime`` (or ISO text).

    ``F.lit(datetime)`` goes through the Python process's local zone; the
    text form does not, so the value is the same wall clock everywhere.
    """
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


#: Epoch seconds of the first and of the last second that a timestamp may have (years 1 to 9999).
EPOCH_MIN, EPOCH_MAX = -62135596800, 253402300799


def epoch_ok(c) -> Column:
    """Whether epoch seconds lie in the years 1 to 9999 (NULL: NULL)."""
    return _text(c).between(EPOCH_MIN, EPOCH_MAX)


def epoch_to_ts(c) -> Column:
    """Epoch seconds (integral or fractional) -> UTC TIMESTAMP_NTZ; NULL outside the years 1 to 9999."""
    seconds = _text(c).try_cast("decimal(38,6)")
    micros = (F.when(epoch_ok(seconds), seconds) * F.lit(1000000)).cast("bigint")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def ts_to_epoch(c) -> Column:
    """UTC TIMESTAMP_NTZ -> epoch seconds (BIGINT)."""
    return F.unix_seconds(_text(c).cast("timestamp"))


def ts_id(c) -> Column:
    """Deterministic surrogate id of a timestamp: its epoch microseconds.

    The timestamp column is UNIQUE, so the id needs no coordination between
    tasks or runs (M1).
    """
    return F.unix_micros(_text(c).cast("timestamp"))


def date_parts(c) -> dict[str, Column]:
    """The generated columns of the timestamp dimension."""
    ts = _text(c)
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "weekday": iso_weekday(ts),
    }


def iso_weekday(c) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return (F.weekday(_text(c)) + 1).cast("int")


# ------------------------------------------------------------- small helpers
def first_tag(tags) -> Column:
    """First array element as text, NULL for NULL / empty arrays."""
    return F.get(_text(tags), 0)


def tags_or_empty(tags) -> Column:
    return F.coalesce(_text(tags), F.array().cast("array<string>"))


def tags_json(tags) -> Column:
    return F.to_json(tags_or_empty(tags))


def truthy(c) -> Column:
    return F.coalesce(_text(c).cast("boolean"), F.lit(False))


def truthy_variant(c) -> Column:
    """Truth of any JSON value: false for missing, null, false, zero and empty values, else true."""
    v = F.col(c) if isinstance(c, str) else c
    kind = F.call_function("schema_of_variant", v)
    as_text = F.call_function("try_variant_get", v, F.lit("$"), F.lit("string"))
    falsy = ((kind == "VOID") | ((kind == "BOOLEAN") & (as_text == "false")) | ((kind == "STRING") & (as_text == ""))
             | kind.isin("OBJECT<>", "ARRAY<>", "ARRAY<VOID>") & as_text.isin("{}", "[]")
             | (kind.rlike("INT|DECIMAL|DOUBLE|FLOAT") & (as_text.try_cast("double") == 0)))
    return F.when(v.isNull(), False).otherwise(~F.coalesce(falsy, F.lit(False)))


def gid_text(c) -> Column:
    """News id as inserted: missing / NULL -> ''."""
    return F.coalesce(_text(c).cast("string"), F.lit(""))


def safe_ratio(numerator, denominator) -> Column:
    """``num / NULLIF(COALESCE(den, 0), 0)`` as DOUBLE."""
    den = F.coalesce(_text(denominator), F.lit(0))
    return _text(numerator).cast("double") / F.nullif(den, F.lit(0)).cast("double")
