"""Typed conversion on the way in and on the way out, as plain column expressions."""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundhaul.contracts import Column as ContractColumn
from roundhaul.contracts import Contract, named
from roundhaul.session import local_table

FLOATS = (T.FloatType, T.DoubleType)


class ShapeMismatch(ValueError):
    """The incoming columns are not the columns of the contract."""


# A number in text: sign, whole digits, fraction, exponent.
_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,3}))?\s*$"
# A zone behind a time of day, which a timestamp without a zone would drop.
_ZONE = r":\d\d(\.\d*)?\s*(Z|UTC|GMT|UT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z_]+/[A-Za-z_/]+)\s*$"
# Digits of a second beyond the microsecond.
_SHORTER = r"\.\d{6}\d*[1-9]"


def plain_number(text: Column) -> Column:
    """A number in text as its digits alone, without exponent or zeros that say nothing; NULL for other text.

    Two texts stand for the same number exactly if these are equal, however many digits they have.
    """
    sign, whole, fraction, power = (F.regexp_extract(text, _NUMBER, i) for i in range(1, 5))
    digits = F.concat(whole, fraction)
    point = F.length(whole) + F.when(power == "", 0).otherwise(power.try_cast("int"))
    size = F.length(digits)
    before = F.when(point <= 0, "").when(point >= size, F.rpad(digits, point, "0")).otherwise(F.substring(digits, F.lit(1), point))
    zeros = F.when(point < 0, F.repeat(F.lit("0"), -point)).otherwise("")
    after = F.when(point <= 0, F.concat(zeros, digits)).when(point >= size, "").otherwise(F.substring(digits, point + 1, size))
    before, after = F.ltrim(before, F.lit("0")), F.rtrim(after, F.lit("0"))
    minus = F.when((sign == "-") & (F.concat(before, after) != ""), "-").otherwise("")
    return F.when(text.rlike(_NUMBER) & (size > 0), F.concat(minus, before, F.lit("."), after))


def _same_number(text: Column, value: Column) -> Column:
    """Whether text stands for exactly this number, told by its digits."""
    written = value.cast("string")
    return (text == written) | (plain_number(text) == plain_number(written))


def _unchanged(column: Column, value: Column, source: T.DataType | None, to: T.DataType) -> Column | None:
    """Whether a cast gave back the same value; None where the types leave nothing to lose.

    NULL, where the comparison cannot be made, counts as changed.
    """
    exact = (T.IntegralType, T.DecimalType)
    if isinstance(source, T.NumericType) and isinstance(to, (*exact, *FLOATS)):
        back = value.try_cast(source)
        if isinstance(source, FLOATS) and isinstance(to, T.DecimalType):
            # The last binary digits of a sum such as 5.1000000000000005 are no loss where they lie far
            # below the last digit of the decimal.
            digits = 23 if isinstance(source, T.FloatType) else 52
            gap = F.abs(back - column)
            noise = (gap <= F.abs(column) * 2.0 ** (1 - digits)) & (gap < 0.125 * 10.0**-to.scale)
            return (back == column) | noise
        same = back == column
        # 2^63 is no long, but casts to the largest one and back.
        if isinstance(source, T.LongType) and isinstance(to, FLOATS):
            return same & (value.cast("double") < 2.0**63)
        return same & (column < 2.0**63) if isinstance(source, FLOATS) and isinstance(to, T.LongType) else same
    if isinstance(source, T.NumericType) and isinstance(to, T.BooleanType):
        return column.isin(0, 1)
    if isinstance(source, T.StringType):
        if isinstance(to, exact):
            return _same_number(column, value)
        if isinstance(to, FLOATS):
            special = F.isnan(value) | (F.abs(value) == float("inf"))
            told = column.rlike(r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$")
            return F.when(special, told).otherwise(_same_number(column, value))
        if isinstance(to, T.DateType):
            return column.try_cast("timestamp_ntz") == value.cast("timestamp_ntz")
        if isinstance(to, T.TimestampNTZType):
            return ~column.rlike(_SHORTER) & ~column.rlike(_ZONE)
        if isinstance(to, (T.TimestampType, T.TimeType)):
            return ~column.rlike(_SHORTER)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(to, T.DateType):
        return value.try_cast(source) == column
    return None


def fitting(column: Column, to: T.DataType, source: T.DataType | None = None, rounding: bool = False) -> Column:
    """Cast; NULL for a value that does not fit or, without ``rounding``, would be changed."""
    value = column.try_cast(to)
    same = None if rounding else _unchanged(column, value, source, to)
    return value if same is None else F.when(same, value)


def in_range(value: Column, wanted: ContractColumn) -> Column | None:
    """Whether a value lies in the declared range; None where there is none narrower than its type."""
    bounds = wanted.declared.range if wanted.declared else None
    return None if bounds is None else value.between(*bounds)


def strict_cast(
    column: Column, to: T.DataType, name: str, source: T.DataType | None = None, rounding: bool = False
) -> Column:
    """Cast, and stop the job on a value that does not fit or would be changed.

    Does not rely on ANSI mode: with it off a plain cast would turn such a value into NULL.
    """
    refusal = F.raise_error(F.lit(f"{name}: value does not fit {to.simpleString()}"))
    return F.coalesce(fitting(column, to, source, rounding), F.when(column.isNotNull(), refusal))


def conform(
    df: DataFrame, contract: Contract, tolerant: bool = False, rounding: Collection[str] = ()
) -> DataFrame:
    """Give every column its contract type and every row the contract's column order.

    A value that does not fit its type or declared range, or that the conversion would change,
    stops the job, or becomes NULL when ``tolerant``: numbers that lose digits, also from or into text and
    floats; bits other than 0 and 1; days with a time of day; timestamps in text with more than
    microseconds or, for a type without one, a zone. Columns named in ``rounding`` may be
    rounded. NaN counts as missing where the contract has no place for it. Text may be longer
    than declared.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in contract.names if n not in present]
    extra = [n for n in present if n not in contract.names]
    if missing or extra:
        raise ShapeMismatch(f"{contract.name}: missing columns {missing}, unexpected columns {extra}")
    columns = []
    for wanted in contract.columns:
        value = named(wanted.name)
        floating = isinstance(present[wanted.name], FLOATS)
        if floating and not isinstance(wanted.type, FLOATS):
            value = nan_to_null(value)
        if wanted.declared and wanted.declared.name == "time" and isinstance(wanted.type, T.StringType):
            value = time_text(value)
        elif present[wanted.name] != wanted.type:
            cast = fitting if tolerant else partial(strict_cast, name=wanted.name)
            value = cast(value, to=wanted.type, source=present[wanted.name], rounding=wanted.name in rounding)
        within = in_range(value, wanted)
        if within is not None:
            refusal = F.raise_error(F.lit(f"{wanted.name}: value does not fit {wanted.declared.name}"))
            value = F.when(within, value) if tolerant else F.when(value.isNull() | within, value).otherwise(refusal)
        columns.append(value.alias(wanted.name))
    return df.select(*columns)


def as_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows of an older or newer shape in the contract's: missing columns are NULL, others are converted strictly."""
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for wanted in contract.columns:
        kind = present.get(wanted.name)
        if kind is None:
            value = F.lit(None).cast(wanted.type)
        elif kind != wanted.type:
            value = strict_cast(named(wanted.name), wanted.type, wanted.name, kind)
        else:
            value = named(wanted.name)
        columns.append(value.alias(wanted.name))
    return df.select(*columns)


def _checked(df: DataFrame, contract: Contract) -> list[tuple[str, Column, Column]]:
    """Per column that changes type or has a declared range: its name, which values change, which lie outside."""
    present = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for wanted in contract.columns:
        source = present.get(wanted.name, wanted.type)
        value = named(wanted.name)
        if isinstance(source, FLOATS) and not isinstance(wanted.type, FLOATS):
            value = nan_to_null(value)
        cast = fitting(value, wanted.type, source) if source != wanted.type else value
        within = in_range(cast, wanted)
        if source != wanted.type or within is not None:
            outside = F.lit(False) if within is None else F.coalesce(~within, F.lit(False))
            found.append((wanted.name, value.isNotNull() & cast.isNull(), outside))
    return found


def rejected_values(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per column that changes type: how many values a tolerant conversion would lose.

    ``lossy_values`` also has the columns that keep their type but have a declared range.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    changing = {c.name for c in contract.columns if present.get(c.name, c.type) != c.type}
    lost = [(name, changed | outside) for name, changed, outside in _checked(df, contract) if name in changing]
    if not lost:
        return local_table(df.sparkSession, [], "column_name string, rejected bigint")
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in lost])
    return counts.unpivot([], [named(name) for name, _ in lost], "column_name", "rejected")


def lossy_values(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per column that changes type or has a declared range: how many values the conversion
    would change, and how many lie outside the range."""
    checked = _checked(df, contract)
    if not checked:
        return local_table(df.sparkSession, [], "column_name string, changed bigint, out_of_range bigint")
    counts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(changed).alias("changed"),
            F.count_if(outside).alias("out_of_range"),
        )
        for name, changed, outside in checked
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def exact_decimal(column: Column, precision: int, scale: int) -> Column:
    """Text or number to a decimal of fixed scale; NULL, NaN and non-numbers give NULL."""
    return column.try_cast(T.DecimalType(precision, scale))


def time_text(column: Column) -> Column:
    """A time of day as text without trailing zeros, so that declared precision does not matter."""
    text = column.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def bit_to_boolean(column: Column) -> Column:
    """0 and 1 to false and true; NULL stays NULL."""
    return column.cast("boolean")


def boolean_to_bit(column: Column) -> Column:
    """False and true to 0 and 1; NULL stays NULL."""
    return column.cast("int")


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def timestamp_ms_text(column: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, cut (not rounded) to milliseconds.

    Built from the cast to text, which for a zone-less timestamp does not depend on the
    session's time zone.
    """
    text = column.cast("string")
    with_point = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(with_point, len("yyyy-MM-dd HH:mm:ss.SSS"), "0")


def export_form(
    df: DataFrame,
    *,
    timestamps_as_text: bool = False,
    times_as_text: bool = False,
    booleans_as_bits: bool = False,
    decimals_as_double: bool = False,
) -> DataFrame:
    """The rows as they go to a relational target.

    NaN always becomes NULL, because relational floats have no NaN. Decimals stay exact and
    timestamps and booleans native unless asked for otherwise; binary passes through.
    """
    columns = []
    for field in df.schema.fields:
        value = named(field.name)
        if isinstance(field.dataType, FLOATS):
            value = nan_to_null(value)
        elif timestamps_as_text and isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = timestamp_ms_text(value)
        elif times_as_text and isinstance(field.dataType, T.TimeType):
            value = value.cast("string")
        elif booleans_as_bits and isinstance(field.dataType, T.BooleanType):
            value = boolean_to_bit(value)
        elif decimals_as_double and isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        columns.append(value.alias(field.name))
    return df.select(*columns)
