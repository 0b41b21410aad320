"""Type rules: which columns may be compared, and in which common type."""

from __future__ import annotations

from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def family(dtype: T.DataType) -> str:
    """Types of one family compare by value without a lossy or failing cast."""
    if isinstance(dtype, _INTEGRAL):
        return "integral"
    if isinstance(dtype, (*_FLOATING, T.DecimalType)):
        return "fractional"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, _DATETIME):
        return "date-time"
    return dtype.simpleString()


def is_numeric(dtype: T.DataType) -> bool:
    return family(dtype) in ("integral", "fractional")


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type both sides are cast to before hashing or sorting them together."""
    if a == b:
        return a
    if family(a) != family(b):
        if {family(a), family(b)} != {"integral", "fractional"}:
            return None
        decimal = next((t for t in (a, b) if isinstance(t, T.DecimalType)), None)
        if decimal is None:
            return T.DoubleType()
        # 19 digits hold any integral value.
        whole = max(19, decimal.precision - decimal.scale)
        return T.DecimalType(whole + decimal.scale, decimal.scale) if whole + decimal.scale <= 38 else None
    if family(a) == "integral":
        return T.LongType()
    if family(a) == "string":
        return T.StringType()
    if family(a) == "fractional":
        if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
            scale = max(a.scale, b.scale)
            whole = max(a.precision - a.scale, b.precision - b.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
        return T.DoubleType()
    if family(a) == "date-time":
        zoned = any(isinstance(t, T.TimestampType) for t in (a, b))
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return None


def has_exact_literals(dtype: T.DataType) -> bool:
    """Whether values come back from Python as the literals they were, in any time zone."""
    return isinstance(dtype, (*_INTEGRAL, T.StringType, T.BooleanType, T.DateType, T.DecimalType))


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))
