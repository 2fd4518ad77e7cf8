"""Column expressions for the value model of time-series tables.

Sentinels count as NULL and are normalised once, at ingest; booleans and small
integers have no NULL; readers that want zeros for NULL ask for them.
"""

from __future__ import annotations

from decimal import Context, Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Enough digits for any 256-bit number.
_WIDE = Context(prec=90)
#: Fixed value: the 64-bit integer that stands for NULL on the wire.
NULL_LONG = -(1 << 63)
#: Types without NULL and what stands in.
NOT_NULL = {"boolean": "false", "tinyint": "0", "smallint": "0"}


def normalised(column: Column, kind: str) -> Column:
    """NULL for sentinels; the zero value for types that have no NULL."""
    if kind in NOT_NULL:
        return F.coalesce(column, F.expr(f"cast({NOT_NULL[kind]} as {kind})"))
    if kind in ("double", "float"):
        return F.when(~F.isnan(column), column)
    return F.when(column != NULL_LONG, column) if kind == "bigint" else column


def or_zero(column: Column, kind: str) -> Column:
    """What typed readers give for NULL."""
    zero = {"string": "''", "boolean": "false"}.get(kind, f"cast(0 as {kind})")
    return F.coalesce(column, F.expr(zero))


def decimal_unscaled(column: Column, scale: int) -> Column:
    """The whole number that a decimal of this scale is stored as."""
    return (column.cast(f"decimal(18,{scale})") * F.lit(10**scale)).cast("bigint")


def uuid_text(high: Column, low: Column) -> Column:
    """Canonical text of a UUID from its two halves."""
    h, l = (F.lpad(F.lower(F.hex(x)), 16, "0") for x in (high, low))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(l, 1, 4), F.substring(l, 5, 12))


def geohash_masked(column: Column, bits: int) -> Column:
    """A geohash cut to its precision."""
    return column.bitwiseAND(F.lit((1 << bits) - 1))


def ipv4_text(column: Column) -> Column:
    return F.concat_ws(".", *(F.shiftright(column, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)))


def long256(hex_digits: Column) -> Column:
    """Sortable 32-byte form of an unsigned 256-bit number given in hex; NULL if too long or not hex."""
    digits = F.regexp_replace(F.lower(hex_digits), "^0x", "")
    return F.when(digits.rlike("^[0-9a-f]{1,64}$"), F.unhex(F.lpad(digits, 64, "0")))


def is_char(column: Column) -> Column:
    """Exactly one character of the basic plane (at most three bytes of UTF-8)."""
    return F.coalesce((F.char_length(column) == 1) & (F.octet_length(column) <= 3), F.lit(False))


def date_of_millis(column: Column) -> Column:
    """A date value, which counts milliseconds."""
    return F.timestamp_millis(column)


def decimal_of_text(text: Column, precision: int = 38, scale: int = 10) -> Column:
    """A decimal from text, exponents included; NULL for NaN, infinities and what doesn't fit."""
    return text.try_cast(f"decimal({precision},{scale})")


def decimal_of_parts(coefficient: Column, exponent: Column) -> Column:
    """coefficient x 10^exponent as struct(unscaled, scale): no digits are lost, positive exponents are worked in."""
    digits = F.concat(coefficient.cast("string"), F.repeat(F.lit("0"), F.greatest(exponent, F.lit(0)).cast("int")))
    unscaled, scale = digits.try_cast("decimal(38,0)"), F.greatest(-exponent, F.lit(0)).cast("int")
    return F.when(unscaled.isNotNull() & (scale <= 76), F.struct(unscaled.alias("unscaled"), scale.alias("scale")))


def twos_complement(column: Column) -> Column:
    """A whole number as the fewest bytes of two's complement, big end first."""
    n = F.lit(8)
    for k in range(7, 0, -1):
        n = F.when(column.between(-(1 << (8 * k - 1)), (1 << (8 * k - 1)) - 1), k).otherwise(n)
    return F.unhex(F.right(F.lpad(F.hex(column), 16, "0"), 2 * n))


def decimal256(text: Column, scale: int) -> Column:
    """32 sortable bytes of a decimal in text, scaled to a whole number; NULL unless it fits exactly.

    Spark's decimals end at 38 digits; these have up to 76.
    """

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        return pa.array([_encoded(t, scale) for t in texts.to_pylist()], pa.binary())

    return encoded(text)


def _encoded(text: str | None, scale: int) -> bytes | None:
    try:
        value = Decimal(text or "").scaleb(scale, _WIDE)
    except (InvalidOperation, ValueError):
        return None
    if not value.is_finite() or value != value.to_integral_value() or not -(1 << 255) <= int(value) < 1 << 255:
        return None
    return (int(value) + (1 << 255)).to_bytes(32, "big")  # sorts as the number does


def decimal256_text(encoded: Column, scale: int) -> Column:
    """The number back as text with all places of its scale."""

    @F.arrow_udf("string")
    def decoded(values: pa.Array) -> pa.Array:
        numbers = (None if v is None else int.from_bytes(v, "big") - (1 << 255) for v in values.to_pylist())
        return pa.array([None if n is None else format(Decimal(n).scaleb(-scale, _WIDE), "f") for n in numbers], pa.string())

    return decoded(encoded)


def ipv4_value(text: Column) -> Column:
    """The number of a dotted address; NULL if it is none."""
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("bigint"))
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p)
    octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
    return F.when(text.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), value)


def random_binary(key: Column, low: int, high: int, nulls: int, seed: int = 1) -> Column:
    """Bytes drawn by a key: low to high long, NULL for one key in ``nulls`` (0: never)."""
    length = F.lit(low) + F.pmod(F.xxhash64(F.lit(seed), key), F.lit(high - low + 1))
    blocks = F.transform(F.sequence(F.lit(0), F.lit(-(-high // 32))), lambda i: F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string")), 256))
    data = F.substring(F.unhex(F.array_join(blocks, "")), F.lit(1), length.cast("int"))
    return F.when(F.pmod(F.xxhash64(F.lit(-seed), key), F.lit(nulls)) > 0, data) if nulls else data


def varint_bytes(column: Column) -> Column:
    """Length of an unsigned number in base-128."""
    size = F.lit(10)
    for n in range(9, 0, -1):
        size = F.when(column < F.lit(1 << min(62, 7 * n)), n).otherwise(size)
    return F.when(column < 0, 10).otherwise(size)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
