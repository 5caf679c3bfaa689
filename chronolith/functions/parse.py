"""Validating parsers as column expressions: a text either obeys the policy and
becomes an exact value, or becomes null with a reason. Nothing is rounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronolith.schemas import D38

# fixed values: the numeric text policy
DECIMAL_TEXT = r"^(0|[1-9][0-9]*)(\.[0-9]+)?$"
SCIENTIFIC_TEXT = r"^([0-9]+)(?:\.([0-9]+))?[eE]([+-]?[0-9]{1,4})$"
MOST_FRACTION, MOST_INTEGER, MOST_DIGITS = 18, 20, 38


def expand_scientific(text: Column) -> Column:
    """``8.4E-7`` as plain digits, by moving the point; other texts unchanged."""
    whole = F.regexp_extract(text, SCIENTIFIC_TEXT, 1)
    part = F.regexp_extract(text, SCIENTIFIC_TEXT, 2)
    power = F.try_to_number(F.regexp_replace(F.regexp_extract(text, SCIENTIFIC_TEXT, 3), r"^\+", ""), F.lit("S99999")).cast("int")
    digits = F.concat(whole, part)
    point = F.length(whole) + power
    left = F.when(point <= 0, F.lit("0")).otherwise(F.rpad(F.substr(digits, F.lit(1), F.greatest(point, F.lit(0))), F.greatest(point, F.lit(1)), F.lit("0")))
    right = F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), digits)).otherwise(F.substr(digits, point + 1))
    plain = F.when(F.length(right) > 0, F.concat(left, F.lit("."), right)).otherwise(left)
    return F.when(text.rlike(SCIENTIFIC_TEXT), plain).otherwise(text)


def decimal_reason(text: Column) -> Column:
    """Why a text is no exact decimal of the policy; null where it is one."""
    whole = F.regexp_replace(F.split_part(text, F.lit("."), F.lit(1)), "^0+", "")
    part = F.regexp_replace(F.when(F.contains(text, F.lit(".")), F.split_part(text, F.lit("."), F.lit(2))).otherwise(F.lit("")), "0+$", "")
    return (
        F.when(text.isNull() | ~text.rlike(DECIMAL_TEXT), F.lit("malformed"))
        .when(F.length(part) > MOST_FRACTION, F.lit("fraction_overflow"))
        .when(F.length(whole) > MOST_INTEGER, F.lit("integer_overflow"))
        .when(F.length(whole) + F.length(part) > MOST_DIGITS, F.lit("precision_overflow"))
    )


def exact_decimal(text: Column) -> Column:
    """The decimal(38,18) of a text that obeys the policy, else null."""
    return F.when(decimal_reason(text).isNull(), text.cast(D38))


def signed_decimal(text: Column) -> Column:
    """As :func:`exact_decimal`, with one leading minus allowed."""
    negative = F.startswith(text, F.lit("-"))
    body = F.when(negative, F.substr(text, F.lit(2))).otherwise(text)
    return F.when(negative, -exact_decimal(body)).otherwise(exact_decimal(body)).cast(D38)


def epoch_ms(text: Column) -> Column:
    """Digits only, as a long; overflow gives null."""
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("bigint"))


def fixed_epoch_ms(text: Column) -> Column:
    """13 digits are milliseconds, 10 digits seconds."""
    return F.when(text.rlike(r"^[0-9]{13}$"), text.try_cast("bigint")).when(text.rlike(r"^[0-9]{10}$"), text.try_cast("bigint") * 1000)


def datetime_ms(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC as epoch milliseconds, else null."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"), F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))))


def int64(text: Column, signed: bool = True) -> Column:
    return F.when(text.rlike(r"^-?[0-9]+$" if signed else r"^[0-9]+$"), text.try_cast("bigint"))


def q18_text(c: Column) -> Column:
    """Exactly 18 places as plain text; the cast fails on more digits than fit."""
    return c.cast(D38).cast("string")
