"""Text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(value: Column) -> Column:
    """The source database stores an empty string as NULL."""
    return F.nullif(value, F.lit(""))


def null_to_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def null_to_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def num_clean(value: Column) -> Column:
    """Number from text with thousands commas; text that is no plain decimal number counts as 0."""
    plain = F.trim(F.regexp_replace(value, ",", ""))
    return F.coalesce(F.when(plain.rlike(rf"\A(?:{NUMBER})\z"), plain.try_cast("double")), F.lit(0.0))


def leading_number(value: Column) -> Column:
    """Decimal number that a text begins with, NULL where there is none."""
    return blank_to_null(F.regexp_extract(value.cast("string"), rf"\A\s*({NUMBER})", 1)).try_cast("double")


def ticket_number(value: Column) -> Column:
    """Leading whole number of a ticket field, NULL where there is none."""
    digits = F.regexp_extract(value.cast("string"), r"^\s*([+-]?\d+)", 1)
    return blank_to_null(digits).try_cast("bigint")


def ticket_format(number: Column, prefix: str) -> Column:
    """Prefix and the last three digits, zero filled; longer numbers lose their front."""
    padded = F.concat(F.lit("000"), number.cast("string"))
    return F.concat(F.lit(prefix), F.right(padded, F.lit(3)))


def name_from_mail(mail: Column) -> Column:
    """First name guessed from an address: up to ``@``, up to the first dot, capital first."""
    name = F.substring_index(F.substring_index(mail, "@", 1), ".", 1)
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 1 << 30))
