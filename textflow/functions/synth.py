"""Synthetic values for redacted slots, from a hash of where the slot is: equal on every run and on every machine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textflow.functions import text

#: Names and phone prefixes that stand in for real ones.
NAMES = ("أحمد", "فاطمة", "علي", "سارة", "حسن", "نورا", "يوسف", "مريم", "خالد", "ليلى")
PREFIXES = ("0812", "0813", "0856", "0878")


def seed(*parts: Column) -> Column:
    """The first 8 hex digits of the SHA-1 of the parts, joined by bars, as a number."""
    return F.conv(F.substring(F.sha1(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("bigint")


def _digits(s: Column, n: Column | int) -> Column:
    """n digits (up to 32) from a seed."""
    pool = F.translate(F.sha1(s.cast("string")), "abcdef", "012345")
    return F.substring(pool, F.lit(1), F.lit(n) if isinstance(n, int) else n)


def digits(s: Column, n: Column) -> Column:
    """2 to 16 digits without a leading zero."""
    size = F.greatest(F.lit(2), F.least(F.lit(16), n))
    return F.concat((s % 9 + 1).cast("string"), _digits(s, size - 1))


def name(s: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, NAMES)), (s % len(NAMES)).cast("int") + 1)


def phone(s: Column) -> Column:
    return F.concat(F.element_at(F.array(*map(F.lit, PREFIXES)), (s % len(PREFIXES)).cast("int") + 1), _digits(s, 8))


def card(s: Column) -> Column:
    return F.concat((s % 3 + 4).cast("string"), _digits(s, 15))


def suggestion(token: Column, hint: Column, s: Column) -> Column:
    """struct(policy, suggested_value) by the slot's hint."""
    n = text.digit_length(token)
    one = lambda policy, value: F.struct(F.lit(policy).alias("policy"), value.alias("suggested_value"))
    out = F.when(hint == "pii_phone", one("random_phone", phone(s))).when(hint == "pii_card", one("random_card", card(s))).when(hint == "pii_name", one("random_name", name(s)))
    return out.when((hint == "pii_generic") & (n >= 6), one("random_account_digits", digits(s, n))).otherwise(one("random_digits", digits(s, n)))
