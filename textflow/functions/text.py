"""String functions as Column builders. Patterns that Python reads with Unicode classes carry (?U) here."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Redaction tokens, digit runs, e-mail shapes, Arabic blocks, marks and letters that carry no sound.
REDACTED = r"(?i)\b[A-Z0-9]*X{2,}[A-Z0-9]*\b"
REDACTED_WHOLE = r"(?i)^[A-Z0-9]*X{2,}[A-Z0-9]*$"
LONG_DIGITS = r"(?U)\d{10,}"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ARABIC = "؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿"
ZERO_WIDTH = "​‌‍﻿"
TATWEEL, HARAKAT = "ـ", "ً-ٰٟۖ-ۭ"


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")) == "", F.lit(True))


def collapse(c: Column) -> Column:
    """White space runs become one space, none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def _nfkc(c: pd.Series) -> pd.Series:
    return c.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column) -> Column:
    return F.pandas_udf(_nfkc, "string")(c)


def normalize(c: Column) -> Column:
    """NFKC (the only step without a built-in), then zero-width characters dropped and white space collapsed."""
    return collapse(F.translate(nfkc(c), ZERO_WIDTH, ""))


def for_embedding(c: Column) -> Column:
    return collapse(F.regexp_replace(F.translate(normalize(c), TATWEEL, ""), f"[{HARAKAT}]", ""))


def latin_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("[A-Za-z]+"), F.lit(0))


def script_ratio(c: Column, script: str = ARABIC) -> Column:
    """Share of a script's characters; 0 for an empty text."""
    n = F.length(F.coalesce(c, F.lit("")))
    return F.when(n > 0, F.length(F.regexp_replace(c, f"[^{script}]", "")) / n).otherwise(F.lit(0.0))


def rounded(c: Column, digits: int) -> Column:
    """c rounded as SQL rounds doubles: scaled, then half away from zero. F.round of the digits themselves rounds the shortest
    decimal, which differs where scaling moves a tie (41 / 640 to six digits)."""
    return F.round(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


def redacted_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(REDACTED), F.lit(0))


def redacted_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(REDACTED))


def strip_redacted(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), REDACTED, "")


def redacted_only(c: Column) -> Column:
    """Some text, and every token of it is a redaction."""
    tokens = F.split(collapse(c), " ")
    return ~blank(c) & F.forall(tokens, lambda t: t.rlike(REDACTED_WHOLE))


def digit_length(token: Column) -> Column:
    """Digits that a redaction token stands for, by its number of X."""
    x = F.regexp_count(token, F.lit("(?i)X"))
    return F.when(x >= 9, 12).when(x >= 6, 10).when(x >= 4, 6).when(x >= 3, 3).otherwise(2)


def min_script_ratio(source: Column) -> Column:
    n = redacted_count(source)
    return F.when(n >= 4, 0.20).when(n >= 2, 0.25).when(n >= 1, 0.35).otherwise(0.55)


def pii_shapes(c: Column) -> Column:
    return F.array_compact(F.array(F.when(c.rlike(LONG_DIGITS), "long_digit_sequence"), F.when(c.rlike(EMAIL), "email_shape")))


def word_pattern(word: str, ignore_case: bool = True) -> str:
    """A name as it must stand in a text: short or all-capital ones need neighbours that are no Latin letters."""
    body = re.escape(word).replace(r"\ ", " ")
    edge = len(word) <= 4 or word.isupper()
    return ("(?i)" if ignore_case else "") + (f"(?<![A-Za-z]){body}(?![A-Za-z])" if edge else body)


def once(c: Column) -> Column:
    """c, with a condition that is always true but that the optimizer can't know to be: an expression that others build on
    is then made in its own projection and nowhere else, where the optimizer would copy large ones into filters and
    constraints, level by level."""
    return F.when(F.rand(0) >= 0, c)


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def names_where(pairs: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(c, n) for n, c in pairs))) if pairs else F.array().cast("array<string>")


def error_code(c: Column) -> Column:
    return F.split_part(c, F.lit(":"), F.lit(1))


def leaked_markup(c: Column) -> Column:
    return c.contains("```") | F.ltrim(c).startswith("{")


def truncated(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def short_hash(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 12)


#: How a slot's kind is told from its context, by priority.
HINTS = [
    ("rate", r"koma|persen|percent|فاصلة|في المئة|نسبة|interest|bunga|faedah"),
    ("tenor", r"bulan|tenor|شهر|أشهر|شهور|month|angsuran|cicilan|installment"),
    ("amount", r"ribu|juta|rupiah|روبية|ألف|مليون|amount|biaya|angsuran|nominal"),
    ("date", r"maret|april|mei|juni|juli|agustus|september|oktober|november|desember|januari|februari|tanggal|tgl|مارس|أبريل|مايو|يونيو|يوليو|أغسطس|سبتمبر|أكتوبر|نوفمبر|ديسمبر|يناير|فبراير|تاريخ"),
    ("count", r"\bkali\b|مرات|محاولة|hari kerja|working day|menit|دقيقة"),
    ("pii_card", r"nomor kartu|kartu kredit|kartu debit|رقم البطاقة|بطاقة"),
    ("pii_phone", r"handphone|nomor hp|nomor telepon|هاتف|جوال|hp\b|手机号|电话"),
    ("pii_name", r"\bnama\b|siapa nama|namanya|姓名|名字|اسم"),
    ("pii_generic", r"nomor rekening|rekening|akun|account|رقم الحساب|حساب|账号"),
]


def hint_type(*texts: Column) -> Column:
    blob = F.trim(F.concat_ws(" ", *(F.nullif(t, F.lit("")) for t in texts)))

    def kind(low: Column) -> Column:
        out = F.when(low == "", "unknown")
        for name, pattern in HINTS:
            bare = [(w, w.replace(r"\b", "")) for w in pattern.split("|")]  # words, some with an edge; the edge is looked for last
            out = out.when(any_of([low.contains(b) if b == w else low.contains(b) & low.rlike(f"(?U){w}") for w, b in bare]), name)
        return out.when(low.contains("xx") & (redacted_count(low) >= 3), "pii_generic").otherwise("unknown")

    # a variable of a lambda, so that the text is put into lower case once and not once for each word
    return F.transform(F.array(F.lower(blob)), kind)[0].alias("hint_type")
