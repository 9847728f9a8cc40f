"""Text and number coercion shared by every mapping.

Services send blanks, literal null words and numbers as text. These expressions give one policy:
null words become null, text loses its surrounding whitespace, and text is read as a number
exactly when Python's ``float`` would read it. A numeric NaN counts as missing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that means "no value", compared after stripping and lower-casing.
NULL_WORDS = ("", "none", "null", "nan")

# The characters Python's str.strip() removes.
WHITESPACE = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Fixed value: what Python's float() accepts, once stripped (NaN is handled as missing).
NUMBER_PATTERN = (
    r"^[+-]?(?:(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?|(?i:inf|infinity))$"
)


def quoted(name: str) -> Column:
    """A column by exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


_LONGEST_NULL_WORD = max(map(len, NULL_WORDS))
_PLAIN_NUMBER = "0123456789.+-eE"
_STRIPPED = "_stripped_"


def _all_digits() -> tuple[str, str]:
    """The decimal digits of every script and the ASCII digits they stand for."""
    found = [c for c in map(chr, range(0x80, 0x11_0000)) if unicodedata.category(c) == "Nd"]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


_DIGITS = _all_digits()


def strip(value: Column) -> Column:
    """Remove surrounding whitespace, tabs and line breaks included.

    Spaces go first, which is cheap and nearly always all there is; only text that then begins or
    ends with anything but printable ASCII needs the whole set.
    """
    text = F.trim(value.cast("string"))
    plain = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def text_of_stripped(text: Column) -> Column:
    """Stripped text with blanks and null words as null."""
    kept = (F.length(text) > _LONGEST_NULL_WORD) | ~F.lower(text).isin(*NULL_WORDS)
    return F.when(kept, text)


def number_of_stripped(text: Column) -> Column:
    """Stripped text to double. Digits, signs and exponents need only the cast."""
    plain = F.translate(text, _PLAIN_NUMBER, "") == ""
    foreign = F.translate(text, *_DIGITS)
    return (
        F.when(plain, text.try_cast("double"))
        .when(text.rlike(NUMBER_PATTERN), _unscored(text))
        .when((F.octet_length(text) > F.length(text)) & foreign.rlike(NUMBER_PATTERN), _unscored(foreign))
    )


def _unscored(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit("")).try_cast("double")


def clean_text(value: Column) -> Column:
    """Stripped text, or null for blanks and null words."""
    return text_of_stripped(strip(value))


def fold_nan(value: Column) -> Column:
    """A double with NaN replaced by null."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def parse_number(value: Column) -> Column:
    """Text to double; anything Python's ``float`` rejects becomes null."""
    return number_of_stripped(strip(value))


def clean_double(value: Column, dtype: T.DataType) -> Column:
    """Double from a column of any type: numbers pass through, text is parsed."""
    if isinstance(dtype, T.StringType):
        return parse_number(value)
    if isinstance(dtype, T.NumericType):
        return fold_nan(value)
    if isinstance(dtype, T.BooleanType):
        return value.cast("double")
    return parse_number(value.cast("string"))


def clean_long(value: Column, dtype: T.DataType) -> Column:
    """Whole number read through double, truncating; unreadable or out of range becomes null."""
    if isinstance(dtype, T.IntegralType):
        return value.cast("bigint")
    return clean_double(value, dtype).try_cast("bigint")


def with_stripped(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Strips the named text columns once, beside the originals, for the readers below.

    They use a value several times; a projection of its own keeps it from being computed again.
    """
    text = [
        n for n in dict.fromkeys(names)
        if n in df.columns and isinstance(df.schema[n].dataType, T.StringType)
    ]
    return df.withColumns({_STRIPPED + n: strip(quoted(n)) for n in text}) if text else df


def text_of(df: DataFrame, name: str) -> Column:
    """Cleaned text of ``df[name]``; a typed null when the column is absent."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    if _STRIPPED + name in df.columns:
        return text_of_stripped(quoted(_STRIPPED + name))
    return clean_text(quoted(name))


def double_of(df: DataFrame, name: str) -> Column:
    """Cleaned double of ``df[name]``; a typed null when the column is absent."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    if _STRIPPED + name in df.columns:
        return number_of_stripped(quoted(_STRIPPED + name))
    return clean_double(quoted(name), df.schema[name].dataType)


def long_of(df: DataFrame, name: str) -> Column:
    """Cleaned whole number of ``df[name]``; a typed null when the column is absent."""
    if name not in df.columns:
        return F.lit(None).cast("bigint")
    if _STRIPPED + name in df.columns:
        return number_of_stripped(quoted(_STRIPPED + name)).try_cast("bigint")
    return clean_long(quoted(name), df.schema[name].dataType)
