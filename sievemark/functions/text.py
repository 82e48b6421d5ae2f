"""Text shaping used by readers and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

STRINGS = "array<string>"


def empty_strings() -> Column:
    return F.array().cast(STRINGS)


def strip(col: Column) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def preview(col: Column, chars: int, newline: str | None = None) -> Column:
    """The first ``chars`` code points; newlines replaced when asked."""
    cut = F.substring(col, 1, chars)
    return cut if newline is None else F.replace(cut, F.lit("\n"), F.lit(newline))


def sample(values: Column, count: int = 5, separator: str = "|") -> Column:
    """The first ``count`` strings joined by ``separator``."""
    return F.concat_ws(separator, F.slice(values, 1, count))


def quoted_sample(values: Column, count: int = 6) -> Column:
    """The first ``count`` strings as «a», «b»."""
    return F.concat_ws(", ", F.transform(F.slice(values, 1, count), lambda v: F.concat(F.lit("«"), v, F.lit("»"))))


def iso_utc(timestamp: Column) -> Column:
    """ISO text of an instant, in UTC and without a zone suffix."""
    return F.date_format(F.to_utc_timestamp(timestamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# Digits read as letters inside words that hold a letter, and those letters.
DIGITS, DIGIT_LETTERS = "0134", "oiea"
_TOKENS = r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"


def digits_as_letters(text: Column, digits: str = DIGITS, letters: str = DIGIT_LETTERS) -> Column:
    """The text with ``digits`` read as ``letters`` in words that hold a letter.

    Character for character: the result is as long as the text and every position
    keeps its meaning, so matches in it are matches at the same places in the text.
    Numbers and other words stay as they are.
    """
    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    spelled = F.transform(
        tokens,
        lambda t: F.when(t.rlike(r"(?U)\p{L}") & t.rlike(f"[{digits}]"), F.translate(t, digits, letters)).otherwise(t),
    )
    return F.when(text.isNotNull(), F.array_join(spelled, ""))


def original_wording(text: Column, found: Column, digits: str = DIGITS, letters: str = DIGIT_LETTERS) -> Column:
    """The first place of ``text`` whose digits-as-letters reading is ``found``, as written there;
    ``found`` itself where there is none."""
    spelled_as = {letter: digit for digit, letter in zip(digits, letters)}

    def one(c: Column) -> Column:
        lowered = F.lower(c)
        case = F.when(F.lit(False), F.lit(""))
        for letter, digit in spelled_as.items():
            case = case.when(lowered == letter, F.lit(f"[{letter}{digit}]"))
        return case.otherwise(F.concat(F.lit("\\Q"), c, F.lit("\\E")))

    pattern = F.concat(F.lit("(?iU)"), F.array_join(F.transform(F.split(found, ""), one), ""))
    located = F.call_function("regexp_extract", text, pattern, F.lit(0))
    return F.when(located != "", located).otherwise(found)
