"""Text functions: separators, cleaning of short messages, script tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the cleaning and of the script rule.
FIRST_RETWEET_MARK = r"(?s)^(.*?)RT"
USER_NAME = r"@\p{L}+"
URL_AND_BLANK = r"https?://\S+\s?"
KANA, HANGUL = r"\p{InHiragana}", r"\p{IsHangul}"


def before_first(s: Column, sep: str) -> Column:
    """Text before the first `sep`; the whole text when it is absent."""
    return F.substring_index(s, sep, 1)


def after_first(s: Column, sep: str) -> Column:
    """Text after the first `sep`; empty when it is absent."""
    at = F.instr(s, sep)
    return F.when(at > 0, F.substring(s, at + F.lit(len(sep)), F.length(s))).otherwise(F.lit(""))


def clean_tweet(s: Column) -> Column:
    """Drop the first `RT`, every `@name` and every URL with one blank after it."""
    s = F.regexp_replace(s, FIRST_RETWEET_MARK, "$1")
    s = F.regexp_replace(s, USER_NAME, "")
    return F.regexp_replace(s, URL_AND_BLANK, "")


def one_line(s: Column) -> Column:
    """Every carriage return and line feed becomes a blank."""
    return F.translate(s, "\r\n", "  ")


def script_override(lang: Column, text: Column) -> Column:
    """A detector that answers `lt` for kana or Hangul is corrected to ja / ko.

    Hangul is tested on the corrected code, so a text with both scripts is ja.
    """
    ja = F.when((lang == "lt") & text.rlike(KANA), F.lit("ja")).otherwise(lang)
    return F.when((ja == "lt") & text.rlike(HANGUL), F.lit("ko")).otherwise(ja)


def head_and_rest(s: Column, sep: str) -> tuple[Column, Column]:
    """First field, and the array of the other fields."""
    parts = F.split(s, sep)
    return F.get(parts, F.lit(0)), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; NULL when the whole is zero."""
    return F.try_divide(part * F.lit(100.0), whole)
