"""Coercions in the two dialects that records use, as Column expressions.

The *pipeline* dialect strips and knows only true and false; the *judge*
dialect does not strip, knows a few more words, and falls back to null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of a Unicode-aware trim, which plain trim() is not.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def to_bool(c: Column, compat: bool = False) -> Column:
    """Text to boolean: true for "true" in any case, else false; null is false.

    ``compat`` takes every substring of "true" for true, "" included.
    """
    s = F.lower(strip(c))
    hit = F.instr(F.lit("true"), s) > 0 if compat else s == "true"
    return F.coalesce(hit | (F.lit(compat) & (s == "")), F.lit(False))


def number_to_bool(c: Column) -> Column:
    """True for a number other than 0; null is false."""
    return F.coalesce(c != 0, F.lit(False))


def to_double(c: Column, default: float | None = None) -> Column:
    """Text to double; blank or unreadable text gives the default."""
    s = strip(c)
    return F.coalesce(F.when(s.rlike(_NUMBER), s.try_cast("double")), F.lit(default).cast("double"))


def to_int(c: Column, default: int | None = None) -> Column:
    """Text to integer through a double, cut towards zero; what is no finite number gives the default."""
    return F.coalesce(to_double(c).try_cast("int"), F.lit(default).cast("int"))


def judge_bool(c: Column) -> Column:
    """Text to boolean without stripping; null is false."""
    return F.coalesce(F.lower(c).isin("true", "1", "yes", "on"), F.lit(False))


def judge_int(c: Column) -> Column:
    """Whole-number text to integer; anything else, "2.0" included, is null."""
    return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("int"))


def judge_double(c: Column) -> Column:
    return to_double(c)


class JsonField:
    """A field of a JSON object with its type: numbers and booleans are read as such, text by a dialect's rule."""

    def __init__(self, payload: Column, key: str):
        self.text = F.get_json_object(payload, f"$.{key}")
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(payload), f"$.{key}", "variant"))
        self.is_number, self.is_bool = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), kind == "BOOLEAN"
        self.number = self.text.try_cast("double")

    def boolean(self, rule: Callable[[Column], Column]) -> Column:
        """A number is true unless it is 0."""
        own = F.when(self.is_number, number_to_bool(self.number)).when(self.is_bool, self.text == "true").otherwise(rule(self.text))
        return F.coalesce(own, F.lit(False))

    def integer(self, rule: Callable[[Column], Column]) -> Column:
        """A number is cut towards zero, a boolean is 1 or 0."""
        return F.when(self.is_number, self.number.try_cast("int")).when(self.is_bool, (self.text == "true").cast("int")).otherwise(rule(self.text))

    def double(self, rule: Callable[[Column], Column]) -> Column:
        return F.when(self.is_number, self.number).when(self.is_bool, (self.text == "true").cast("double")).otherwise(rule(self.text))


def round_mean(c: Column, places: int = 3) -> Column:
    """The decimal of ``places`` (7 at most) nearest to the exact value of a double; one exactly between two goes to the even one.

    The scaled value is kept as a double and the error of its product, which is
    a double, too: the number's halves of 26 bits multiply without error.  Numbers of
    2^52 and more when scaled stay as they are.
    """
    if not 0 <= places <= 7:
        raise ValueError("0 to 7 places")
    scale = float(10**places)
    high = c * 134217729.0 - (c * 134217729.0 - c)
    scaled = c * scale
    error = (c - high) * scale - (scaled - high * scale)
    low = F.floor(scaled).cast("double")
    beyond = (scaled - (low + 0.5)) + error
    whole = F.when((beyond > 0) | ((beyond == 0) & (low % 2 != 0)), low + 1).otherwise(low)
    return F.when(F.abs(scaled) < 2.0**52, whole / scale).otherwise(c)


def as_flag_text(c: Column) -> Column:
    """The text form of a flag in JSON outputs."""
    return F.when(c, "True").otherwise("False")
