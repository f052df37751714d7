"""Number coercion, null handling and the draws used to make up representative events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Characters of an ordinary number. Anything else a cast would take is either spelled out
# below or one of the JVM's own forms ("1d", "0x1p3"), which no producer means as a number.
PLAIN_NUMBER = r"^[0-9.eE+-]+\z"

# The other texts that stand for a number, in lower case and without quotes.
SPECIAL_NUMBERS = {
    "true": 1.0, "false": 0.0, "nan": float("nan"), "inf": float("inf"),
    "infinity": float("inf"), "-inf": float("-inf"), "-infinity": float("-inf"),
}


def text_to_double(text: Column) -> Column:
    """Number written in ``text``, NULL when it is none; JSON true and false count 1 and 0."""
    # The JSON reader hands a bare NaN or Infinity over in quotes.
    bare = F.btrim(text, F.lit(' \t\r\n"'))
    special = F.when(bare.rlike(PLAIN_NUMBER), bare.try_cast("double"))
    for name, value in SPECIAL_NUMBERS.items():
        special = special.when(F.lower(bare) == name, F.lit(value))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).otherwise(special)


def not_a_number(text: Column) -> Column:
    """True when a value is present but cannot be read as a number."""
    return text.isNotNull() & text_to_double(text).isNull()


def null_if_zero(count: Column) -> Column:
    return F.nullif(count, F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL when the whole is zero or NULL."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def weighted_choice(draw: Column, options: Sequence[str], weights: Sequence[int]) -> Column:
    """The option whose cumulative weight range holds ``draw`` (0 <= draw < sum of weights)."""
    if len(options) != len(weights) or not options:
        raise ValueError("one weight per option is needed")
    choice, bound = None, 0
    for option, weight in zip(options, weights):
        bound += weight
        branch = F.when if choice is None else choice.when
        choice = branch(draw < bound, F.lit(option))
    return choice


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def text_to_ts(text: Column) -> Column:
    """Timestamp from ISO text; NULL when it is none (ANSI mode would raise)."""
    return F.try_to_timestamp(text)
