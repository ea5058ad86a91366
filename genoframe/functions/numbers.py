"""Typing of numeric text: which strings count as numbers, and their JSON form.

Casts run behind a pattern. Inside a lambda a ``try_cast`` that fails costs an
exception, which is far more than the pattern.
"""

from __future__ import annotations

from genoframe.functions.text import WHITESPACE, let, literal

# ``$`` also matches before a line separator at the end, so patterns end in ``\z``.
PADDING = "[" + "".join(rf"\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]*"


def whole(pattern: str) -> str:
    """The pattern for all of a text."""
    return rf"\A{pattern}\z"


# The accepted spellings of numbers.
DIGITS = r"[0-9]+(?:_[0-9]+)*"
EXPONENT = rf"(?:[eE][+-]?{DIGITS})?"
INTEGER = whole(rf"{PADDING}[+-]?{DIGITS}{PADDING}")
SHORT_INTEGER = whole(r"[+-]?[0-9]{1,18}")
DOTTED_FLOAT = whole(
    rf"{PADDING}[+-]?(?:{DIGITS}\.(?:{DIGITS})?|\.{DIGITS}){EXPONENT}{PADDING}"
)
ANY_FLOAT = whole(
    rf"{PADDING}[+-]?(?:(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS}){EXPONENT}"
    rf"|(?i:nan|inf|infinity)){PADDING}"
)
# Numbers whose text already is the JSON text that the general rules arrive at, and
# comma lists of them: no padding, no zeros at either end, at most 15 digits, not so
# small that an exponent would be shorter.
TIDY_NUMBER = r"-?(?:0|[1-9][0-9]{0,8})(?:\.(?!0000)(?:0|[0-9]{0,5}[1-9]))?"
TIDY = rf"{TIDY_NUMBER}(?:,{TIDY_NUMBER})*"
TIDY_NUMBERS = whole(TIDY)
# Text without grouping and padding: it is a short integer, or none.
PLAIN_TEXT = whole(r"[^_\x00-\x20\x{80}-\x{10ffff}]*")
# JSON has no infinity; a literal beyond the double range reads back as one.
INFINITY_JSON = "1e999"


def _plain(text: str) -> str:
    """Number text without digit grouping and padding."""
    return f"translate({text}, {literal('_' + WHITESPACE)}, '')"


def integer(text: str) -> str:
    """BIGINT value of integer text, NULL for anything else."""
    return (
        f"CASE WHEN {text} RLIKE r'{SHORT_INTEGER}' THEN try_cast({text} AS bigint) "
        f"WHEN {text} RLIKE r'{INTEGER}' THEN try_cast({_plain(text)} AS bigint) END"
    )


def is_float(text: str) -> str:
    """True for text that denotes a floating point number, NaN and infinity included."""
    return f"{text} RLIKE r'{ANY_FLOAT}'"


def floating(text: str) -> str:
    """DOUBLE value of float text, NULL for anything else."""
    return (
        f"CASE WHEN NOT ({is_float(text)}) THEN NULL "
        f"WHEN contains(lower({text}), 'nan') THEN double('NaN') "
        f"ELSE try_cast({_plain(text)} AS double) END"
    )


def _exponent_json(number: str) -> str:
    """JSON text of a double in Spark's own notation, infinity included."""
    return f"replace(cast({number} AS string), 'Infinity', '{INFINITY_JSON}')"


def _double_json(number: str) -> str:
    """JSON text of a double.

    Spark prints magnitudes outside 1e-3..1e7 with an exponent, and a number
    with an exponent is stored as a binary double instead of an exact decimal.
    Magnitudes from 1e-4 to 1e16 are spelled out, as most JSON writers do.
    """
    digits = "regexp_replace(cast(try_cast(d AS decimal(38, 22)) AS string), '0+$', '')"
    return let(
        "d",
        number,
        f"""CASE
          WHEN abs(d) >= 1e-3D AND abs(d) < 1e7D OR d = 0D THEN cast(d AS string)
          WHEN abs(d) >= 1e-4D AND abs(d) < 1e16D THEN regexp_replace({digits}, r'\\.$', '.0')
          ELSE {_exponent_json("d")}
        END""",
    )


def _long_integer_json(text: str) -> str:
    """Grouped digits and integers of 19 or more digits.

    Exact up to 38 digits, then the nearest double.
    """
    plain = _plain(text)
    return f"""CASE WHEN {text} RLIKE r'{INTEGER}' THEN coalesce(
        CASE WHEN octet_length({plain}) <= 39
          THEN cast(try_cast({plain} AS decimal(38, 0)) AS string) END,
        {_exponent_json(f"try_cast({plain} AS double)")}
      ) END"""


def number_json(text: str) -> str:
    """JSON number for numeric text, NULL for any other text.

    Text with a dot is a float and text without one an integer, so ``1e5`` and
    ``nan`` stay strings.
    """
    return f"""CASE
      WHEN contains({text}, '.') THEN
        CASE WHEN {text} RLIKE r'{DOTTED_FLOAT}'
          THEN {_double_json(f"try_cast({_plain(text)} AS double)")} END
      WHEN {text} RLIKE r'{SHORT_INTEGER}' THEN cast(try_cast({text} AS bigint) AS string)
      WHEN octet_length({text}) > 18 OR NOT {text} RLIKE r'{PLAIN_TEXT}'
        THEN {_long_integer_json(text)}
    END"""
