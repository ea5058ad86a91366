"""SQL text helpers shared by the VCF field builders.

The builders compose Spark SQL expressions as text: an operand goes in as SQL, an
expression comes out as SQL, and the plan turns the finished text into one Column.
A parser of this size takes thousands of ``Column`` calls, each a round trip to the
JVM; the text is handed over once.
"""

from __future__ import annotations

# Every character that Unicode counts as white space, in code
# point order. A VCF line is trimmed of these before it is split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def literal(value: str) -> str:
    """SQL string literal of any text."""
    escaped = (
        ch if " " <= ch <= "~" and ch not in "\\'" else f"\\U{ord(ch):08x}" for ch in value
    )
    return "'" + "".join(escaped) + "'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once.

    Repeating an expression inside a lambda evaluates it again and again;
    a lambda variable is evaluated once. This one is the result of an aggregation over
    nothing, so no array is made to hold the value.
    """
    nothing = "cast(array() AS array<int>)"
    return f"aggregate({nothing}, {value}, ({name}, none) -> {name}, {name} -> {body})"


def strip(value: str) -> str:
    """Trim white space at both ends.

    Trimming a set of characters walks the whole line, so it runs only for lines
    whose first or last character may need it. Anything between ``!`` and DEL is
    not white space; the last character is looked up in the last tab field, which
    is found from the end of the line.
    """
    last = f"substr(substring_index({value}, '\\t', -1), -1)"
    beyond_ascii = literal(chr(0x80))
    return f"""CASE
      WHEN {value} < '!' OR {value} >= {beyond_ascii} OR {last} < '!' OR {last} >= {beyond_ascii}
      THEN btrim({value}, {literal(WHITESPACE)}) ELSE {value} END"""


def tab_field(line: str, index: int) -> str:
    """Tab field ``index`` (0-based) of a line known to have that many.

    Reads the line only as far as the field, so core columns of a record with
    thousands of samples cost the same as those of a short one.
    """
    head = f"substring_index({line}, '\\t', {index + 1})"
    return head if index == 0 else f"substring_index({head}, '\\t', -1)"


def has_tabs(line: str, count: int | str) -> str:
    """True if the line holds at least ``count`` tabs."""
    return f"octet_length(substring_index({line}, '\\t', {count})) < octet_length({line})"


def after_tabs(line: str, count: int) -> str:
    """Text behind the ``count``-th tab of a line that has that many."""
    return f"substr({line}, length(substring_index({line}, '\\t', {count})) + 2)"


def dot_list(field: str, separator: str) -> str:
    """Split a list field; the missing value ``.`` is the empty list."""
    empty = "cast(array() AS array<string>)"
    return f"CASE WHEN {field} = '.' THEN {empty} ELSE split({field}, '{separator}') END"
