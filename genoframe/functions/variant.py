"""INFO and FORMAT text to VARIANT.

Both fields become the text of one JSON object and go through ``parse_json``.
The JSON is assembled with higher-order functions, so a whole scan stays in one
stage on the JVM.
"""

from __future__ import annotations

from genoframe.functions.numbers import TIDY, TIDY_NUMBERS, number_json, whole
from genoframe.functions.text import let

# Stands for a list item that is not a number; cannot occur in JSON number text.
NOT_A_NUMBER = "!"
# Characters that a JSON string must escape; a tab separates fields, so no field
# contains one.
CONTROL = r"[\x00-\x08\x0a-\x1f]"
# Lists with an item that has no digit, and so is no number.
MIXED_LIST = r"(?:\A|,)[^0-9,]*+(?:,|\z)"
# INFO items whose JSON follows from the text of the whole item: numbers, and strings
# that start with a letter, which no number does.
NUMBER_ITEM = whole(rf"[^=,]*={TIDY}")
WORD_ITEM = whole(r"[^=,]*=[A-Za-z][^=,]*")


def needs_escaping(text: str) -> str:
    """True if the text holds characters that JSON strings must escape."""
    return (
        f"""contains({text}, '"') OR contains({text}, '\\\\') OR {text} RLIKE r'{CONTROL}'"""
    )


def quoted(text: str, escape: str) -> str:
    """JSON string of the text; ``escape`` is SQL that says whether it may need escaping."""
    escaped = let("j", f"to_json(array({text}))", "substr(j, 2, length(j) - 2)")
    return f"""CASE WHEN {escape} THEN {escaped} ELSE concat('"', {text}, '"') END"""


def _strings_json(text: str, escape: str) -> str:
    """JSON array of the comma separated items, all as strings."""
    return f"""CASE WHEN {escape} THEN to_json(split({text}, ','))
      ELSE concat('["', replace({text}, ',', '","'), '"]') END"""


def value_json(text: str, mixed_list_as_string: bool, escape: str) -> str:
    """JSON value of one INFO or FORMAT value.

    A comma makes it a list. A list with an item that is not a number is a list
    of strings in INFO but one plain string in FORMAT. Lambdas are interpreted, so
    what most values are is settled first: tidy numbers by one pattern, strings
    without a digit by another.
    """
    mixed = quoted(text, escape) if mixed_list_as_string else _strings_json(text, escape)
    numbers = f"transform(split({text}, ','), n -> {number_json('n')})"
    list_json = let(
        "joined",
        f"array_join({numbers}, ',', '{NOT_A_NUMBER}')",
        f"""CASE WHEN contains(joined, '{NOT_A_NUMBER}') THEN {mixed}
            ELSE concat('[', joined, ']') END""",
    )
    return f"""CASE
      WHEN {text} RLIKE r'{TIDY_NUMBERS}' THEN
        CASE WHEN contains({text}, ',') THEN concat('[', {text}, ']') ELSE {text} END
      WHEN contains({text}, ',') THEN
        CASE WHEN {text} RLIKE r'{MIXED_LIST}' THEN {mixed} ELSE {list_json} END
      WHEN NOT {text} RLIKE '[0-9]' THEN {quoted(text, escape)}
      ELSE coalesce({number_json(text)}, {quoted(text, escape)})
    END"""


def _item_json(item: str, escape: str) -> str:
    """JSON member of an INFO item."""
    key = quoted(f"substring_index({item}, '=', 1)", escape)
    value = let(
        "v",
        f"substr({item}, instr({item}, '=') + 1)",
        value_json("v", mixed_list_as_string=False, escape=escape),
    )
    return f"""CASE
      WHEN NOT contains({item}, '=') THEN concat({quoted(item, escape)}, ':true')
      WHEN {escape} THEN concat({key}, ':', {value})
      WHEN {item} RLIKE r'{NUMBER_ITEM}' THEN
        CASE WHEN contains({item}, ',')
          THEN concat('"', replace({item}, '=', '":['), ']')
          ELSE concat('"', replace({item}, '=', '":')) END
      WHEN {item} RLIKE r'{WORD_ITEM}' THEN concat('"', replace({item}, '=', '":"'), '"')
      ELSE concat({key}, ':', {value})
    END"""


def _info_json(info: str, escape: str) -> str:
    """JSON object of an INFO field; of items with equal keys the last one stays."""
    last_items = """filter(items, (item, i) ->
        NOT array_contains(slice(keys, i + 2, size(keys)), keys[i]))"""
    unlike_items = let(
        "keys",
        "transform(items, item -> substring_index(item, '=', 1))",
        f"CASE WHEN size(array_distinct(keys)) < size(keys) THEN {last_items} ELSE items END",
    )
    items = let("items", f"split({info}, ';')", unlike_items)
    members = f"transform({items}, item -> {_item_json('item', escape)})"
    return f"concat('{{', array_join({members}, ','), '}}')"


def info_variant(info: str) -> str:
    """VARIANT object of an INFO field.

    ``key=value`` items are typed by their value, bare items are ``true`` flags,
    the last of repeated keys wins, and a missing field is the empty object.
    """
    object_json = let("escape", needs_escaping("info"), _info_json("info", "escape"))
    json = f"CASE WHEN info = '.' OR info = '' THEN '{{}}' ELSE {object_json} END"
    return f"parse_json({let('info', info, json)})"
