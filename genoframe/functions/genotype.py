"""Genotype columns: sample selection, allele calls and FORMAT data."""

from __future__ import annotations

from genoframe.functions.numbers import TIDY_NUMBER, integer, whole
from genoframe.functions.text import after_tabs, has_tabs, let, literal, tab_field
from genoframe.functions.variant import needs_escaping, quoted, value_json
from genoframe.options import VcfOptions

KEPT_SAMPLES_TYPE = "array<struct<idx:int,sampleId:string>>"
# The calls of most genotypes; others are taken apart.
COMMON_CALLS = (
    "0/0", "0|0", "./.", "0/1", "0|1", "1|0", "1/1", "1|1", ".|.", "1/2", "1|2", "2|1", "0/2", "0|2", "2|0",
)
# A genotype whose alleles are all plain numbers or missing.
PLAIN_CALLS = whole(r"(?:\.|[0-9]{1,18})(?:[/|](?:\.|[0-9]{1,18}))*")
# FORMAT fields whose keys need no escaping.
PLAIN_FORMAT = whole(r"[A-Za-z0-9_.:]*+")
# A sample with GT in front and no other value that is not missing.
ONLY_GT = whole(r"[^:]*+(?::\.)*+")
# A sample with GT in front whose other values are tidy numbers, lists of these and of
# missing ones, or words that start with a letter, which no number does.
PLAIN_SAMPLE = whole(
    rf"[^:]*+(?::(?:[A-Za-z][A-Za-z0-9_./|-]*+|(?:{TIDY_NUMBER}|\.)(?:,(?:{TIDY_NUMBER}|\.))*+))*+"
)
# Values of a plain sample that are written out one by one; more go through a lambda.
SPELLED_OUT = 8


def kept_samples(sample_ids: str, options: VcfOptions) -> str:
    """Selected samples of a header with their position, in header order."""
    kept = f"transform({sample_ids}, (name, i) -> struct(i AS idx, name AS sampleId))"
    if options.include_samples:
        wanted = ", ".join(literal(name) for name in options.include_samples)
        kept = f"filter({kept}, s -> s.sampleId IN ({wanted}))"
    if options.exclude_samples:
        unwanted = ", ".join(literal(name) for name in options.exclude_samples)
        kept = f"filter({kept}, s -> s.sampleId NOT IN ({unwanted}))"
    return f"cast({kept} AS {KEPT_SAMPLES_TYPE})"


def _allele(text: str) -> str:
    return "-1L" if text == "." else f"{text}L"


def allele_calls(gt: str) -> str:
    """Allele indexes of a GT value: ``.`` is -1, phase is dropped.

    NULL for a missing value or if any allele is not an integer. Common calls are looked
    up in a constant map, since a branch for each would be interpreted in lambdas.
    """
    alleles = f"split(translate({gt}, '|', '/'), '/')"
    plain = f"transform({alleles}, a -> CASE WHEN a = '.' THEN -1L ELSE try_cast(a AS bigint) END)"
    checked = f"transform({alleles}, a -> CASE WHEN a = '.' THEN -1L ELSE {integer('a')} END)"
    all_or_nothing = let(
        "calls", checked, "CASE WHEN NOT exists(calls, c -> c IS NULL) THEN calls END"
    )
    common = ", ".join(
        f"'{calls}', array({', '.join(_allele(a) for a in calls[::2])})" for calls in COMMON_CALLS
    )
    return f"""coalesce(element_at(map({common}), {gt}), CASE
      WHEN {gt} IS NULL OR {gt} = '.' THEN NULL
      WHEN {gt} RLIKE r'{PLAIN_CALLS}' THEN {plain}
      ELSE {all_or_nothing}
    END)"""


def format_layout(format_field: str) -> str:
    """What all samples of a record share about its FORMAT field.

    ``keys`` are the FORMAT keys, ``names`` their JSON member prefixes with NULL or
    nothing for GT, ``gt`` the 1-based position of GT (0 if absent) and ``single``
    whether no key occurs twice. The field goes in as a column or a bound variable;
    with GT in front and plain keys nothing is looked at key by key.
    """
    plain = f"{format_field} RLIKE r'{PLAIN_FORMAT}'"
    any_layout = let(
        "keys",
        f"split({format_field}, ':')",
        f"""struct(
          keys AS keys,
          CASE WHEN {plain}
            THEN transform(keys, k -> CASE WHEN k != 'GT' THEN concat('"', k, '":') END)
            ELSE transform(keys, k -> CASE WHEN k != 'GT'
              THEN concat({quoted("k", needs_escaping("k"))}, ':') END) END AS names,
          cast(array_position(keys, 'GT') AS int) AS gt,
          size(array_distinct(keys)) = size(keys) AS single
        )""",
    )
    behind_gt = f"""concat(substr(replace(substr({format_field}, 3), ':', '":\\t"'), 3), '":')"""
    keys = f"split({format_field}, ':')"
    return f"""CASE
      WHEN {format_field} = 'GT' THEN struct(array('GT') AS keys, array('') AS names, 1 AS gt, true AS single)
      WHEN startswith({format_field}, 'GT:') AND {plain} AND size(array_distinct({keys})) = size({keys})
      THEN struct({keys} AS keys, split({behind_gt}, '\\t') AS names, 1 AS gt, true AS single)
      ELSE {any_layout} END"""


def _data_json(layout: str, values: str, escape: str) -> str:
    """JSON object of the FORMAT values except GT and missing ones."""
    overridden = f"""exists(
        filter({values}, (later, j) -> j > i AND later != '.'
          AND get({layout}.keys, j) = get({layout}.keys, i)), later -> true)"""
    deciding = f"""CASE WHEN {layout}.single THEN {values}
        ELSE transform({values}, (v, i) -> CASE WHEN {overridden} THEN '.' ELSE v END) END"""
    value = value_json("v", mixed_list_as_string=True, escape=escape)
    members = f"""zip_with({layout}.names, {deciding}, (name, v) ->
        CASE WHEN name != '' AND v != '.' THEN concat(name, {value}) END)"""
    return f"concat('{{', array_join({members}, ','), '}}')"


def _plain_member(name: str, value: str) -> str:
    """JSON member of a value of a plain sample, NULL for a missing value.

    Digits, signs and dots sort before letters, so the first character tells words
    from numbers; a list with a missing item is one string.
    """
    return f"""CASE
        WHEN {value} = '.' THEN NULL
        WHEN {value} >= 'A' THEN concat({name}, '"', {value}, '"')
        WHEN NOT contains({value}, ',') THEN concat({name}, {value})
        WHEN contains(concat(',', {value}, ','), ',.,') THEN concat({name}, '"', {value}, '"')
        ELSE concat({name}, '[', {value}, ']') END"""


def _parsed_data(layout: str, text: str, json: str) -> str:
    """VARIANT of the FORMAT values except GT and missing ones.

    Many samples have no value beside GT: these share one empty object and nothing of
    them is taken apart.
    """
    nothing = f"""{layout}.gt = 1 AND {layout}.single AND
        (NOT contains({text}, ':') OR {text} RLIKE r'{ONLY_GT}')"""
    return f"CASE WHEN {nothing} THEN parse_json('{{}}') ELSE parse_json({json}) END"


def _data(layout: str, text: str, values: str, escape: str) -> str:
    """The same inside a lambda."""
    return _parsed_data(layout, text, let("vals", values, _data_json(layout, "vals", escape)))


def _data_of_columns(layout: str, text: str, values: str, escape: str) -> str:
    """The same of columns, where Spark compiles what is no lambda: the members of a
    plain sample follow from its values and are written out one by one."""
    plain = f"""{layout}.gt = 1 AND {layout}.single AND size({layout}.names) <= {SPELLED_OUT}
        AND {text} RLIKE r'{PLAIN_SAMPLE}'"""
    members = ", ".join(
        _plain_member(f"get({layout}.names, {i})", f"get({values}, {i})")
        for i in range(1, SPELLED_OUT)
    )
    json = f"""CASE WHEN {plain} THEN concat('{{', concat_ws(',', {members}), '}}')
        ELSE {_data_json(layout, values, escape)} END"""
    return _parsed_data(layout, text, json)


def _gt_value(layout: str, text: str) -> str:
    """The GT text of a sample; with repeated GT keys the last that is not missing."""
    values = f"split({text}, ':')"
    pairs = f"zip_with({layout}.keys, {values}, (k, v) -> struct(k AS k, v AS v))"
    given = f"filter({pairs}, p -> p.k = 'GT' AND p.v != '.')"
    return f"""CASE
      WHEN {layout}.gt = 0 THEN NULL
      WHEN {layout}.single AND {layout}.gt = 1 THEN substring_index({text}, ':', 1)
      WHEN {layout}.single THEN get({values}, {layout}.gt - 1)
      ELSE try_element_at({given}, -1).v
    END"""


def raw_genotypes(line: str, kept: str) -> str:
    """Sample id and text of every kept sample that the record has, before parsing.

    An empty field reads as a missing genotype.
    """
    fields = f"split({after_tabs(line, 9)}, '\\t')"
    text = "CASE WHEN get(fields, s.idx) = '' THEN '.' ELSE get(fields, s.idx) END"
    present = let(
        "fields",
        fields,
        f"""transform(filter({kept}, s -> s.idx < size(fields)),
            s -> struct(s.sampleId AS sampleId, {text} AS text))""",
    )
    return f"""CASE WHEN size({kept}) > 0 AND {has_tabs(line, f"9 + {kept}[0].idx")}
      THEN {present} ELSE array() END"""


def record_format(line: str) -> str:
    """FORMAT of a record, NULL for one without samples."""
    return f"CASE WHEN {has_tabs(line, 9)} THEN {tab_field(line, 8)} END"


def split_sample(sample: str, layout: str) -> dict[str, str]:
    """The columns ``gt`` and ``vals`` of a sample of ``raw_genotypes``."""
    text = f"{sample}.text"
    return {"gt": _gt_value(layout, text), "vals": f"split({text}, ':')"}


def parsed_sample(sample: str, layout: str) -> dict[str, str]:
    """The columns ``calls`` and ``data`` of a sample with those of ``split_sample``."""
    text = f"{sample}.text"
    data = _data_of_columns(layout, text, "vals", needs_escaping(text))
    return {"calls": allele_calls("gt"), "data": data}


def genotypes(line: str, kept: str) -> str:
    """Genotype array of a record: one entry per kept sample that the record has.

    NULL, not empty, if that leaves none; the first kept sample comes first in the
    record, so its field decides. An empty field reads as a missing genotype.
    """
    record = let(
        "samples",
        after_tabs(line, 9),
        f"""struct(
          split(samples, '\\t') AS fields,
          {let("fmt", tab_field(line, 8), format_layout("fmt"))} AS layout,
          {needs_escaping("samples")} AS escape
        )""",
    )
    # Kept samples are in header order: with the last one the record has all.
    present = f"""CASE WHEN element_at({kept}, -1).idx < size(rec.fields) THEN {kept}
        ELSE filter({kept}, s -> s.idx < size(rec.fields)) END"""
    text = "CASE WHEN get(rec.fields, s.idx) = '' THEN '.' ELSE get(rec.fields, s.idx) END"
    genotype = f"""struct(
        s.sampleId AS sampleId,
        {let("gt", _gt_value("rec.layout", "text"), allele_calls("gt"))} AS calls,
        {_data("rec.layout", "text", "split(text, ':')", "rec.escape")} AS data)"""
    parsed = f"transform({present}, s -> {let('text', text, genotype)})"
    return f"""CASE WHEN size({kept}) > 0 AND {has_tabs(line, f"9 + {kept}[0].idx")}
      THEN {let("rec", record, parsed)} END"""
