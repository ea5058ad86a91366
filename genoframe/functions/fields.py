"""The core VCF columns as SQL over one trimmed data line."""

from __future__ import annotations

from genoframe.functions.numbers import floating, integer, is_float, whole
from genoframe.functions.text import dot_list, has_tabs, tab_field

# Positions whose start and end cannot leave 64 bits, whatever the length of REF.
SAFE_POSITION = whole(r"[0-9]{1,17}")


def contig(line: str) -> str:
    """CHROM as it stands."""
    return tab_field(line, 0)


def start(line: str) -> str:
    """0-based start."""
    return f"try_subtract({integer(tab_field(line, 1))}, 1L)"


def end(line: str) -> str:
    """Exclusive end: start plus the length of REF; INFO END is not consulted."""
    return f"try_add({start(line)}, length({reference_allele(line)}))"


def names(line: str) -> str:
    """IDs of the variant."""
    return dot_list(tab_field(line, 2), ";")


def reference_allele(line: str) -> str:
    """REF as it stands."""
    return tab_field(line, 3)


def alternate_alleles(line: str) -> str:
    """ALT alleles; symbolic ones are kept as they are."""
    return dot_list(tab_field(line, 4), ",")


def qual(line: str) -> str:
    """Quality; a missing one is NULL."""
    return floating(tab_field(line, 5))


def filters(line: str) -> str:
    """FILTER values; ``PASS`` is one of them."""
    return dot_list(tab_field(line, 6), ";")


def info_text(line: str) -> str:
    """INFO before typing."""
    return tab_field(line, 7)


# What can be wrong with a line, in the order in which it is looked at.
REASONS = ("few_fields", "position", "quality")


def _checks(line: str) -> tuple[str, str, str]:
    """One condition for each of ``REASONS``; a record meets all of them.

    A trimmed line cannot end in a tab, so seven tabs mean eight fields.
    """
    quality, position = tab_field(line, 5), tab_field(line, 1)
    return (
        has_tabs(line, 7),
        f"({position} RLIKE r'{SAFE_POSITION}' OR {end(line)} IS NOT NULL)",
        f"({quality} = '.' OR {is_float(quality)})",
    )


def is_record(line: str) -> str:
    """True for a well formed record.

    At least eight fields, an integer POS with start and end within 64 bits and a
    numeric or missing QUAL.
    """
    return f"coalesce({' AND '.join(_checks(line))}, false)"


def reject_reason(line: str) -> str:
    """First of ``REASONS`` that holds for the line; NULL for a record."""
    wrong = (
        f"WHEN NOT coalesce({check}, false) THEN '{reason}'"
        for check, reason in zip(_checks(line), REASONS)
    )
    return f"CASE {' '.join(wrong)} END"


def variant_id(file_path: str, file_name: str, line: str) -> str:
    """SHA-256 hex of ``file_path|file_name|contig|start|end``.

    Alleles are not part of it: records of one file with equal spans share an id.
    """
    return (
        f"sha2(concat_ws('|', {file_path}, {file_name}, {contig(line)}, "
        f"{start(line)}, {end(line)}), 256)"
    )
