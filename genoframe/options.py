"""Reader options, by the names VCF users already know."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


def _sample_list(value: str | Iterable[str] | None) -> tuple[str, ...]:
    if value is None:
        return ()
    items = value.split(",") if isinstance(value, str) else value
    return tuple(item.strip() for item in items if item.strip())


def _is_true(value: object) -> bool:
    return str(value).lower() == "true"


@dataclass(frozen=True)
class VcfOptions:
    """Parsed reader options.

    An empty sample list selects everything. With file metadata off, the two
    file columns hold empty strings.
    """

    include_samples: tuple[str, ...] = ()
    exclude_samples: tuple[str, ...] = ()
    file_metadata: bool = True
    primary_key: bool = False

    @classmethod
    def parse(cls, options: dict[str, object]) -> VcfOptions:
        """Read ``includeSampleIds``, ``excludeSampleIds``, ``includeFileMetadata``
        and ``generatePrimaryKey``. Names ignore case; other names are ignored."""
        given = {name.lower(): value for name, value in options.items()}
        return cls(
            include_samples=_sample_list(given.get("includesampleids")),
            exclude_samples=_sample_list(given.get("excludesampleids")),
            file_metadata=_is_true(given.get("includefilemetadata", "true")),
            primary_key=_is_true(given.get("generateprimarykey", "false")),
        )
