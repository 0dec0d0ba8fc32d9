"""The registered queries and, for each, the SQL that has to give the same rows."""

from registry.base import ENTRIES, Entry


def all_entries() -> dict[str, Entry]:
    """All queries by name."""
    from registry import checks, loading, models, operators, questions  # noqa: F401

    return dict(ENTRIES)
