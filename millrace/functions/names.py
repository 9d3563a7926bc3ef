"""Column names."""

from __future__ import annotations


def snake_to_camel(name: str) -> str:
    """``sink_table`` -> ``sinkTable``."""
    head, *rest = name.lower().split("_")
    return head + "".join(word.capitalize() for word in rest)
