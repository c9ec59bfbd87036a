"""SQL text of names and strings, for expressions built as text."""

from __future__ import annotations


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    """A column name, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"
