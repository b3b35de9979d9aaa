"""Short ways to put bounded Python values into column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_string(value: str) -> str:
    """`value` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_in(name: str, values: Iterable[str]) -> str:
    """`name IN (...)` as SQL text. Catalyst turns it into one hash lookup per row, whatever the list length."""
    listed = ", ".join(sql_string(v) for v in values)
    return f"{name} IN ({listed})" if listed else "false"


def count_listed(words: Column, listed: Iterable[str], form: str = "word") -> Column:
    """Number of entries of an array that occur in a list, each in the `form` given as SQL over `word`."""
    return F.size(keep_listed(words, listed, form))


def keep_listed(words: Column, listed: Iterable[str], form: str = "word") -> Column:
    """Entries of an array that occur in a list. The list is SQL text: one call, however many words it has."""
    return F.call_function("filter", words, F.expr(f"word -> {sql_in(form, listed)}"))


def string_map(pairs: dict[str, str]) -> Column:
    """A constant map column; Catalyst folds it once."""
    if not pairs:
        return empty_map()
    return F.expr("map(" + ", ".join(f"{sql_string(k)}, {sql_string(v)}" for k, v in pairs.items()) + ")")


def empty_map() -> Column:
    return F.expr("cast(map() as map<string,string>)")


def empty_strings() -> Column:
    return F.expr("cast(array() as array<string>)")
