"""Repair of irregular record text before JSON parsing."""

from pyspark.sql import Column, functions as F


def is_bracketed(text: Column) -> Column:
    return text.startswith("[")


def brackets_to_quotes(text: Column) -> Column:
    return F.translate(text, "[]", '""')


def unwrap_brackets(text: Column, mode: str = "reference") -> Column:
    """Take the object out of `[...]` and turn the brackets inside it into quotes.

    `reference` drops the first character and the last two, which is right only for a record that
    ends in a newline. `lenient` trims first and removes exactly one bracket at each end.
    """
    if mode == "reference":
        inner = F.substring(text, F.lit(2), F.length(text) - 3)
    elif mode == "lenient":
        trimmed = F.btrim(text, F.lit(" \t\r\n"))
        inner = F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)
    else:
        raise ValueError(f"unknown repair mode: {mode}")
    return brackets_to_quotes(inner)


def drop_double_backslashes(text: Column) -> Column:
    return F.replace(text, F.lit("\\\\"), F.lit(""))


def quote_to_bar(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit("|"))
