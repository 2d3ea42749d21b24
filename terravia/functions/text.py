"""Small text, array and code helpers."""

from __future__ import annotations

import datetime
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: one-letter catalog codes and their meaning
CONSTRAINT_KINDS = {"c": "CHECK", "f": "FOREIGN KEY", "p": "PRIMARY KEY", "u": "UNIQUE"}
REFERENTIAL_ACTIONS = {
    "a": "NO ACTION", "r": "RESTRICT", "c": "CASCADE", "n": "SET NULL", "d": "SET DEFAULT",
}
MATCH_KINDS = {"u": "UNSPECIFIED", "f": "FULL", "p": "PARTIAL"}


def clean_layer_name(given: Column, layer_name: Column) -> Column:
    """The given table name without spaces, or the lower-cased layer name when it is blank."""
    chosen = F.coalesce(F.nullif(F.trim(given), F.lit("")), F.lower(layer_name))
    return F.replace(chosen, F.lit(" "), F.lit(""))


def extract_quoted_name(text: Column) -> Column:
    """First double-quoted run, quotes kept; the whole text without one; 'Unknown' for NULL."""
    quoted = F.regexp_extract(text, r'"[^"]+"', 0)
    return F.coalesce(F.when(quoted == "", text).otherwise(quoted), F.lit("Unknown"))


def split_int_list(text: Column) -> Column:
    return F.transform(F.split(text, " "), lambda part: part.cast("int"))


def join_list(items: Column) -> Column:
    return F.array_join(items, " ")


def decode_code(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code, NULL for an unknown one."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.items())])
    return F.try_element_at(table, code)


def vintage(default_year: int | None = None) -> Column:
    """The given year, or the current one."""
    return F.lit(default_year) if default_year is not None else F.year(F.current_date())


def this_year() -> int:
    return datetime.date.today().year
