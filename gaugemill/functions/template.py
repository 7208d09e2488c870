"""Prompt templates: ``{column}`` placeholders compiled into one concatenation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACEHOLDER = re.compile(r"\{([^{}]+)\}")
MISSING = "<missing>"


def placeholders(template: str) -> list[str]:
    """The names in a template, each once, in order."""
    return list(dict.fromkeys(PLACEHOLDER.findall(template)))


def stripped(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def rendered(value: Column) -> Column:
    """One value as it stands in a prompt: blank is marked, whole floats lose their zeros."""
    text = stripped(value.cast("string"))
    return F.when(value.isNull() | (text == ""), F.lit(MISSING)).otherwise(F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"))


def render(template: str, values: dict[str, Column]) -> Column:
    """The template with its placeholders replaced; a name without a value is refused."""
    absent = [n for n in placeholders(template) if n not in values]
    if absent:
        raise KeyError(f"the template names columns that are missing: {', '.join(absent[:8])}")
    parts = PLACEHOLDER.split(template)
    return F.concat(*[rendered(values[p]) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def render_json(template: str, fields_json: Column) -> Column:
    """As render, with values from a JSON object; an absent or null field counts as missing."""
    fields = F.from_json(fields_json, "map<string,string>")
    return render(template, {n: F.try_element_at(fields, F.lit(n)) for n in placeholders(template)})


def label(template: str, columns: dict[str, Column]) -> Column:
    """A stratum's label: plain ``{column}`` only, values as they are."""
    absent = [n for n in placeholders(template) if n not in columns]
    if absent:
        raise KeyError(f"the stratum names columns that are missing: {', '.join(absent[:8])}")
    parts = PLACEHOLDER.split(template)
    return F.concat(*[F.coalesce(columns[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])
