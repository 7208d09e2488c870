"""Small column functions of plans and summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: HTTP status to class; any other is ``retry``.
STATUS_CLASSES = {
    "auth": (401, 403),
    "overload": (429,),
    "timeout": (524,),
    "down": (502, 503, 504, 520, 521, 522, 523, 525, 526, 527, 530),
    "bad_request": (400, 404, 405, 413, 422),
}


def status_class(status: Column) -> Column:
    out = None
    for name, codes in STATUS_CLASSES.items():
        out = (F if out is None else out).when(status.isin(*codes), name)
    return out.otherwise("retry")


def row_key(ident: Column, model: Column, prompt_sha: str, schema_sha: str | None, endpoint: Column) -> Column:
    """The identity of a request: the same row under the same prompt, model and endpoint.

    ``schema_sha`` is None where replies aren't guided; ``endpoint`` is empty where endpoints share the rows.
    """
    shape = F.lit(schema_sha if schema_sha else "guided=off")
    return F.substring(F.sha2(F.concat_ws("|", ident, model, F.lit(prompt_sha), shape, endpoint), 256), 1, 32)


def seeded(seed: int, *parts: Column | str) -> Column:
    """A hash that orders rows at random, the same for the same seed."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]), 256)


def duration(seconds: Column) -> Column:
    """3m04s, or 1h02m from an hour on."""
    s = seconds.cast("long")
    return F.when(s >= 3600, F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).otherwise(F.format_string("%dm%02ds", F.floor(s / 60), s % 60))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def whole_json(line: Column) -> Column:
    """The line if it is one JSON value and nothing else, else null.

    Readers stop at a value's end, so that two records glued together would pass for the first. What may
    follow a value inside an array can't follow it inside an object, and the other way round.
    """
    one = (F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1) & F.get_json_object(F.concat(F.lit('{"v":'), line, F.lit("}")), "$.v").isNotNull()
    return F.when(one, line)
