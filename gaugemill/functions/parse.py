"""Reply parsing: texts of a model against an answer contract.

Replies are parsed in two tiers. Built-in functions prove that most well-formed replies are what they
seem: one strict JSON value and nothing else, the contract's keys once each, values that have one spelling, a label
of the contract. These never leave the JVM. Exact rules for all others (nothing after the value, the last of
repeated keys counts, key order kept, any text around an answer) need Python's reader, one Arrow-batched function.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .contract import Contract
from .scalars import whole_json
from .template import stripped

#: The markers around a model's thoughts.
OPENED, CLOSED = "<unused94>", "<unused95>"
PARSED = "answer_json string, verdict string, short_reason string, reasoning string, parse_note string, key_order_ok boolean, parse_error string"
UNCLOSED = "json inside unclosed thought"


def without_thoughts(text: Column) -> Column:
    """The text without its thought spans; one that is never closed runs to the end."""
    return F.regexp_replace(text, f"(?s){OPENED}.*?(?:{CLOSED}|$)", "")


def canonical(value) -> str | None:
    """A verdict as text."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def failure(text: str) -> dict:
    return {"parse_error": text}


def matched(value, contract: Contract):
    """The contract's value that a reply's label stands for; StopIteration if none."""
    if isinstance(value, str):
        low = value.strip().lower()
        return next(v for v in contract.values if isinstance(v, str) and v.strip().lower() == low)
    return next(v for v in contract.values if not isinstance(v, str) and isinstance(v, bool) == isinstance(value, bool) and v == value)


def check(answer: dict, contract: Contract) -> dict:
    """An object against the contract: its key set, its label's domain, its key order."""
    if set(answer) != set(contract.order):
        return failure(f"keys {sorted(answer)}"[:200])
    verdict = None
    if contract.label:
        try:
            verdict = matched(answer[contract.label], contract)
        except StopIteration:
            return failure(f"label {answer[contract.label]!r}"[:200])
    reason = answer.get("short_reason")
    return {
        "answer_json": json.dumps(answer, ensure_ascii=False),
        "verdict": canonical(verdict),
        "short_reason": reason if isinstance(reason, str) else None,
        "key_order_ok": tuple(answer) == contract.order,
    }


def parse_strict(text: str | None, contract: Contract) -> dict:
    """The whole text must be one JSON object."""
    try:
        answer = json.loads(text or "")
    except ValueError:
        return failure(f"not JSON: {(text or '')[:120]}")
    if not isinstance(answer, dict):
        return failure(f"JSON {type(answer).__name__}, not an object")
    return check(answer, contract)


def spoken(text: str) -> tuple[str, str | None]:
    """What a reply says outside its thoughts, and a note if a thought was never closed.

    A thought that is never closed counts as speech, since an answer may stand in it.
    """
    if text.rfind(OPENED) > text.rfind(CLOSED):
        return re.sub(f"{OPENED}|{CLOSED}", "", text), UNCLOSED
    return re.sub(f"(?s){OPENED}(?:(?!{OPENED}).)*?{CLOSED}", "", text).replace(OPENED, ""), None


def objects(text: str) -> Iterator[tuple[int, dict]]:
    """Every JSON object in a text, whatever stands around it, from the last to begin to the first."""
    read = json.JSONDecoder().raw_decode
    for brace in reversed([m.start() for m in re.finditer(r"\{", text)]):
        try:
            yield brace, read(text, brace)[0]
        except (ValueError, RecursionError):
            continue


def parse_tolerant(text: str | None, contract: Contract) -> dict:
    """The last object in the text that holds the label (or all keys, without a label)."""
    if contract.prose:
        reply = (text or "").strip()
        return {"answer_json": json.dumps(reply, ensure_ascii=False)} if reply else failure("empty reply")
    said, note = spoken(text or "")
    needed = set(contract.order if contract.label is None else (contract.label,))
    hit = next(((at, answer) for at, answer in objects(said) if needed <= answer.keys()), None)
    if hit is None:
        return failure(f"no answer in the text: {said[:120]}")
    return check(hit[1], contract) | {"reasoning": said[: hit[0]].strip() or None, "parse_note": note}


def parser(contract: Contract, guided: bool = True):
    """The reply parser of a contract, as a function of a text column that works on batches; null gives null fields."""
    use = parse_strict if guided and not contract.prose else parse_tolerant
    names = [c.split()[0] for c in PARSED.split(", ")]

    @F.pandas_udf(PARSED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # The texts that were proven elsewhere come as nulls, and cost nothing here.
            texts = batch.to_numpy(dtype=object, na_value=None)
            rows = {i: use(str(texts[i]), contract) for i in batch.notna().to_numpy().nonzero()[0]}
            out = {n: [None] * len(batch) for n in names}
            for i, row in rows.items():
                for n, v in row.items():
                    out[n][i] = v
            yield pd.DataFrame({n: pd.Series(v, dtype=object) for n, v in out.items()})

    return run


def provable(contract: Contract) -> bool:
    """Whether built-ins can prove answers of this contract: plain names, and a label of texts."""
    return bool(contract.order) and all(re.fullmatch(r"[A-Za-z0-9_ .-]+", k) for k in contract.order) and all(isinstance(v, str) and v.isascii() for v in contract.values)


def proven(text: Column, contract: Contract) -> Column:
    """The parsed reply as a struct where built-ins prove it to be what either parser says, else null.

    Without a backslash a text's strings are spelled as they are meant, and no string can hold a quote, so none can
    hide another answer. Numbers, lists and objects as values have many spellings and are left to the parsers.
    """
    tree, keys = F.try_parse_json(text), F.json_object_keys(text)
    value = {k: F.try_variant_get(tree, f"$['{k}']", "string") for k in contract.order}
    kind = {k: F.schema_of_variant(F.try_variant_get(tree, f"$['{k}']", "variant")) for k in contract.order}
    spelled = lambda k: F.when(kind[k] == "STRING", F.concat(F.lit('"'), value[k], F.lit('"'))).when(kind[k] == "BOOLEAN", value[k]).otherwise(F.lit("null"))
    parts = F.create_map(*[x for k in contract.order for x in (F.lit(k), F.concat(F.lit(json.dumps(k) + ": "), spelled(k)))])
    answer = F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: parts[k]), ", "), F.lit("}"))
    sure = [
        text.rlike(r"^[ \t\r\n]*\{"), F.instr(text, "\\") == 0, F.instr(text, OPENED) == 0, F.instr(text, CLOSED) == 0, tree.isNotNull(), whole_json(text).isNotNull(),
        F.array_sort(keys) == F.lit(sorted(contract.order)), *[kind[k].isin("STRING", "BOOLEAN", "VOID") for k in contract.order],
    ]
    verdict = F.lit(None).cast("string")
    if contract.label:
        said = F.lower(stripped(value[contract.label]))
        verdict = F.create_map(*[F.lit(x) for v in reversed(contract.values) for x in (v.strip().lower(), v)])[said] if len({v.strip().lower() for v in contract.values}) == len(contract.values) else verdict
        sure += [kind[contract.label] == "STRING", said.rlike(r"^[\x20-\x7E]*$"), verdict.isNotNull()]
    nothing = F.lit(None).cast("string")
    reason = F.when(kind["short_reason"] == "STRING", value["short_reason"]) if "short_reason" in contract.order else nothing
    columns = {"answer_json": answer, "verdict": verdict, "short_reason": reason, "reasoning": nothing, "parse_note": nothing, "key_order_ok": keys == F.lit(list(contract.order)), "parse_error": nothing}
    return F.when(F.coalesce(reduce(and_, sure), F.lit(False)), F.struct(*[columns[c.split()[0]].cast(c.split()[1]).alias(c.split()[0]) for c in PARSED.split(", ")]))


def parsed(text: Column, contract: Contract, guided: bool = True) -> Column:
    """The reply as a struct of the columns in PARSED."""
    if not provable(contract):
        return parser(contract, guided)(F.coalesce(text, F.lit("")))
    sure = proven(text, contract)
    return F.coalesce(sure, parser(contract, guided)(F.when(sure.isNull(), F.coalesce(text, F.lit("")))))


def register(spark: SparkSession, contract: Contract, name: str = "parse_reply", guided: bool = True) -> None:
    """Makes the parser a function of SQL."""
    spark.udf.register(name, parser(contract, guided))
