"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

All of it is built-in expressions of one projection. Matches come from the pattern's extraction
and their places from the pieces that the same pattern splits the text into. Patterns that start
inside a run of their own characters are anchored to the run's start, which changes no match and
keeps long runs linear; where a rule on the number of digits follows, the pattern asks for it.

The base kinds are email, ip (parts at most 255), card (14 to 19 digits, Luhn) and phone (10 to 15
digits); they are always kept. The method adds iban (mod-97) and ssn, which is kept only if context
words before it lift its score to ``LEAST_SCORE``. Scores of all spans rise with context words.

Work is linear in a text's length and grows with its matches' number m as m ** 1.5 at most: places are
running sums taken block by block, and context is read from the pieces before a match.

Offsets count code points, ends are exclusive. Edge cases: null and empty texts have no spans;
repeated rows give the same spans; columns of the result's name are replaced; failing matches are
dropped and nothing is tried again inside them, but for iban: it is proposed at every place where a
word starts, ends where a word ends, and has its country's length (any length from 15 to 34 for
countries without an entry, the longest that passes mod-97).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, others

LEAST_SCORE = 0.6
#: Characters before a span in which context words count.
CONTEXT_CHARS = 40
#: So many matches before a span hold its context: a match and what separates it take 3 characters at least.
CONTEXT_MATCHES = 14
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Lengths of account numbers by country, of the public registry.
IBAN_LENGTHS = (
    ",AD24,AE23,AL28,AT20,AZ28,BA20,BE16,BG22,BH22,BI27,BR29,BY28,CH21,CR22,CY28,CZ24,DE22,DJ27,DK18,DO28,EE20,EG29,ES24,FI18,FK18,FO18,FR27,GB22,GE22,GI23,"
    "GL18,GR27,GT28,HN28,HR21,HU28,IE22,IL23,IQ23,IS26,IT27,JO30,KW30,KZ20,LB28,LC32,LI21,LT20,LU20,LV21,LY25,MC27,MD24,ME22,MK19,MN20,MR27,MT31,MU30,NI28,"
    "NL18,NO15,OM23,PK24,PL28,PS29,PT25,QA29,RO24,RS22,RU33,SA24,SC31,SD18,SE24,SI19,SK24,SM27,SO23,ST25,SV28,TL23,TN24,TR26,UA29,VA22,VG24,XK20,YE30,"
)
SPAN = "array<struct<start:int,end:int,value:string,near:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of the value pass Luhn's check."""

    def add(total: Column, x: Column) -> Column:
        twice = x.d * 2
        return total + F.when(x.i % 2 == 0, x.d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    figures = F.filter(F.split(F.reverse(digits(value)), ""), lambda c: c != "")
    numbered = F.transform(figures, lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number (country, check digits, rest) leaves 1 modulo 97."""
    packed = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(packed, 5, 40), F.substring(packed, 1, 4))
    places = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(places, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def parts_in_range(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap test of the whole text; ``valid`` decides on a match."""

    name: str
    pattern: str
    hint: str
    score: float
    context: str

    def valid(self, value: Column) -> Column:
        count = F.length(digits(value))
        return {
            "email": lambda: F.lit(True),
            "ip": lambda: parts_in_range(value),
            "card": lambda: luhn(value),
            "phone": lambda: (count >= 10) & (count <= 15),
            "ssn": lambda: ~value.rlike("^(?:000|666|9[0-9][0-9])|-00-|-0000$"),
        }[self.name]()


# The patterns of the base kinds, anchored as the module's text says.
PATTERNS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|correo|courriel|kontakt"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", 0.6, r"\bip\b|host|server|address|adresse|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){13}", 0.8, "card|visa|credit|karte|carte|tarjeta|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "tel|phone|call|mobile|fax|ruf|appel"),
    Kind("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11}", 0.8, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9][0-9]-[0-9]", 0.3, "ssn|social security|tax id|national id"),
)


def before(values: Column, first: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state before each value, where ``step(state, value)`` gives the next and ``first`` is the first.

    Blocks of about the square root of the values' number keep the arrays that grow small.
    """
    width = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
    many = F.ceil(F.size(values) / width).cast("int")
    blocks = F.transform(F.filter(F.sequence(F.lit(0), many), lambda i: i < many), lambda i: F.slice(values, i * width + 1, width))
    go = lambda items, start, move: F.aggregate(items, F.array(start), lambda seen, x: F.concat(seen, F.array(move(F.element_at(seen, -1), x))))
    starts = lambda b: go(b, first, lambda state, block: F.aggregate(block, state, step))
    within = lambda block, start: F.when(block.isNotNull(), F.slice(go(block, start, step), 1, F.size(block)))
    return let(blocks, lambda b: F.flatten(F.filter(F.zip_with(b, starts(b), within), lambda x: x.isNotNull())))


def matches(text: Column, pattern: str, group: int = 0, taken: int | None = None) -> Column:
    """(start, end, value, near) of the leftmost matches that don't overlap, with the characters before each.

    ``value`` is the pattern's ``group``; a match itself takes ``taken`` characters, None: the value's.
    """
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), group).alias("v"), F.split(text, pattern, -1).alias("p"))
    length = lambda x: F.when(x.v.isNull(), 0).otherwise(F.length(x.v) if taken is None else taken)

    def placed(x: Column) -> Column:
        sizes = F.transform(x, lambda m: (F.length(m.p) + length(m)).cast("int"))
        own = lambda m: m.v if taken is None else F.substring(m.v, 1, taken)
        tails = F.transform(x, lambda m: F.right(F.concat(m.p, F.coalesce(own(m), F.lit(""))), F.lit(CONTEXT_CHARS)))
        starts = let(sizes, lambda n: before(n, F.lit(0), lambda at, k: at + k))
        return let(tails, lambda t: F.zip_with(x, F.zip_with(starts, F.sequence(F.lit(0), F.size(x) - 1), lambda at, k: F.struct(at.alias("at"), k.alias("k"))), lambda m, s: span(m, s, t)))

    def span(m: Column, s: Column, tails: Column) -> Column:
        start, from_ = s.at + F.length(m.p), F.greatest(s.k - CONTEXT_MATCHES, F.lit(0))
        near = F.concat(F.array_join(F.slice(tails, from_ + 1, s.k - from_), ""), F.right(m.p, F.lit(CONTEXT_CHARS)))
        return F.when(m.v.isNotNull(), F.struct(start.alias("start"), (start + F.length(m.v)).alias("end"), m.v.alias("value"), F.right(near, F.lit(CONTEXT_CHARS)).alias("near")))

    return F.filter(let(pairs, placed), lambda m: m.isNotNull()).cast(SPAN)


def accounts(text: Column, pattern: str) -> Column:
    """The account numbers, of which the pattern's group is the longest reading.

    A match is the country alone, so that every place is tried; of overlapping numbers the first stays.
    """

    def whole(v: Column) -> Column:
        words = F.split(v, r"\x20")
        readings = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda m: F.array_join(F.slice(words, 1, m), " "))
        entry = F.instr(F.lit(IBAN_LENGTHS), F.concat(F.lit(","), F.substring(v, 1, 2)))
        own = F.lit(IBAN_LENGTHS).substr(entry + 3, F.lit(2)).try_cast("int")

        def fits(x: Column) -> Column:
            n = F.length(F.regexp_replace(x, r"\x20", ""))
            return F.when(entry > 0, n == own).otherwise(n.between(15, 34)) & mod97(x)

        return F.get(F.filter(readings, fits), F.lit(0))

    read = F.transform(matches(text, pattern, 1, 2), lambda m: F.struct(m.start.alias("start"), whole(m.value).alias("value"), m.near.alias("near")))
    found = F.transform(F.filter(read, lambda m: m.value.isNotNull()), lambda m: F.struct(m.start.alias("start"), (m.start + F.length(m.value)).cast("int").alias("end"), m.value.alias("value"), m.near.alias("near")))

    def apart(x: Column) -> Column:
        ends = before(x, F.lit(0), lambda last, m: F.when(m.start >= last, m.end).otherwise(last))
        return F.filter(F.zip_with(x, ends, lambda m, last: F.when(m.start >= last, m)), lambda m: m.isNotNull())

    return let(found.cast(SPAN), apart)


def spans(text: Column, kind: Kind, rank: int) -> Column:
    """The kind's confirmed spans as (start, rank, end, kind, score, base)."""
    hint = F.instr(text, kind.hint) > 0 if kind.hint in "@+" else text.rlike(kind.hint)
    found = accounts(text, kind.pattern) if kind.name == "iban" else F.filter(matches(text, kind.pattern), lambda m: kind.valid(m.value))

    def scored(m: Column) -> Column:
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(F.lower(m.near).rlike(kind.context), 0.3).otherwise(0.0))
        return F.struct(m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"), F.lit(rank < 4).alias("base"))

    kind_of_all = "array<struct<start:int,rank:int,end:int,kind:string,score:double,base:boolean>>"
    kept = F.filter(F.transform(found, scored), lambda s: s.base | (s.score >= LEAST_SCORE))
    return F.when(hint, kept.cast(kind_of_all)).otherwise(F.array().cast(kind_of_all))


def find(df: DataFrame, text: str = "text", to: str = "pii", keep_text: bool = True) -> DataFrame:
    """Adds an array of (start, rank, end, kind, score, base), ordered by start and kind."""
    kept = others(df, [to, "__text"] if keep_text else [to, text, "__text"])
    names = [f"__{k.name}" for k in PATTERNS]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], *[spans(F.col("__text"), k, i).alias(n) for i, (k, n) in enumerate(zip(PATTERNS, names))])
    return rows.select(*[F.col(f"`{c}`") for c in kept], F.sort_array(F.concat(*names)).alias(to))


def joined(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat(s.kind, F.lit(":"), s.start.cast("string"), F.lit(":"), s.end.cast("string"))), ",")
