"""Quality rules: a table of thresholds compiled into one projection.

Every metric and every rule is a built-in expression, so one scan without a shuffle or a user
function decides on all documents. Words are runs of characters other than the ASCII white space;
null texts have none.

Words in repeated windows are counted by hashes of eight words, built from word hashes by three
doublings; only a text in which two windows agree is sorted, and the union of its repeated windows
is measured from their starts in order. Two hashes of 64 bits stand for equal windows.

Edge cases: empty texts have no words and fail the base rule; a very long text is one row of
arrays; ratios of texts without words or lines are 0; stop words are told in either case and with punctuation
around them, as a share of all words; columns of the results' names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, others

WINDOW = 8
BLANK = r"[\x20\x09-\x0D]"
#: Fixed value: what may stand around a word.
PUNCTUATION = """.,;:!?"'()[]{}<>*_-`~/|\\…«»„“”‚‘’–—¡¿"""
#: Frequent words of the languages at hand.
STOP_WORDS = (
    "the be to of and that have with is in for on as are this it at by or an from "
    "der die das und ist zu den mit von auf ein eine im nicht sich des dem für "
    "le la les et de un une est en que qui dans pour sur au du "
    "el los las y en un una es que por con para del al se no su lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= metric <= high``."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value = F.col(self.metric)
        bounds = ([value >= F.lit(self.low)] if self.low is not None else []) + ([value <= F.lit(self.high)] if self.high is not None else [])
        return reduce(and_, bounds, F.lit(True))


RULES = (
    Rule("too_few_words", "n_words", low=20),
    Rule("too_many_words", "n_words", high=1_000_000),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.06),
    Rule("repeated_lines", "dup_line_ratio", high=0.3),
    Rule("open_lines", "ellipsis_line_ratio", high=0.3),
    Rule("bullets", "bullet_line_ratio", high=0.9),
    Rule("repeated_words", "repeat_word_ratio", high=0.3),
)


def repeated_words(windows: Column) -> Column:
    """How many words the repeated ones among the windows (hashes in order of place) cover."""
    last = F.size(windows) - 1
    placed = F.sort_array(F.zip_with(windows, F.sequence(F.lit(0), last), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(F.get(s, j).h == F.get(s, j - 1).h, F.lit(False)) | F.coalesce(F.get(s, j).h == F.get(s, j + 1).h, F.lit(False)))
        return F.sort_array(F.transform(again, lambda j: F.get(s, j).i))

    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(let(placed, starts), state, lambda a, i: F.struct((a.n + F.least(F.lit(WINDOW), i - a.last)).cast("long").alias("n"), i.alias("last")), lambda a: a.n)


def doubled(hashes: Column, by: int) -> Column:
    """The hash of each entry and the one ``by`` places on."""
    return F.zip_with(hashes, F.slice(hashes, by + 1, F.greatest(F.size(hashes) - by, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts and ratios of every whole text."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars", "symbol_ratio", "n_stop_words", "stop_word_ratio", "dup_line_ratio", "ellipsis_line_ratio", "bullet_line_ratio", "repeat_word_ratio"]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = others(df, [*names, "__words", "__lines", "__h"])
    rows = df.select(*[F.col(f"`{c}`") for c in kept], body.alias("__body"), F.array_remove(F.split(body, BLANK + "+"), "").alias("__words"), F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"))
    rows = rows.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("__h", doubled(F.col("__h"), 1))
    rows = rows.withColumn("__h", doubled(F.col("__h"), 2))
    rows = rows.withColumn("__h", doubled(F.col("__h"), 4))
    rows = rows.withColumn("__h", F.slice("__h", 1, F.greatest(F.size("__words") - (WINDOW - 1), F.lit(0))))
    n = lambda c: c.cast("long")
    rows = rows.select(
        *[F.col(f"`{c}`") for c in kept],
        n(F.size("__words")).alias("n_words"),
        n(F.length(F.array_join("__words", ""))).alias("word_chars"),
        n(F.length("__body") - F.length(F.regexp_replace("__body", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        n(F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("__h")) < F.size("__h"), repeated_words(F.col("__h"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        n(F.size(F.filter("__words", lambda w: F.lower(F.btrim(w, F.lit(PUNCTUATION))).isin(STOP_WORDS)))).alias("n_stop_words"),
        n(F.size("__lines")).alias("__n_lines"),
        n(F.size(F.filter("__lines", lambda x: x.endswith("...") | x.endswith("…")))).alias("__open"),
        n(F.size(F.filter("__lines", lambda x: x.substr(1, 2).isin("- ", "* ", "• ")))).alias("__bullets"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return rows.select(
        *[F.col(f"`{c}`") for c in [*kept, *names[:5]]],
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        "n_stop_words",
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "__n_lines").alias("dup_line_ratio"),
        ratio("__open", "__n_lines").alias("ellipsis_line_ratio"),
        ratio("__bullets", "__n_lines").alias("bullet_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_word_ratio"),
    )


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds the metrics, base_failed, failed_rules (names, in order) and kept."""
    rows = metrics(df, text)
    kept = others(rows, ["base_failed", "failed_rules", "kept"])
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], base.alias("base_failed"), failed.alias("failed_rules"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
