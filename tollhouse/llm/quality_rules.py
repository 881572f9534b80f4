"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule rejects a text. What a rule costs and how much it rejects is measured on a bounded sample; the rules then run
in the order of rejection per cost, and a text rejected by one is not seen by the next. The order changes the time, not
the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import SPACE_RUN, SPACES, let, text_or_empty

WINDOW = 8
#: Rows of the sample at most, and the share of rows it is drawn from.
SAMPLE_ROWS, SAMPLE_SHARE = 500, 0.2
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Runs of characters other than space and the controls tab to carriage return."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def char_count(text: Column, chars: str) -> Column:
    """How many characters of the text are among ``chars``."""
    left = text
    for c in chars:
        left = F.replace(left, F.lit(c))
    return (F.length(text) - F.length(left)).cast("long")


def lines_of(text: Column) -> Column:
    """Lines with at least one word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")


def repeated_lines(text: Column) -> Column:
    return let(lines_of(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text, first places included.

    Hashes of the windows show the texts without any repeat; only in the others are the windows themselves compared.
    """

    def hashes(w: Column) -> Column:
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))))

    def covered(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.struct(F.array_join(F.slice(w, i, window), " ").alias("k"), i.alias("i")))

        def repeats(s: Column) -> Column:
            same = lambda x, j: F.coalesce(x["k"] == F.get(s, j - 1)["k"], F.lit(False)) | F.coalesce(x["k"] == F.get(s, j + 1)["k"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(F.sort_array(windows), repeats), length)

    many = let(hashes(words), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= window, 0).when(many, covered(words)).otherwise(0).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)``: a boolean column, never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _n(words: Column) -> Column:
    return F.size(words).cast("long")


#: The two rules of the base, then those of the method. All use whole numbers, so that no engine rounds differently.
BASE = (
    Rule("too few words", lambda text, words: _n(words) < 20),
    Rule("repeated windows", lambda text, words: 100 * repeated_words(words) > 30 * _n(words)),
)
RULES = (
    Rule("symbols", lambda text, words: 10 * char_count(text, SYMBOLS) > _n(words)),
    Rule("exclamation marks", lambda text, words: 10 * char_count(text, "!") > 3 * _n(words)),
    Rule("repeated lines", lambda text, words: 10 * repeated_lines(text) > 3 * F.size(lines_of(text))),
    Rule("neighbouring repeats", lambda text, words: 10 * F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))) > 2 * _n(words)),
    Rule("word lengths", lambda text, words: let(F.length(F.array_join(words, "")), lambda n: (n < 2 * _n(words)) | (n > 20 * _n(words)))),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejected: float  # share of the sample
    seconds: float  # for the sample


def measured(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Each rule's cost and rejections on at most ``rows`` rows, drawn from the table's first ones."""
    spark = docs.sparkSession
    drawn = docs.select(text_or_empty(text_col).alias("text")).sample(SAMPLE_SHARE, seed=1).take(rows)
    if not drawn:
        return [Measured(r, 0.0, 1.0) for r in rules]
    sample = spark.createDataFrame(drawn, "text string").coalesce(1)

    def run(rejects: Column) -> tuple[int, float]:
        best, n = float("inf"), 0
        for _ in range(2):
            start = time.perf_counter()
            n = sample.agg(F.count_if(rejects)).first()[0]
            best = min(best, time.perf_counter() - start)
        return n, best

    text = F.col("text")
    words = words_of(text)
    idle = run(F.length(text) < 0)[1]
    out = []
    for rule in rules:
        n, seconds = run(let(words, partial(rule.rejects, text)))
        out.append(Measured(rule, n / len(drawn), max(seconds - idle, 1e-4)))
    return out


def cascade(found: Sequence[Measured]) -> list[Rule]:
    """The rules by rejection per cost; cheaper first where none rejects."""
    return [m.rule for m in sorted(found, key=lambda m: (-m.rejected / m.seconds, m.seconds))]


def rejected(rules: Sequence[Rule], text: Column, words: Column) -> Column:
    """Whether one of the rules rejects; a rule is only computed where those before it did not reject."""
    out = F.lit(False)
    for rule in reversed(rules):
        out = F.when(rule.rejects(text, words), True).otherwise(out)
    return out


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per input row: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    kept (boolean).

    Null and empty texts have no words and fail the base. Repeated rows stay repeated, no rows give no rows, and other
    columns are not read. The measures of the base are given for every row; the cascade skips rows that fail it.
    """
    order = cascade(measured(docs, rules, text_col))
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).withColumn("_words", words_of(F.col("_text")))
    text, words = F.col("_text"), F.col("_words")
    base = rows.select(
        id_col,
        "_text",
        "_words",
        _n(words).alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        char_count(text, SYMBOLS).alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    kept = F.when(F.col("base_failed"), False).otherwise(~rejected(order, text, words))
    return base.withColumn("kept", kept).drop("_text", "_words")


def kept_rows(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = BASE + RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, the base's rules being part of the cascade; columns as they were."""
    order = cascade(measured(docs, rules, text_col))
    text = text_or_empty(text_col)
    return docs.where(~let(words_of(text), partial(rejected, order, text)))
