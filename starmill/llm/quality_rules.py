"""Quality rules: one projection that measures each text and applies a threshold table.

Everything is built-in array and string functions over the row's own text, so the operator is a
narrow map: no shuffle, no state, no user function. A text of any length stays in its row; time and
memory are linear in the text, but for a sort of window hashes in texts that repeat an 8-word window.

Defined results: null and empty texts have no words, all counts 0, ``base_failed`` true and ``kept``
false. Repeated rows give repeated results. Null ids pass through. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import named

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for with as was on are be this by from or an at not have "
    "der die das und in zu den von mit ist des sich auf für im dem nicht ein eine als auch "
    "de la le et les des en un du une que est pour qui dans par sur au pas avec plus il elle "
    "el los las del y se lo con una su al por como mi no más para o"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails when ``measure`` (SQL over the measured columns) leaves [low, high].

    A null measure passes; texts below ``min_words`` are not judged.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0

    @property
    def failed(self) -> Column:
        value, fails = F.expr(self.measure), F.lit(False)
        if self.low is not None:
            fails = fails | (value < self.low)
        if self.high is not None:
            fails = fails | (value > self.high)
        return F.coalesce(fails & (F.col("n_words") >= self.min_words), F.lit(False))


# The production thresholds. Ratios are of words, lines or characters.
RULES = (
    Rule("few_words", "n_words", low=20),
    Rule("many_words", "n_words", high=10_000_000),
    Rule("repeated_windows", "100 * n_repeat_words - 30 * n_words", high=0),
    Rule("word_length", "word_chars / nullif(n_words, 0)", low=2, high=15),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", high=0.3),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", low=0.02, min_words=50),
    Rule("capitals", "n_capitals / nullif(word_chars, 0)", high=0.4),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", high=0.5),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", high=0.9, min_words=100),
    Rule("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", high=0.3, min_words=100),
)


def _repeated_words() -> list[tuple[str, Column]]:
    """Steps to the number of words that lie in a window found twice or more.

    Windows are compared by 64-bit hashes of their words' hashes; where sorted neighbours have
    equal hashes, the words themselves decide.
    """
    words, hashes, windows = F.col("words"), F.col("hashes"), F.col("windows")
    ordered, starts, n = F.col("ordered"), F.col("starts"), F.size(F.col("hashes"))

    def same(a: Column, b: Column) -> Column:
        span = F.slice(words, a["p"] + 1, WINDOW) == F.slice(words, b["p"] + 1, WINDOW)
        return F.coalesce((a["h"] == b["h"]) & span, F.lit(False))

    def twin(e: Column, j: Column) -> Column:
        return F.when(same(e, F.get(ordered, j - 1)) | same(e, F.get(ordered, j + 1)), e["p"])

    hashed = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(F.slice(hashes, i + 1, WINDOW))
    )
    return [
        ("hashes", F.transform(words, lambda w: F.xxhash64(w))),
        ("windows", F.when(n >= WINDOW, hashed)),
        ("ordered", F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        )),
        ("starts", F.array_sort(F.filter(
            F.transform(ordered, twin), lambda p: p.isNotNull()
        ))),
        ("n_repeat_words", F.coalesce(
            F.aggregate(
                F.transform(starts, lambda p, i: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))
                )),
                F.lit(0).cast("long"),
                lambda total, part: total + part,
            ),
            F.lit(0).cast("long"),
        )),
    ]


def quality_rules(
    documents: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    stop_words: tuple[str, ...] = tuple(STOP_WORDS),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts per text, whether the base rules failed, the failed rules, and the verdict."""
    df = documents.select(
        named(documents, doc_id).alias("doc_id"),
        F.coalesce(named(documents, text), F.lit("")).alias("text"),
    )
    body, words = F.col("text"), F.col("words")

    def without(characters: str) -> Column:
        return F.length(body) - F.length(F.translate(body, characters, ""))

    def count(items: Column, test) -> Column:
        return F.size(F.filter(items, test)).cast("long")

    lines, known = F.col("lines"), list(dict.fromkeys(stop_words))
    steps = [
        ("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))),
        ("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))),
        *_repeated_words(),
        ("n_words", F.size(words).cast("long")),
        ("n_lines", F.size(lines).cast("long")),
        ("word_chars", (F.length(body) - without(SPACE)).cast("long")),
        ("n_symbols", without(SYMBOLS).cast("long")),
        ("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
        ("n_capitals", without("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑÓÍÁ").cast("long")),
        ("n_stop_words", count(words, lambda w: F.lower(w).isin(known))),
        ("n_bullet_lines", count(lines, lambda x: x.rlike(r"^\s*[-*•‣·]\s"))),
        ("n_ellipsis_lines", count(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        ("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")),
        ("failed_rules", F.concat_ws(",", *[F.when(r.failed, F.lit(r.name)) for r in rules])),
    ]
    for name, value in steps:
        df = df.withColumn(name, value)
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"),
        "failed_rules",
    )
