"""Quality rules: a table of thresholds compiled into one projection.

Every document is measured by native expressions in its own row; there is no
shuffle.  ``RULES`` says what may pass; ``compiled`` turns it into a single
condition, so further rules cost nothing but their measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.text import WORD


@dataclass(frozen=True)
class Rule:
    """``measure`` (an expression over the measures) must lie between the bounds; ``base`` rules stand alone too."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    base: bool = False


#: Function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it with as for on be by this are or was from at an not have "
    "le la les de des et un une en que qui est pour dans sur pas avec du au plus "
    "der die das und den von zu mit sich ist auf nicht ein eine dem im als auch es für "
    "el los las del y por con para su al lo como más o se no una"
).split()

RULES = (
    Rule("words", "n_words", least=50, base=True),
    Rule("repetition", "try_divide(100 * n_repeat_words, n_words)", most=50, base=True),
    Rule("longest_text", "n_words", most=1_000_000),
    Rule("word_length", "try_divide(word_chars, n_words)", least=2, most=15),
    Rule("symbols", "try_divide(100 * n_symbols, n_words)", most=20),
    Rule("stop_words", "n_stop_words", least=2),
    Rule("alphabetic", "try_divide(100 * n_alpha_words, n_words)", least=60),
    Rule("duplicate_lines", "try_divide(100 * n_dup_lines, n_lines)", most=50),
    Rule("ellipses", "try_divide(100 * n_ellipsis_lines, n_lines)", most=30),
    Rule("bullets", "try_divide(100 * n_bullet_lines, n_lines)", most=90),
)


def compiled(rules: tuple[Rule, ...]) -> Column:
    """True where every rule holds; a ratio over nothing does not hold."""
    checks = []
    for rule in rules:
        measure = F.expr(rule.measure)
        if rule.least is not None:
            checks.append(F.coalesce(measure >= F.lit(rule.least), F.lit(False)))
        if rule.most is not None:
            checks.append(F.coalesce(measure <= F.lit(rule.most), F.lit(False)))
    whole = checks[0]
    for check in checks[1:]:
        whole = whole & check
    return whole


def bound(value: Column, body) -> Column:
    """``body`` of ``value`` computed once (an array of one element, transformed)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, size: int = 3) -> Column:
    """Words that lie in a run of ``size`` words found twice or more in the array.

    Each run becomes one number: the high bits are its hash, the low bits its
    position.  After one sort equal runs are neighbours; their positions, in
    order, give the length of the union of the runs.
    """

    def measured(run: Column) -> Column:
        bits = F.length(F.bin(F.size(words).cast("long")))
        packed = F.transform(
            F.sequence(F.lit(1), F.size(words) - (size - 1)),
            lambda at: F.call_function("shiftleft", run(at), bits).bitwiseOR(at.cast("long")),
        )
        return bound(F.sort_array(packed), lambda order: covered(order, bits))

    def covered(order: Column, bits: Column) -> Column:
        def high(x: Column) -> Column:
            return F.call_function("shiftright", x, bits)

        def twin(x: Column, at: Column) -> Column:
            ahead = high(F.get(order, at + 1)) == high(x)
            behind = high(F.get(order, at - 1)) == high(x)
            return F.coalesce(ahead, F.lit(False)) | F.coalesce(behind, F.lit(False))

        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        places = F.sort_array(F.transform(F.filter(order, twin), lambda x: x.bitwiseAND(low)))
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-size).cast("long").alias("last"))
        return F.aggregate(
            places,
            start,
            lambda acc, x: F.struct(
                (acc["words"] + F.least(F.lit(size).cast("long"), x - acc["last"])).alias("words"), x.alias("last")
            ),
            lambda acc: acc["words"],
        )

    def run(at: Column) -> Column:
        return F.xxhash64(*[F.get(words, at + (k - 1)) for k in range(size)])

    return F.when(F.size(words) > size, measured(run)).otherwise(F.lit(0).cast("long"))


@carries_columns
def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) beside the measures, base_failed and kept.

    A null text has no words; empty tables give no rows; columns of the same
    names as the measures are replaced.  Each repeated row is judged alike.
    """
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    text = F.coalesce(F.col("text"), F.lit(""))
    stop = F.array(*[F.lit(word) for word in STOP_WORDS])

    def matches(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    wide = docs.withColumn("_words", F.coalesce(words, F.array().cast("array<string>"))).withColumn("_lines", lines)
    word_chars = F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    measured = (
        wide.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", word_chars.cast("long"))
        .withColumn("n_symbols", matches(r"[#*$%&|<>]"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines")))
        .withColumn("n_repeat_words", repeat_words(F.col("_words")))
        .withColumn("n_stop_words", F.size(F.array_intersect(F.transform("_words", F.lower), stop)).cast("long"))
        .withColumn("n_alpha_words", matches(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]*+\p{L}"))
        .withColumn("n_ellipsis_lines", matches(r"(?m)(\.\.\.|…)[\x20\x09\x0B-\x0D]*$"))
        .withColumn("n_bullet_lines", matches(r"(?m)^[\x20\x09\x0B-\x0D]*[•‣*-][\x20\x09]"))
        .withColumn("base_failed", ~compiled(tuple(rule for rule in rules if rule.base)))
        .withColumn("kept", compiled(rules))
    )
    return measured.drop("_words", "_lines")
