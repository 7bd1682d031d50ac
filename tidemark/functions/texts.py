"""Keyword segmentation as column expressions.

Letters and digits form words; runs of Han, kana or hangul characters are cut
into overlapping pairs.  There is no dictionary, so nothing has to be shipped
to executors and the work stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Code ranges of hangul, radicals, kana and Han characters.
PAIRED = (
    r"\u1100-\u11FF\u2E80-\u2FDF\u3041-\u3096\u309D-\u309F\u30A1-\u30FA\u30FC-\u30FF\u31F0-\u31FF"
    r"\u3400-\u4DBF\u4E00-\u9FFF\uAC00-\uD7A3\uF900-\uFAFF\x{20000}-\x{3FFFF}"
)
WORDS = r"[\p{L}\p{N}]+"
RUNS = rf"[{PAIRED}]+|[\p{{L}}\p{{N}}&&[^{PAIRED}]]+"


def tokenize(text: Column | str) -> Column:
    """Array of lower-case keywords; a text without any gives itself, NULL gives NULL."""
    source = F.col(text) if isinstance(text, str) else text
    low = F.lower(source)
    runs = F.regexp_extract_all(low, F.lit(RUNS), F.lit(0))
    # most texts have no character to pair and need no second step per word
    words = F.when(F.rlike(low, F.lit(f"[{PAIRED}]")), F.flatten(F.transform(runs, _split_run))).otherwise(
        F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))
    )
    # through a one-element array, so that the words are not computed again for the test
    known = F.transform(F.array(words), lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(source)))
    return F.when(source.isNotNull(), F.element_at(known, 1))


def _split_run(run: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda at: F.substr(run, at, F.lit(2)))
    paired = F.rlike(run, F.lit(f"^[{PAIRED}]")) & (F.length(run) > 2)
    return F.when(paired, pairs).otherwise(F.array(run))


def register_keyword_function(spark: SparkSession, name: str = "keywords") -> None:
    """Make the segmentation callable from SQL: ``SELECT word FROM log, LATERAL keywords(item)``.

    It is a SQL table function, so SQL users get the same kind of plan as
    ``tokenize`` and no Python worker starts.
    """
    runs = f"regexp_extract_all(lower(item), r'{RUNS}', 0)"
    words = (
        f"flatten(transform({runs}, run -> CASE WHEN rlike(run, r'^[{PAIRED}]') AND length(run) > 2 "
        f"THEN transform(sequence(1, length(run) - 1), i -> substr(run, i, 2)) ELSE array(run) END))"
    )
    # through a one-element array, so that the words are computed once
    known = (
        f"transform(array({words}), found -> CASE WHEN size(found) > 0 THEN found WHEN item IS NOT NULL THEN array(item) END)"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(item STRING) RETURNS TABLE (word STRING) "
        f"RETURN SELECT explode(element_at({known}, 1)) AS word"
    )
