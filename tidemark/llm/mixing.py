"""Mixing sources to target weights.

Each document gets a hash-random key; within its source the documents are
sorted by ranges of that key, distributed prefix sums of their sizes run over
the ranges, and every source is cut at its exact budget after as many whole
epochs as the budget holds.

A range of keys holds a bounded number of documents whatever share a source
has: ranges are cut from the count of rows, so a hot source is spread over as
many ranges as it needs, and only one sum per range meets in the second step.
Rows that agree in source, doc_id and text are counted before they are dealt
out and told apart only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.text import WORD

#: Documents that one range of keys holds on average.
RANGE_ROWS = 4_000
#: Copies of one document that are written out in one place.
BLOCK = 4_096
#: Bits of a document's random key.
KEY_BITS = 60


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def random_key() -> Column:
    """The first 60 bits of an MD5 of doc_id and text: the same in every run, whatever the partitions."""
    named = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col("text"), F.lit(""))
    )
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Targets of sources, given one row (source, source_size) each.

    Sources in code-point order, null last, take the weights in turn.  ``share``
    of all sizes is dealt by weight; a source stops at ``most`` times its size
    and its excess goes to the others by weight until none is above.  In the
    order of size per weight the sources that stop come first, so one running
    sum finds the level that the rest share.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "turn")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("turn", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("stopped", F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        .withColumn("passed", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("stopped")) / (F.sum("weight").over(everything) - F.col("passed")))
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    shared = ranked.withColumn("first", F.min(F.when(fits, F.struct("place", "level"))).over(everything))
    target = F.when(F.col("place") >= F.col("first.place"), F.col("first.level") * F.col("weight")).otherwise(F.col("cap"))
    return shared.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, source): how many of its words the mix takes, whole epochs first.

    Columns: doc_id, source, key, size (words), source_size, target, taken and
    copy (counting from 0 the rows that agree in source, doc_id and text).  A
    null text has size 0; a null source is a source, a null doc_id a value.
    In each source ``taken`` adds up to the target rounded to whole words, and
    no row gives more than ``most`` times its size.  Keys that tie are ordered
    by doc_id and size, so reruns agree.  No rows give no rows.
    """
    rows = docs.select("doc_id", "source", word_count().alias("size"), random_key().alias("key"))
    ranges = max(1, -(-docs.count() // RANGE_ROWS))
    counted = (
        rows.groupBy("source", "doc_id", "key", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("range", F.expr(f"shiftright(key, {KEY_BITS - (ranges - 1).bit_length()})"))
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    sums = counted.groupBy("source", "range").agg(F.sum("words").alias("range_words"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("range_words").alias("source_size")), weights, share, most)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("range_start", F.coalesce(F.sum("range_words").over(before), F.lit(0)))
    same_source = F.col("l.source").eqNullSafe(F.col("r.source"))
    plan = starts.alias("l").join(targets.alias("r"), same_source).select("l.*", "r.source_size", "r.target")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("so_far", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    each = (
        placed.alias("l")
        .join(plan.alias("r"), same_source & (F.col("l.range") == F.col("r.range")))
        .select("l.*", "r.range_start", "r.source_size", "r.target")
        .withColumn("budget", F.round("target").cast("long"))
        .withColumn("epochs", F.expr("if(source_size > 0, budget div source_size, 0L)"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("start", F.col("range_start") + F.col("so_far") + F.col("copy") * F.col("size"))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    taken = (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    return each.select("doc_id", "source", "key", "size", "source_size", "target", taken, "copy")


@carries_columns
def mixed_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, at the cut only its first words.

    Columns are those of ``docs``; ``n_chars``, if there, is that of the cut
    text.  Of rows that agree in source, doc_id and text one stands for all.
    Documents without words are in no mix.  Copies that are taken alike are
    counted before they meet the document; what is above ``BLOCK`` copies is
    dealt out block by block.
    """
    takes = mixed.where("taken > 0").groupBy("source", "doc_id", "key", "size", "taken").agg(F.count("*").alias("copies"))
    keyed = docs.withColumn("_key", random_key()).dropDuplicates(["source", "doc_id", "_key"])
    on = (
        F.col("d.source").eqNullSafe(F.col("t.source"))
        & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("d._key") == F.col("t.key"))
    )

    def met(takes: DataFrame) -> DataFrame:
        columns = [F.col(f"t.{c}").alias(f"_{c}") for c in ("size", "taken", "copies")]
        return keyed.alias("d").join(takes.alias("t"), on).select("d.*", *columns)

    first = met(takes).withColumn("_block", F.lit(0).cast("long"))
    further = met(takes.where(F.col("copies") > BLOCK)).withColumn("_block", F.explode(F.expr(f"sequence(1L, (_copies - 1) div {BLOCK})")))
    dealt = further.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_key", "_block")
    here = F.least(F.lit(BLOCK), F.col("_copies") - F.col("_block") * BLOCK)
    joined = first.unionByName(dealt).withColumn("_copy", F.explode(F.sequence(F.lit(1), here.cast("int"))))
    epochs = F.expr(
        "concat(array_repeat(_size, cast(_taken div _size as int)),"
        " if(_taken % _size > 0, array(_taken % _size), cast(array() as array<bigint>)))"
    )
    pieces = F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col("_words").cast("int"))
    text = F.when(F.col("_words") == F.col("_size"), F.col("text")).otherwise(F.array_join(pieces, ""))
    out = joined.withColumn("_words", F.explode(epochs)).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
