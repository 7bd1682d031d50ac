"""Line dedup: an exact set-similarity join of all lines, of which later matches are removed.

A line's tokens are its distinct shingles of five words.  Lines that may match
share a token of their prefix ``n - ceil(t n) + 1`` under any order of the
tokens, so a first index under the order of their hashes finds the lines that
have any possible partner: few.  Among these, tokens are counted; ordered from
the rarest on, prefixes, positions and lengths leave few candidates, which are
verified by their whole token sets.

In a key that many lines share, all are first verified against two leaders,
the earliest line and the one with most copies; only lines that match neither
are compared with every earlier line of the key.  Everything is DataFrame code.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.rules import bound
from tidemark.llm.store import written

SIZE = 5
#: Similarity in hundredths.
SIMILAR = 75
#: Bits of the filter for lines with a possible partner, at most.
FILTER_BITS = 1 << 21

_WHITE = r"[\x20\x09-\x0D]+"


def words_of(line: Column) -> Column:
    """Words between ASCII white space; most lines have single blanks only and need no pattern."""
    odd = line.startswith(" ") | line.endswith(" ")
    for text in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | line.contains(text)
    plain = F.when(odd, F.regexp_replace(F.regexp_replace(line, rf"^{_WHITE}|{_WHITE}$", ""), _WHITE, " ")).otherwise(line)
    return F.split(plain, " ")


def tokens_of(words: Column) -> Column:
    """Distinct shingle hashes in ascending order; fewer words than five are one shingle."""

    def shingles(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(words) - SIZE, F.lit(0)))
        return F.transform(places, lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(SIZE)]))

    return F.sort_array(F.array_distinct(bound(words, shingles)))


def prefix_length(n: Column) -> Column:
    return n - F.ceil(n * SIMILAR / 100).cast("int") + 1


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, hash of the text, number, line, key of the line) of all lines with a word."""
    each = docs.where("text is not null").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("number", "line")
    )
    return each.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("key", F.xxhash64("line"))


def place() -> Column:
    """A line's place in the order of doc_id (null last), text and number."""
    first = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    return F.struct(first.alias("doc"), F.col("text_hash"), F.col("number"))


def may_match(lines: DataFrame) -> DataFrame:
    """Keys of lines that share a token of their prefix under the hashes' order with another line of like length."""
    tokens = lines.select("key", tokens_of(words_of(F.col("line"))).alias("tokens")).withColumn("n", F.size("tokens"))
    prefix = F.slice("tokens", 1, prefix_length(F.col("n")))
    entries = tokens.select("key", "n", F.explode(prefix).alias("token"))
    by_size = Window.partitionBy("token").orderBy("n", "key")
    # of the lines of a token the next in size is nearest: if it is too long or too short, all are
    above, below = F.lead(F.struct("n", "key")).over(by_size), F.lag(F.struct("n", "key")).over(by_size)
    placed = entries.select("key", "n", above.alias("above"), below.alias("below"))
    near_above = (F.col("above.key") != F.col("key")) & (100 * F.col("n") >= SIMILAR * F.col("above.n"))
    near_below = (F.col("below.key") != F.col("key")) & (100 * F.col("below.n") >= SIMILAR * F.col("n"))
    # copies of one line stand side by side, so the first or the last of them sees another
    return written(placed.where(near_above | near_below).select("key").distinct(), "may-match")


def passes(keys: DataFrame) -> Column:
    """A test that all ``keys`` pass and most others fail: a literal array of bits of bounded size."""
    bits = min(FILTER_BITS, 1 << max(6, (16 * max(4, keys.count())).bit_length()))
    spot = F.col("key").bitwiseAND(F.lit(bits - 1)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)))
    rows = keys.groupBy(F.shiftright(spot, 6).alias("word")).agg(F.bit_or(one).alias("set")).collect()
    words = [0] * (bits // 64)  # as many as the filter has, at most
    for row in rows:
        words[row["word"]] = row["set"]
    table = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    return F.get(table, F.shiftright(spot, 6)).bitwiseAND(one) != 0


def token_sets(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, tokens, n) of the lines in ``keys``."""
    near = lines.where(passes(keys)).select("key", "line").dropDuplicates(["key"]).join(keys, "key", "left_semi")
    return near.select("key", tokens_of(words_of(F.col("line"))).alias("tokens")).withColumn("n", F.size("tokens"))


def rare_prefixes(sets: DataFrame) -> DataFrame:
    """(token, key, n, at, place, copies): each line's prefix by the tokens' rarity.

    Tokens that one line has come first in the order and are left out: they
    match nothing and only their number counts.
    """
    each = sets.select("key", "n", F.explode("tokens").alias("token"))
    counted = each.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    own = Window.partitionBy("key")
    alone = F.col("n") - F.count("*").over(own)
    ranked = counted.withColumn("at", (alone + F.row_number().over(own.orderBy("df", "token")) - 1).cast("int"))
    prefix = ranked.where(F.col("at") < prefix_length(F.col("n"))).drop("df")
    return prefix.join(sets.select("key", "place", "copies"), "key")


def possible() -> Column:
    """Length and positional filters of a pair (x, y) that shares the token at x_at and y_at."""
    long_enough = 100 * F.least("x_n", "y_n") >= SIMILAR * F.greatest("x_n", "y_n")
    wanted = F.ceil((F.col("x_n") + F.col("y_n")) * SIMILAR / (100 + SIMILAR))
    # at the first token that they share, all that they share is still ahead on both sides
    most = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    return long_enough & (most >= wanted)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Later lines y of pairs (x, y) whose token sets are similar enough."""
    x = sets.select(F.col("key").alias("x"), F.col("tokens").alias("x_tokens"))
    y = sets.select(F.col("key").alias("y"), F.col("tokens").alias("y_tokens"))
    both = F.size(F.array_intersect("x_tokens", "y_tokens"))
    joined = pairs.join(x, "x").join(y, "y").withColumn("both", both)
    similar = 100 * F.col("both") >= SIMILAR * (F.size("x_tokens") + F.size("y_tokens") - F.col("both"))
    return joined.where(similar).select(F.col("y").alias("key")).distinct()


def sides(entries: DataFrame, side: str) -> DataFrame:
    return entries.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("key", "n", "at", "place")])


def later_matches(sets: DataFrame) -> DataFrame:
    """Keys of lines that an earlier line matches."""
    entries = written(rare_prefixes(sets), "prefixes")
    y = sides(entries, "y")
    earliest = F.min(F.struct("place", "key", "n", "at"))
    commonest = F.max(F.struct("copies", "place", "key", "n", "at"))
    leaders = entries.groupBy("token").agg(earliest.alias("a"), commonest.alias("b"))
    led = leaders.select("token", F.explode(F.array(*[F.struct(*[F.col(f"{c}.{f}").alias(f"x_{f}") for f in ("key", "n", "at", "place")]) for c in "ab"])).alias("x")).select("token", "x.*")

    def pairs(y: DataFrame, x: DataFrame) -> DataFrame:
        joined = y.join(x, (y["token"] == x["token"]) & (x["x_place"] < y["y_place"]) & possible())
        return joined.select(F.col("x_key").alias("x"), F.col("y_key").alias("y")).distinct()

    first = written(pairs(y, led), "leader-pairs")
    matched = written(verified(first, sets), "matched")
    open_lines = y.join(matched.select(F.col("key").alias("y_key")), "y_key", "left_anti")
    rest = pairs(open_lines, sides(entries, "x")).join(first, ["x", "y"], "left_anti")
    return matched.union(verified(rest, sets))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, number) of every line that equals or matches an earlier one."""
    lines = lines_of(docs)
    places = lines.select("key", place().alias("place"))
    first = written(places.groupBy("key").agg(F.min("place").alias("place"), F.count("*").alias("copies")), "lines")
    keys = may_match(lines)
    sets = written(token_sets(lines, keys).join(first, "key"), "token-sets")
    near = later_matches(sets).distinct().withColumn("near", F.lit(True))
    touched = first.join(near, "key", "left").where("copies > 1 or near")
    found = lines.select("doc_id", "text_hash", "number", "key", place().alias("own")).join(touched, "key")
    return found.where("near or own > place").select("doc_id", "text_hash", "number").distinct()


@carries_columns
def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the text's later matches removed, beside n_lines and n_removed.

    A line is removed if an earlier line, by doc_id (null last), text and
    number, has the same text or a Jaccard similarity of at least 0.75.  It
    does not matter whether that line stays itself.  Lines without words stay
    and count as lines.  Rows that repeat doc_id and text are one document and
    all keep the same lines.  A null text stays null with no lines; empty texts
    have one line without words; columns of the same names are replaced.
    """
    removed = removed_lines(docs).groupBy("doc_id", "text_hash").agg(F.collect_list("number").alias("_removed"))
    wide = docs.withColumn("_hash", F.xxhash64("text"))
    on = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d._hash") == F.col("r.text_hash"))
    joined = wide.alias("d").join(removed.alias("r"), on, "left").select("d.*", "r._removed")
    parts = F.split("text", "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_removed"))
    text = F.array_join(F.transform(stays, lambda at: F.get("_parts", at)), "\n")
    return (
        joined.withColumn("_parts", parts)
        .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size("_parts")).cast("long"))
        .withColumn("n_removed", F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed")).cast("long"))
        .withColumn("text", F.when(F.col("_removed").isNull(), F.col("text")).otherwise(text))
        .drop("_hash", "_removed", "_parts")
    )
