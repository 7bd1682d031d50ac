"""N-gram Jaccard join by token-combination prefixes.

A text's tokens are its distinct shingles of five words.  Texts with equal sets
are one class, so exact copies meet once.  Tokens are ordered by frequency
class: rare ones first, by their hash, then frequent ones from the rarer class
to the commoner.  Two classes that link share a token within their prefixes of
``n - ceil(t n) + 1`` tokens.  If a rare token is among those shared it is found
in the index of single tokens.  Otherwise both prefixes reach their frequent
tokens, so all that they share there is frequent, and prefixes extended by
``g`` tokens share at least ``g + 1`` of them: dealt by hash into ``g`` groups,
two of them meet in one group.  So frequent tokens are indexed by combinations
of two from a group, and a combination that only accidental pairs share is
rare again.  ``g`` is the power of two at or below the prefix length; sizes of
linked classes differ by a third at most, so their ``g`` differ by one step at
most and the longer side indexes the next smaller ``g`` as well.

Candidates of a key are not paired with each other.  First every class of a key
is verified against a few leaders of the key; what links is one component.
Those of crowded keys are compared with more leaders, which joins most of a
group whose texts are barely alike.  Only classes of a key that are in different components after
that are paired, block by block where their signatures lie together, and
verified, so no link between components is lost and a large group of near
copies costs a few comparisons per class.  Many keys have the very same classes
(texts that share a passage share all its keys); one of them stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.components import components
from tidemark.llm.store import written
from tidemark.llm.text import WORD, as_bytes, give_back, hash_words, mix64, ngrams, raw, slices, trimmed

SIZE = 5
#: Similarity in hundredths.
SIMILAR = 75
#: A token that so many texts of one task share counts towards the frequent classes.
SHARED = 2
#: Frequent tokens that the order knows at most (9 bytes each); further ones are ordered as rare ones, which is exact too.
FREQUENT = 1 << 19
#: Frequency class, a power of two, from which a token counts as frequent.
LEAST_LEVEL = 2
#: Tokens whose counts or index entries a task holds at a time.
HELD = 1 << 22
#: Index entries that one task reads on average.
PART_ENTRIES = 2_000_000
#: Leaders that a key's classes are first compared with.
LEADERS = 3
#: Classes of a key from which they are compared with more leaders,
CROWD = 64
#: which are so many times the first ones.
TURNS = 8
#: The least keys of a class, by which classes that share many keys are paired in one of them only.
OWN_KEYS = 8
#: Classes of a key that are paired with each other, or with another block, in one piece.
BLOCK = 512
#: Bytes of classes to be paired that one task reads on average.
TILE_BYTES = 8 << 20
#: Bytes of signatures that are compared at a time.
PAIR_BYTES = 1 << 24
#: Bits of the filter for the sets that are needed, at most.
FILTER_BITS = 1 << 26


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last in slices(offsets):
        low, high = offsets[first], offsets[last]
        words, bounds = hash_words(offsets[first : last + 1] - low, data[low:high], lower=True)
        for k in range(last - first):
            yield np.unique(ngrams(words[bounds[k] : bounds[k + 1]], SIZE))


def class_of(tokens: np.ndarray) -> int:
    """63 bits that stand for the whole set; -1 for the empty one."""
    if not len(tokens):
        return -1
    at = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    both = mix64(tokens + at * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) ^ np.uint64(len(tokens))
    return int(mix64(np.array([both], np.uint64))[0] >> np.uint64(1))


def signature(tokens: np.ndarray) -> bytes:
    """A bit for each token's low bits, four to eight times as many bits as tokens."""
    bits = 1 << max(6, (4 * len(tokens)).bit_length())
    out = np.zeros(bits, bool)
    out[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def most_shared(x: bytes, n_x: int, y: bytes, n_y: int) -> int:
    """Tokens that two sets share at most: all whose bit the other has."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):  # the longer one folded to the low bits of the shorter
        a, b = (a, b[: len(b) // 2] | b[len(b) // 2 :]) if len(a) < len(b) else (a[: len(a) // 2] | a[len(a) // 2 :], b)
    return min(n_x - int(np.bitwise_count(a & ~b).sum()), n_y - int(np.bitwise_count(b & ~a).sum()))


SKETCH = "doc_id long, text_hash long, class long, n int, bits binary, tokens binary, counts binary"


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's class and size; beside them, now and then, the tokens that many of the task's classes share."""
    names = ["doc_id", "text_hash", "class", "n", "bits", "tokens", "counts"]
    known: set[int] = set()
    held: list[np.ndarray] = []
    size = 0

    def shared_tokens():
        token, count = np.unique(np.concatenate(held), return_counts=True)
        often = count >= SHARED
        blob = [pa.array([x.tobytes()], pa.binary()) for x in (token[often], count[often].astype(np.int64))]
        nothing = [pa.array([None], kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        return pa.record_batch(nothing + blob, names)

    for batch in batches:
        classes, sizes, bits = [], [], []
        for tokens in shingle_sets(*raw(batch.column(2))):
            number = class_of(tokens)
            classes.append(number)
            sizes.append(len(tokens))
            bits.append(signature(tokens))
            if len(tokens) and number not in known:
                known.add(number)
                held.append(tokens)
                size += len(tokens)
                if size >= HELD:
                    yield shared_tokens()
                    known, held, size = set(), [], 0
        none = pa.array([None] * batch.num_rows, pa.binary())
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()), none, none],
            names,
        )
    if held:
        yield shared_tokens()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tokens, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.record_batch(
                [pa.array(np.frombuffer(tokens, np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["token", "df"]
            )


def frequent_tokens(stage: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` tokens that many classes share, sorted, and their frequency classes (powers of two)."""
    rows = stage.where("tokens is not null").select("tokens", "counts").mapInArrow(unpacked, "token long, df long")
    counted = rows.groupBy("token").agg(F.floor(F.log2(F.sum("df"))).cast("int").alias("level"))
    counted = written(counted, "frequent")
    known, least = 0, 64
    for row in counted.where(F.col("level") >= LEAST_LEVEL).groupBy("level").count().orderBy(F.desc("level")).collect():  # one row per power of two
        if known + row["count"] > most:
            break
        known, least = known + row["count"], row["level"]
    rows = counted.where(F.col("level") >= least).toPandas()  # at most ``most`` rows
    token = rows["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], rows["level"].to_numpy().astype(np.int8)[order]


def prefix_length(n: int) -> int:
    return n - -(-SIMILAR * n // 100) + 1


def index_keys(tokens: np.ndarray, frequent: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Keys of a set in the index: rare tokens of its prefix, and combinations of frequent ones."""
    n = len(tokens)
    prefix = prefix_length(n)
    level = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        same = frequent[at] == tokens
        level[same] = 1 + levels[at[same]]
    rare = tokens[level == 0]
    if len(rare) >= prefix:
        return rare[:prefix]
    common = tokens[level > 0]
    common = common[np.lexsort((common, level[level > 0]))]
    keys = [rare]
    groups = 1 << (prefix.bit_length() - 1)
    # the smallest prefix of a set that may link to this one
    least = prefix_length(-(-SIMILAR * n // 100))
    while True:
        taken = common[: max(0, prefix + groups - len(rare))]
        keys.append(combinations(taken, groups))
        if groups <= least or groups == 1:
            break
        groups //= 2
    return np.concatenate(keys)


def combinations(tokens: np.ndarray, groups: int) -> np.ndarray:
    """A key for every two tokens of one group."""
    group = mix64(tokens ^ np.uint64(groups)) % np.uint64(groups)
    order = np.lexsort((tokens, group))
    tokens, group = tokens[order], group[order]
    out = []
    for step in range(1, len(tokens)):
        same = group[step:] == group[:-step]
        if not same.any():
            break
        a, b = tokens[:-step][same], tokens[step:][same]
        out.append(mix64(a * np.uint64(0xD6E8FEB86659FD93) + mix64(b) + np.uint64(groups)))
    return np.concatenate(out) if out else tokens[:0]


ENTRIES = "part int, keys binary, places binary, classes binary"
#: Set in a place if its key has further classes in the same task.
MORE = np.uint32(1 << 31)


def entry_batch(held: list[tuple[int, np.ndarray]], parts: int) -> pa.RecordBatch:
    """One row of entries for each part of the index.

    Of the classes that share a key here, the first goes to the key's part; the
    others go by chance to parts of their own (negative numbers), so a part
    gets at most one entry of a key from each task.
    """
    classes = np.array([c for c, _ in held], np.int64)
    place = np.repeat(np.arange(len(held), dtype=np.uint32), [len(k) for _, k in held])
    keys = np.concatenate([k for _, k in held])
    order = np.lexsort((place, keys))
    keys, place = keys[order], place[order]
    other = np.zeros(len(keys), bool)
    other[1:] = keys[1:] == keys[:-1]
    part = (mix64(keys) % np.uint64(parts)).astype(np.int32)
    part[other] = -1 - (mix64(keys[other] ^ place[other]) % np.uint64(parts)).astype(np.int32)
    flagged = place.copy()
    flagged[:-1][other[1:] & ~other[:-1]] |= MORE
    by = np.argsort(part, kind="stable")
    keys, flagged, part = keys[by], flagged[by], part[by]
    rows = []
    for p in np.unique(part).tolist():
        here = slice(np.searchsorted(part, p), np.searchsorted(part, p, "right"))
        used, local = np.unique(flagged[here] & ~MORE, return_inverse=True)
        local = local.astype(np.uint32) | (flagged[here] & MORE)
        rows.append((p, keys[here].tobytes(), local.tobytes(), classes[used].tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.record_batch(columns, ["part", "keys", "places", "classes"])


def index_entries(parts: int, order):
    """Tasks that turn texts into index entries, each class once."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, levels = order.value
        known: set[int] = set()
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for tokens in shingle_sets(*raw(batch.column(0))):
                number = class_of(tokens)
                if not len(tokens) or number in known:
                    continue
                known.add(number)
                held.append((number, np.unique(index_keys(tokens, frequent, levels))))
                size += len(held[-1][1])
                if size >= HELD // 4:
                    yield entry_batch(held, parts)
                    known, held, size = set(), [], 0
        if held:
            yield entry_batch(held, parts)

    return lambda batches: trimmed(entries(batches))


def shared_keys(table: pa.Table) -> pa.Table:
    """(key, class) of the keys of a part that two entries have, or one that left others behind."""
    passed = table["part"][0].as_py() < 0
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    places = [np.frombuffer(x, np.uint32) for x in table["places"].to_pylist()]
    classes = [np.frombuffer(c, np.int64)[p & ~MORE] for p, c in zip(places, table["classes"].to_pylist())]
    classes, more = np.concatenate(classes), np.concatenate(places) >= MORE
    order = np.lexsort((classes, keys))
    keys, classes, more = keys[order], classes[order], more[order]
    same = (keys[1:] == keys[:-1]) & (classes[1:] != classes[:-1])
    kept = more | passed
    kept[1:] |= same
    kept[:-1] |= same
    del table, places
    give_back()
    return pa.table({"key": pa.array(keys[kept].view(np.int64)), "class": pa.array(classes[kept])})


def needed_filter(needed: DataFrame, count: int) -> np.ndarray:
    """Bits set at the low bits of the needed classes; at most ``FILTER_BITS``, whatever the table's size."""
    bits = min(FILTER_BITS, 1 << (16 * max(4, count)).bit_length())
    spot = F.col("class").bitwiseAND(F.lit(bits - 1))
    words = needed.groupBy(F.shiftright(spot, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))).alias("set")
    )
    rows = words.toPandas()  # at most bits / 64 rows
    packed = np.zeros(bits // 64, np.int64)
    packed[rows["word"].to_numpy().astype(np.int64)] = rows["set"].to_numpy()
    return packed


def sets_in(shared):
    """Tasks that give the token sets of the classes that pass the filter, each once."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = shared.value
        known: set[int] = set()
        for batch in batches:
            rows = []
            for tokens in shingle_sets(*raw(batch.column(0))):
                number = class_of(tokens)
                spot = number & (64 * len(packed) - 1)
                if number < 0 or number in known or not int(packed[spot >> 6]) >> (spot & 63) & 1:
                    continue
                known.add(number)
                rows.append((number, tokens.tobytes()))
            if rows:
                number, tokens = zip(*rows)
                yield pa.record_batch([pa.array(number, pa.int64()), pa.array(tokens, pa.binary())], ["class", "tokens"])

    return lambda batches: trimmed(sets(batches))


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of a batch whose sets are similar enough."""
    for batch in batches:
        links = []
        sets = zip(batch.column(2), batch.column(3))
        for row, (x, y) in enumerate(sets):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= SIMILAR * (len(x) + len(y) - both):
                links.append(row)
        yield batch.select([0, 1]).take(pa.array(links, pa.int64()))


def classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class"))


def crowds(members: DataFrame) -> DataFrame:
    """Classes of keys that many classes have."""
    many = members.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") >= CROWD)
    return members.join(many, "key", "left_semi").select("class")


def token_sets(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, tokens) of some classes."""
    needed = written(classes.distinct(), "needed")
    shared = texts.sparkSession.sparkContext.broadcast(needed_filter(needed, needed.count()))
    found = texts.select("text").mapInArrow(sets_in(shared), "class long, tokens binary")
    return written(found.join(needed, "class", "left_semi").dropDuplicates(["class"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.selectExpr("class as a", "tokens as x")
    other = sets.selectExpr("class as b", "tokens as y")
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y")
    return both.mapInArrow(similar, "a long, b long")


def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) of a batch whose signatures allow the similarity."""
    for batch in batches:
        n_a, n_b = batch.column(3).to_pylist(), batch.column(5).to_pylist()
        links = []
        for row, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())):
            both = most_shared(x, n_a[row], y, n_b[row])
            if 100 * both >= SIMILAR * (n_a[row] + n_b[row] - both):
                links.append(row)
        yield batch.select([0, 1]).take(pa.array(links, pa.int64()))


def possible(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs whose sizes and signatures allow the similarity; no pair that has it is lost."""
    one = sizes.selectExpr("class as a", "bits as x", "n as n_a")
    other = sizes.selectExpr("class as b", "bits as y", "n as n_b")
    joined = pairs.join(one, "a").join(other, "b")
    joined = joined.where(f"100 * least(n_a, n_b) >= {SIMILAR} * greatest(n_a, n_b)")
    return joined.select("a", "b", "x", "n_a", "y", "n_b").mapInArrow(plausible, "a long, b long")


def leader_pairs(members: DataFrame) -> DataFrame:
    """Every class of a key with the key's leader; keys choose among a few orders of the classes."""
    turn = F.xxhash64(F.col("class"), F.pmod("key", F.lit(LEADERS)))
    leaders = members.groupBy("key").agg(F.min(F.struct(turn, "class"))["class"].alias("leader"))
    pairs = members.join(leaders, "key").where("class != leader")
    return pairs.selectExpr("least(class, leader) as a", "greatest(class, leader) as b").distinct()


def apart_pairs(rooted: DataFrame, turn: int) -> DataFrame:
    """The leader pairs of a turn whose classes are in different components.

    The leader brings its root along, so pairs of one component, most of those
    of a large group, are not made at all.
    """
    order = F.xxhash64(F.col("class"), F.pmod("key", F.lit(LEADERS)) + LEADERS * turn)
    leaders = rooted.groupBy("key").agg(F.min(F.struct(order, "class", "root")).alias("leader"))
    leaders = leaders.select("key", F.col("leader.class").alias("leader"), F.col("leader.root").alias("other"))
    pairs = rooted.join(leaders, (rooted["key"] == leaders["key"]) & (rooted["root"] != leaders["other"]))
    return pairs.selectExpr("least(class, leader) as a", "greatest(class, leader) as b").distinct()


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, class, root) of keys whose classes are in different components; of keys with the same classes one."""
    known = roots.selectExpr("node as class", "root")
    placed = members.distinct().join(known, "class", "left").selectExpr("key", "class", "coalesce(root, class) as root")
    # two hashes of the set of classes, 128 bits and their number
    same = [F.bit_xor(F.xxhash64("class")).alias("one"), F.bit_xor(F.xxhash64(F.lit("other"), "class")).alias("two")]
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m"), *same)
    kept = mixed.where("low != high").groupBy("m", "one", "two").agg(F.min("key").alias("key")).select("key", "m")
    return placed.join(kept, "key")


def further_links(members: DataFrame, links: DataFrame, tried: DataFrame, sizes: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links after comparing the classes of crowded keys with more leaders, and all pairs that were tried."""
    crowd = rooted(members, components(links)).where(F.col("m") >= CROWD)
    crowd = written(crowd.join(sets.select("class"), "class", "left_semi"), "crowds")
    pairs = apart_pairs(crowd, 1)
    for turn in range(2, TURNS + 1):
        pairs = pairs.union(apart_pairs(crowd, turn))
    pairs = pairs.distinct().join(tried, ["a", "b"], "left_anti")
    more = written(possible(pairs, sizes), "more")
    return links.union(written(verified(more, sets), "links")), tried.union(more)


def folded(bits: list[bytes], width: int) -> np.ndarray:
    """Signatures of at least ``width`` bytes, a multiple of 8, as rows of that width; shorter ones stay empty."""
    out = np.zeros((len(bits), width), np.uint8)
    for row, value in enumerate(bits):
        if len(value) >= width:
            out[row] = np.bitwise_or.reduce(np.frombuffer(value, np.uint8).reshape(-1, width), axis=0)
    return out.view(np.uint64)


def tile_pairs(n: np.ndarray, root: np.ndarray, side: np.ndarray, bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a tile that may link: of different components and, if the tile has two sides, of both."""
    wanted = np.triu(root[:, None] != root, 1)
    if side[0] != side[-1]:
        wanted &= side[:, None] != side
    wanted &= 100 * np.minimum(n[:, None], n) >= SIMILAR * np.maximum(n[:, None], n)
    one, other = np.nonzero(wanted)
    kept = np.zeros(len(one), bool)
    length = np.array([len(value) for value in bits])
    shorter = np.minimum(length[one], length[other])
    for width in np.unique(shorter).tolist():
        rows = folded(bits, width)
        at = np.flatnonzero(shorter == width)
        step = max(1, PAIR_BYTES // width)
        for first in range(0, len(at), step):
            here = at[first : first + step]
            a, b = one[here], other[here]
            x, y = rows[a], rows[b]
            both = np.minimum(
                n[a] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), n[b] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            )
            kept[here] = 100 * both >= SIMILAR * (n[a] + n[b] - both)
    return one[kept], other[kept]


def tiles_paired(table: pa.Table) -> pa.Table:
    """The possible pairs (a, b) of all tiles of a part, most of them in one tile of all that hold them."""
    names = ("key", "low", "high", "side", "class", "root", "n")
    key, low, high, side, number, root, n = (table[name].to_numpy().astype(np.int64) for name in names)
    order = np.lexsort((side, high, low, key))
    key, low, high, side, number, root, n = (x[order] for x in (key, low, high, side, number, root, n))
    bits = table["bits"].take(pa.array(order)).to_pylist()
    lists = table["keys"].combine_chunks().take(pa.array(order))
    keys = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
    new = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(key)]
    found = []
    for first, last in zip(edges, edges[1:]):
        if low[first] != high[first] and side[first] == side[last - 1]:
            continue  # nothing on the other side
        here = slice(first, last)
        one, other = tile_pairs(n[here], root[here], side[here], bits[here])
        # a pair belongs to the least key that both name; if they name none, to all that they share
        shared = (np.intersect1d(keys[first + a], keys[first + b], assume_unique=True) for a, b in zip(one.tolist(), other.tolist()))
        own = np.array([not len(both) or both[0] == key[first] for both in shared], bool)
        one, other = one[own], other[own]
        if len(one):
            both = np.stack([number[here][one], number[here][other]])
            found.append(np.sort(both, axis=0))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def rest_pairs(members: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """Classes that share a key, are in different components and whose sizes and signatures allow the similarity.

    A key's classes are dealt into blocks; every two blocks are a tile, and so
    is every block with itself.  Classes travel with their signature and their
    least keys, once for each tile, and only pairs that pass leave the task that
    holds a tile, mostly one time for all keys that they share.
    """
    signed = sizes.select("class", "n", "bits")
    blocks = F.expr(f"int(ceil(m / {BLOCK}))").alias("blocks")
    placed = rooted(members, roots).select("key", "class", "root", blocks)
    placed = written(placed.join(signed.select("class", "n"), "class"), "mixed")
    own = placed.groupBy("class").agg(F.slice(F.sort_array(F.collect_list("key")), 1, OWN_KEYS).alias("keys"))
    signed = written(signed.join(own, "class"), "signed")
    # a signature has n bytes at most
    volume = placed.agg(F.sum(F.col("blocks") * (F.col("n") + 64 + 8 * OWN_KEYS))).first()[0] or 0
    parts = max(1, -(-int(volume) // TILE_BYTES))
    side = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    tiles = placed.join(signed.select("class", "bits", "keys"), "class").withColumn("side", side)
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    tiles = tiles.withColumn("part", F.pmod(F.xxhash64("key", "low", "high"), F.lit(parts)).cast("int"))
    tiles = tiles.select("part", "key", "low", "high", "side", "class", "root", "n", "bits", "keys")
    return tiles.groupBy("part").applyInArrow(tiles_paired, "a long, b long").distinct()


def join(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_shingles, component_id, and text_hash and root for ``representatives``.

    component_id is the smallest doc_id that the row reaches by links of at
    least 0.75, itself included.  Texts that are null or without words have no
    shingles and link with nothing, not with each other.  A null doc_id links
    like any other but names no component (null if there is no other).  Rows
    that repeat a doc_id are separate texts; no rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), as_bytes().alias("text"))
    stage = written(texts.mapInArrow(lambda batches: trimmed(sketches(batches)), SKETCH), "sketches")
    rows = stage.where("tokens is null").select("doc_id", "text_hash", "class", "n")
    sizes = stage.where("n > 0").groupBy("class").agg(F.max("n").alias("n"), F.min("doc_id").alias("first"), F.max("bits").alias("bits"))
    sizes = written(sizes, "sizes")
    roots = components(class_links(texts, stage, sizes))
    named = sizes.join(roots.selectExpr("node as class", "root"), "class", "left")
    named = named.selectExpr("class", "first", "coalesce(root, class) as root")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    joined = rows.join(named.join(least, "root").select("class", "root", "component_id"), "class", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_hash", "root", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def class_links(texts: DataFrame, stage: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect all that any links connect."""
    context = texts.sparkSession.sparkContext
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // (4 * PART_ENTRIES)))
    order = context.broadcast(frequent_tokens(stage))
    entries = texts.select("text").mapInArrow(index_entries(parts, order), ENTRIES)
    members = written(entries.groupBy("part").applyInArrow(shared_keys, "key long, class long"), "members")
    first = written(possible(leader_pairs(members), sizes), "first")
    sets = token_sets(texts, classes_of(first).union(crowds(members)))
    links = written(verified(first, sets), "links")
    links, tried = further_links(members, links, first, sizes, sets)
    rest = rest_pairs(members, components(links), sizes).join(tried, ["a", "b"], "left_anti")
    rest = written(rest, "rest")
    return links.union(written(verified(rest, token_sets(texts, classes_of(rest))), "links"))


@carries_columns
def representatives(docs: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one: the smallest doc_id (null last), then the smallest hash of
    the text; of equal rows one.  Rows without words all stay."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    chosen = joined.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(doc.alias("doc"), "text_hash")).alias("row"))
    chosen = chosen.select("row.*").distinct().alias("c")
    keyed = docs.withColumn("_doc", doc).withColumn("_hash", F.xxhash64("text"))
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    same = (F.col("d._doc") == F.col("c.doc")) & (F.col("d._hash") == F.col("c.text_hash"))
    kept = keyed.where(words).alias("d").join(chosen, same, "left_semi").dropDuplicates(["_doc", "_hash"])
    return kept.drop("_doc", "_hash").unionByName(docs.where(~words))
