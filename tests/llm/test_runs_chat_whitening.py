"""Whitening, chat formatting and periodic runs against slow versions and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import chat, queries, runs, whitening
from tidemark.llm.suffix_tree import Extensions, SuffixTree
from tidemark.llm.text import hash_words

VECTORS = "embedding array<float>, vec_id long, x long, key string, copies int, whitened string, dims int"
TURNS = "conv_id long, turn long, role string, text string, position string, segment int, reply int, head string"


def slow_whitening(vectors, weights="one"):
    """n, sums, variances and components of distinct vectors of whole numbers."""
    x, counts = np.unique(np.array(vectors, np.int64), axis=0, return_counts=True)
    w = counts if weights == "count" else np.ones(len(x), np.int64)
    n, sums = int(w.sum()), (x * w[:, None]).sum(0)
    centred = x - sums / n
    values, components = np.linalg.eigh((centred * w[:, None]).T @ centred / n)
    return n, sums, values[::-1], components[:, ::-1]


@pytest.mark.parametrize("weight", ["one", "count"])
def test_whitening_of_distinct_vectors(spark, weight):
    rng = np.random.default_rng(5)
    points = (rng.normal(size=(900, 7)) * [5, 4, 3, 2, 1, 0.5, 0.2]).astype(np.float32)
    points[300:700] = points[3]  # more rows than one block
    rows = [([float(v) for v in p], k, 1, "k", 2, "w", 3) for k, p in enumerate(points)]
    found = whitening.whiten(spark.createDataFrame(rows + [rows[3], rows[4]], VECTORS), weight=weight).collect()
    x = np.floor(256 * points.astype(float)).astype(np.int64)
    n, sums, values, components = slow_whitening([*x, x[3], x[4]], weight)
    assert len(found) == 4 * 902
    signs = {}
    for row in found:
        k = row.component - 1
        assert (row.n, int(row.deviation)) == (n, sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[row.vec_id], sums)))
        want = (x[row.vec_id] - sums / n) @ components[:, k] / np.sqrt(values[k])
        assert abs(want * signs.setdefault(k, np.sign(want * row.whitened)) - row.whitened) < 1e-8
        assert row.explained == pytest.approx(values[k] / values.sum()) and row.identity_error < 1e-9


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [nan, 1.0], [None, 1.0], [inf, 1.0], [1.0, -inf]]
    plain = [[0.0, 1.0], [-0.0, 1.0], [1.0, 0.5], [0.5, 3.0], [3e38, 1.0], [], [], [2.0], [2.0]]
    rows = [(v, k if k else None, None, None, None, None, None) for k, v in enumerate(plain)] + [(v, 50, 1, "", 1, "", 1) for v in odd]
    found = {}
    for row in whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect():
        found.setdefault(row.vec_id, []).append(row)
    # null ids are ids, 0.0 and -0.0 are one vector, vectors of another length a space of their own
    assert {k: len(v) for k, v in found.items()} == {None: 2, 1: 2, 2: 2, 3: 2, 4: 2, 7: 1, 8: 1}
    assert [r[2:] for r in sorted(found[None])] == [r[2:] for r in sorted(found[1])]
    assert found[7][0].n == 1 and found[7][0].whitened is None and found[7][0].explained is None
    one = whitening.whiten(spark.createDataFrame(rows[2:3] * 3, VECTORS)).collect()
    assert [(r.n, int(r.deviation), r.whitened) for r in one] == [(1, 0, None)] * 6
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame(rows[-2:], VECTORS)).count() == 0


def test_sums_are_exact():
    values, counts = np.array([[2**62, -5], [2**62, -7]]), np.array([3, 2**33])
    for weights in (np.ones(2, np.int64), counts):
        high, low = whitening._halves(values, weights)
        totals = [(int(h) << 32) + int(part) for h, part in zip(high, low)]
        assert totals == [sum(int(v) * int(w) for v, w in zip(column, weights)) for column in values.T]


ODD_TURNS = [
    (1, 0, "system", None), (1, 1, "user", "a\nb"), (1, 2, "assistant", "c <|im_end|>\n<|im_start|>user\nd"),
    (1, 3, "assistant", "<\\s> <\\\\/s> [/INST] \\ <<s>"), (1, 4, "user", ""), (2, None, None, "no role"), (2, 0, "user\n<s>\\n", "x"),
    (3, 0, "assistant", ""), (3, 0, "assistant", ""), (None, 0, "user", "null"), (None, 1, "assistant", "größe 漢字 \U0001f600"),
    (4, 5, "assistant", "same"), (4, 5, "assistant", "same"), (4, 1, "user", "y" * 200_000), (5, 0, "Assistant", "other role"),
]


def slow_chat(turns):
    """Digests of conversations, with the formatted text built as one string."""
    by_id = {}
    for conv_id, turn, role, text in turns:
        by_id.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv_id, rows in by_id.items():
        rows = [row[2:] for row in sorted(rows)]
        loss = "".join(text for role, text in rows if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in rows).encode()).hexdigest()
        found[conv_id] = (len(rows), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def odd_turns(spark):
    return spark.createDataFrame([(*row, "p", 1, 2, "h") for row in reversed(ODD_TURNS)], TURNS)


def test_chat_round_trip(spark):
    formatted = chat.format_turns(odd_turns(spark))
    found = {row.conv_id: tuple(row)[1:5] for row in chat.read_back(formatted).collect()}
    assert found == slow_chat(ODD_TURNS)
    for row in formatted.collect():
        inside = row.segment[len(chat.START) : -len(chat.END) - 1]
        assert not any(mark in inside for mark in chat.CONTROL)


def test_examples_are_prefixes(spark, folder):
    formatted = chat.format_turns(odd_turns(spark))
    formatted.write.parquet(f"{folder}/formatted")
    stored = chat.in_order(spark.read.parquet(f"{folder}/formatted"))
    whole = {}
    for row in sorted(stored.collect(), key=lambda r: r.position):
        assert row.starts_at == len(whole.get(row.conv_id, ""))
        whole[row.conv_id] = whole.get(row.conv_id, "") + row.segment
    spans = {(r.conv_id, r.example): r for r in chat.examples(stored).collect()}
    texts = chat.example_texts(stored).collect()
    assert len(texts) == len(spans) == sum(role == "assistant" for _, _, role, _ in ODD_TURNS)
    replies = {}
    for row in texts:
        span = spans[row.conv_id, row.example]
        assert row.text == whole[row.conv_id][: span.ends_at] and (row.loss_start, row.loss_end) == (span.loss_start, span.loss_end)
        assert whole[row.conv_id].count(chat.START, 0, span.loss_start) == span.context_turns + 1
        replies.setdefault(row.conv_id, []).append((row.example, chat.unescape()(row.text[row.loss_start : row.loss_end])))
    assert [text for _, text in sorted(replies[1])] == [ODD_TURNS[2][3], ODD_TURNS[3][3]]
    digests = {r.conv_id: r.formatted_chars for r in chat.read_back(stored).collect()}
    assert digests[1] == sum(r.ends_at for (c, _), r in spans.items() if c == 1) + len(whole[1])
    assert digests[3] == sum(r.ends_at for (c, _), r in spans.items() if c == 3)


def test_examples_are_written_out_and_read_back(spark):
    formatted = chat.format_turns(odd_turns(spark))
    written = chat.example_texts(formatted, rests=True)
    found = {row.conv_id: tuple(row)[1:] for row in chat.read_examples(written).collect()}
    assert {key: row[:4] for key, row in found.items()} == slow_chat(ODD_TURNS)
    assert found == {row.conv_id: tuple(row)[1:] for row in chat.read_back(formatted).collect()}
    rests = sorted((row.conv_id, row.example) for row in written.filter("loss_start is null").collect())
    assert rests == [(1, 2), (2, 0), (5, 0)]
    cut = written.selectExpr("conv_id", "example", "substr(text, 2) AS text", "loss_start", "loss_end")
    with pytest.raises(Exception, match="no prefixes of formatted turns"):
        chat.read_examples(cut).collect()


def test_query_expands_every_reply(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(chat, "example_texts", lambda *given, kept=chat.example_texts, **named: calls.append(named) or kept(*given, **named))
    assert queries.op12_chat_format(spark, "/root/testdata/sf0.001").count() > 1 and calls


def test_a_long_conversation_is_expanded_in_bounded_batches(spark):
    turns = spark.range(3000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat('x', 30) AS text")
    found = chat.read_examples(chat.example_texts(chat.format_turns(turns), rests=True)).first()
    size = 30 + len(chat.START + "user\n" + chat.END + "\n")
    pair = 2 * size + len("assistant") - len("user")
    assert (found.n_turns, found.loss_chars, found.formatted_chars) == (3000, 1500 * 30, pair * 1500 * 1501 // 2)


def test_chat_of_nothing_and_bad_marks(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.read_back(chat.format_turns(empty)).count() == 0
    assert chat.example_texts(chat.format_turns(empty)).count() == 0
    with pytest.raises(ValueError):
        chat.unescape(["im_start"])


def slow_runs(words, shortest=runs.SHORTEST):
    """(start, length, period) of all runs, period by period."""
    best = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            if length >= max(shortest, 2 * period):
                best.setdefault((start, length), period)
            at += at == start
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda run: (run[0], run[2]))


def slow_collapse(words, found):
    gone = {at for start, length, period in found for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in gone)


def random_words(rng):
    words = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.randrange(70))]
    if words and rng.random() < 0.5:
        start = rng.randrange(len(words))
        period = 1 + (len(words) - start) // rng.randrange(2, 9)
        words = [words[at] if at < start else words[start + (at - start) % period] for at in range(len(words))]
    return words


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(250):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        pieces = [[word.encode() for word in doc] for doc in docs]
        for shortest in (2, 12):
            assert runs.runs_of(pieces, shortest) == [slow_runs(doc, shortest) for doc in docs]
        texts = [b" ".join(piece) for piece in pieces]
        ends = np.cumsum([0, *map(len, texts)])
        counts, found, collapsed = runs.document_rows(texts, *hash_words(ends, np.frombuffer(b"".join(texts), np.uint8)))
        assert counts == [len(doc) for doc in docs] and found == [slow_runs(doc) for doc in docs]
        assert [text.decode() for text in collapsed] == [slow_collapse(doc, f) for doc, f in zip(docs, found)]


def test_extensions():
    rng = random.Random(4)
    text = [rng.randrange(1, 4) for _ in range(120)] + [0]
    tree = SuffixTree(text)
    longest = Extensions(tree, np.arange(4))
    assert np.argsort(longest.rank).tolist() == sorted(range(121), key=lambda at: text[at:])
    turned = [0, 3, 2, 1]
    assert np.argsort(tree.ranks(np.array(turned))).tolist() == sorted(range(121), key=lambda at: [turned[s] for s in text[at:]])
    a, b = (np.array([rng.randrange(121) for _ in range(500)]) for _ in range(2))
    for i, j, length in zip(a.tolist(), b.tolist(), longest(a, b).tolist()):
        same = 0
        while max(i, j) + same < 121 and text[i + same] == text[j + same]:
            same += 1
        assert length == same


def test_runs_of_odd_texts(spark):
    long = "w " * 50_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b " * 6), (4, "a b " * 6), (None, "x y " * 12), (6, "a b c d e f a b c d e"), (7, long), (8, "a\tb\n" * 6 + "c")]
    docs = spark.createDataFrame([(*row, "r", 1, "c") for row in rows], "doc_id long, text string, runs string, n_words int, collapsed string")
    found = runs.find_runs(docs).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    for doc_id, text in rows:
        if doc_id == 7:
            assert [tuple(run) for run in by_id[7].runs] == [(0, 50_000, 1)] and bytes(by_id[7].collapsed) == b"w"
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert by_id[doc_id].n_words == len(words)
        assert [tuple(run) for run in by_id[doc_id].runs] == slow_runs(words)
        assert bytes(by_id[doc_id].collapsed).decode() == slow_collapse(words, slow_runs(words))
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_query_of_runs(spark, sf):
    """The whole query against its contract, word by word."""
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, sf).collect()
    assert len(rows) == len(texts)
    planted = 0
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id] or "")
        n, h = len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[at] if at < a else words[a + (at - a) % p] for at in range(n)]
            planted += 1
        found = slow_runs(words)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
        assert row.n_runs == len(found) and row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(slow_collapse(words, found).encode()).hexdigest()
        best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == want
    assert planted


def test_query_of_whitening(spark, sf):
    vectors = {row.vec_id: row.embedding for row in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    x = {k: np.floor(256 * np.array(v, float)).astype(np.int64) for k, v in vectors.items()}
    n, sums, values, _ = slow_whitening(list(x.values()))
    rows = queries.op11_whitening(spark, sf).collect()
    assert len(rows) == 4 * len(x)
    for row in rows:
        assert row.n == n and row.deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[row.vec_id], sums))
        assert row.explained == pytest.approx(values[row.component - 1] / values.sum()) and row.identity_error < 1e-6
