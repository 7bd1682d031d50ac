"""Operators on single texts, against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html, language, licenses, mixing, packing, quality, queries, rules
from tests.llm.conftest import ODD

TEXTS = ODD + [
    (20, "All rights reserved. Licensed under CC BY-NC 4.0.\nall RIGHTS reserved"),
    (21, "This work is licensed under the GNU General Public License, version 3. a b c a b c a b"),
    (22, "# * $ & < a-bé Été the the the the the"),
    (23, "Released under the MIT License.\nReleased under the MIT License."),
]


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_rules(documents):
    got = {(r.doc_id, r.text): r for r in rules.quality(documents(TEXTS)).collect()}
    for doc_id, text in TEXTS:
        w, row = words(text), got[doc_id, text]
        runs = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        inside = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [line for line in (text or "").split("\n") if line.encode().split()]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want, text
        assert row.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (row.base_failed and row.kept)
    assert rules.quality(documents([])).count() == 0


def test_licences(documents):
    got = {(r.doc_id, r.text): r for r in licenses.scan(documents(TEXTS)).collect()}
    for doc_id, text in TEXTS:
        lowered = (text or "").encode().lower().decode()
        w, row = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered), got[doc_id, text]
        places, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (row.n_words, row.places, row.base_labels) == (len(w), sorted(places), sorted(labels))
        assert labels <= set(row.labels) and 0 <= row.score <= 1
    assert got[20, TEXTS[-4][1]].labels == ["cc-by", "cc-by-nc", "reserved"]
    assert got[21, TEXTS[-3][1]].labels == ["gpl", "gpl-3.0"]
    assert got[23, TEXTS[-1][1]].labels == ["mit"]
    assert licenses.scan(documents([])).count() == 0


def test_licences_beside_each_other(documents):
    """Rare words of one notice, or of the prose around it, hide no other notice."""
    notices = [t.text for t in licenses.TEMPLATES]
    labels = {t.label for t in licenses.TEMPLATES} | {label for p, label in licenses.BASE_PHRASES if any(p in n for n in notices)}
    apart = " filler" * 40
    prose = "released forms person domain binary universal source charge software mozilla affero dedicated " * 3
    rows = [
        (1, (apart + "\n").join(notices)),
        (2, prose + "word " * 20_000 + "MIT License\n" + "word " * 50 + prose),
        (3, notices[1] + apart + " Licensed under the Apache License, Version 2.0"),
        (4, "Licensed under the GNU General Public License, in its version 3"),
        (5, "mit" + apart + " license version 2 0 apache"),
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(rows)).collect()}
    assert set(got[1].labels) == labels and got[1].score == 1
    assert got[2].labels == ["mit"]
    assert got[3].labels == ["apache-2.0", "bsd"]
    assert got[4].labels == ["gpl", "gpl-3.0"]
    assert got[5].labels == [] and got[5].score == 0


def test_licences_by_standard_headers(documents):
    """Name and version stand apart in the usual headers; the lesser and Affero licences have no version's label."""
    header = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {} as published"
        " by\nthe Free Software Foundation{} version {}.\n"
    )
    rows = [
        (1, header.format("General Public License", ", either", "3 of the License, or\n(at your option) any later")),
        (2, header.format("General Public License", "; either", "2 of the License, or (at your option) any later")),
        (3, header.format("General Public License", ";", "2")),
        (4, header.format("Lesser General Public License", ", either", "3 of the License, or (at your option) any later")),
        (5, header.format("Affero General Public License", ", either", "3 of the License, or (at your option) any later")),
        (6, header.format("General Public License", "; either", "4")),
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(rows)).collect()}
    found = {k: [label for label in row.labels if label != "gpl"] for k, row in got.items()}
    assert found == {1: ["gpl-3.0"], 2: ["gpl-2.0"], 3: ["gpl-2.0"], 4: ["lgpl"], 5: ["agpl"], 6: []}
    assert [got[k].score for k in (1, 2, 4, 5)] == [1] * 4


def test_mixing(documents):
    rows = [(k, "w " * (1 + k % 7), None, f"s{k % 4}" if k % 3 else "s0") for k in range(200)]
    rows += [(300, None, None, "s0"), (301, "a b", None, None), (7, "a b c", None, "s1"), (7, "a b c", None, "s1")]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for row in got:
        by[row.source].append(row)
        assert 0 <= row.taken <= 2 * row.size
    weights = dict(zip(sorted(s for s in by if s) + [None], (3, 1, 2, 3, 1)))
    sizes = {s: sum(r.size for r in group) for s, group in by.items()}
    targets, free, rest = {}, set(by), 1.5 * sum(sizes.values())
    while free:
        level = rest / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 2 * sizes[s]}
        for s in full or free:
            targets[s] = 2 * sizes[s] if full else level * weights[s]
        free -= full or free
        rest = 1.5 * sum(sizes.values()) - sum(targets[s] for s in targets)
    for s, group in by.items():
        assert group[0].target == pytest.approx(targets[s])
        assert sum(r.taken for r in group) == math.floor(targets[s] + 0.5)
    again = mixing.mix(documents(rows).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mixed_documents(documents(rows), mixing.mix(documents(rows))).collect()
    taken = Counter()
    for row in mixed:
        taken[row.source] += len(words(row.text))
    assert taken == {s: sum(r.taken for r in g) for s, g in by.items()}
    assert mixing.mix(documents([])).count() == 0


def test_mixing_of_many_copies(documents):
    """Copies of one document are neither gathered in one row nor written out in one task, at any cut."""
    n = 2 * mixing.BLOCK + 5
    rows = [(7, "a b c", None, "s0")] * n + [(k, f"w{k} x", None, f"s{k % 3}") for k in range(20, 60)]
    docs = documents(rows)
    mix = mixing.mix(docs)
    mixed = mixing.mixed_documents(docs, mix)
    assert "collect_list" not in mixed._jdf.queryExecution().toString()
    got = Counter(mixed.groupBy("doc_id", "text").count().rdd.map(tuple).map(lambda r: ((r[0], r[1]), r[2])).collectAsMap())
    want = Counter()
    for row in mix.collect():
        text = "a b c" if row.doc_id == 7 else f"w{row.doc_id} x"
        want[row.doc_id, text] += row.taken // row.size
        if row.taken % row.size:
            want[row.doc_id, " ".join(text.split()[: row.taken % row.size])] += 1
    assert got == +want
    spread = mixed.where("doc_id = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(row["count"] for row in spread) < sum(row["count"] for row in spread)


def test_packing(documents):
    tokenizer = packing.WordIds(queries.vocabulary_path()).tokenizer
    rows = TEXTS + [(30, "a<|endoftext|>b. Été, x\x1cy H̱. 12.5 Σ. İ! 'll re. 漢字。")]
    got = packing.pack(documents(rows), queries.vocabulary_path(), group_docs=4).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in got:
        pieces[row.doc_id].append((row.start, row.ids, row.doc_tokens))
        sequences[row.sequence_id].append((row.offset, row.length))
        assert len(row.ids) == 4 * row.length
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
    for doc_id, texts in want.items():
        whole = b"".join(bytes(ids) for _, ids, _ in sorted(pieces[doc_id]))
        assert sorted(whole) == sorted(b"".join(texts))
        if len(texts) == 1:
            assert whole == texts[0]
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    assert packing.pack(documents([]), queries.vocabulary_path()).count() == 0


def test_first_fit_decreasing():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 100, 200)
    bins, _ = packing.first_fit_decreasing(sizes, 100)
    free, want = [], {}
    for k in np.argsort(-sizes, kind="stable"):
        at = next((b for b, left in enumerate(free) if left >= sizes[k]), len(free))
        if at == len(free):
            free.append(100)
        free[at] -= sizes[k]
        want[k] = at
    assert bins == [want[k] for k in range(200)]


def test_code_lengths():
    texts = {"aa": "the cat sat on the mat " * 3, "bb": "le chat est sur la natte é " * 3}
    counts = {}
    for lang, text in texts.items():
        data = np.frombuffer(text.encode(), np.uint8)
        gram, _ = language.grams(*language.letters(np.array([0, len(data)]), data))
        counts[lang] = tuple(x.astype(t) for x, t in zip(np.unique(gram, return_counts=True), (np.uint32, float)))
    trees = language.grow(counts)

    def slow(lang, text):
        """Bits by looking up each context in turn."""
        data = np.frombuffer(text.encode(), np.uint8)
        gram, _ = language.grams(*language.letters(np.array([0, len(data)]), data))
        seen = Counter()
        for g, n in zip(*counts[lang]):
            for level in range(4):
                seen[level, int(g) & ((1 << 8 * (level + 1)) - 1)] += n
        every = {level: {g & ((1 << 8 * (level + 1)) - 1) for c, _ in counts.values() for g in c.tolist()} for level in range(4)}
        bits = 0.0
        for g in gram.tolist():
            for level in range(3, -1, -1):
                key = g & ((1 << 8 * (level + 1)) - 1)
                if level and (key >> 8) not in every[level - 1]:
                    continue
                below = {k: n for (lv, k), n in seen.items() if lv == level and k >> 8 == key >> 8}
                if not below:
                    continue
                whole = sum(below.values()) + len(below)
                if key in below:
                    bits += math.log2(whole / below[key])
                    break
                bits += math.log2(whole / len(below))
            else:
                bits += 8
        return bits

    for text in ("the natte", "zzz été", "", "cat sur"):
        data = np.frombuffer(text.encode(), np.uint8)
        got = language.code_lengths(trees, np.array([0, len(data)]), data)[0]
        assert got == pytest.approx([slow(lang, text) for lang in ("aa", "bb")], rel=1e-4), text


def test_languages_are_found(spark, sf, documents):
    found = queries.op10_language_id(spark, sf).alias("f")
    docs = spark.read.parquet(f"{sf}/documents.parquet").alias("d")
    both = found.join(docs, "doc_id").where("held_out and lang is not null").selectExpr("avg(int(lang = lang_pred)) as hit").first()
    assert both.hit > 0.95
    odd = documents(ODD + [(40, "123 !!")])
    got = language.identify(odd, language.fit(odd)).collect()
    assert all(row.lang_pred == "und" for row in got) and len(got) == len(ODD) + 1


def test_classifier(spark, sf, documents):
    scored = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    row = scored.join(labels, "doc_id").where("held_out").selectExpr("avg(int(predicted = quality)) as hit", "count(*) as n").first()
    assert row.hit > 0.9 and row.n > 30
    docs = documents(ODD)
    weights = quality.fit(docs, labels.limit(0))
    assert {row.score for row in quality.score(docs, weights).collect()} == {0.5}


def test_extraction(spark):
    pages = [
        (1, "u", '<nav><a href="/">home</a></nav><article><h1>T &amp; x</h1><p>One\n two<br>three<p>four</article><footer>f</footer>'),
        (2, "u", None), (3, "u", ""), (4, "u", "<p"), (5, None, "<article><p>" + "long text " * 20_000 + "</article>"),
        (6, "u", '<article><p>main text of the page that goes on</p><section class="comments"><p>I like it</p></section></article>'),
    ]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == "T & x\nOne two three\nfour"
    assert (got[2], got[3]) == ("", "") and len(got[5]) == 199_999
    assert got[6] == "main text of the page that goes on"


def test_extraction_with_omitted_tags(spark):
    """The end tag of a head, and those of body and html, may be left out."""
    article = "<article><h1>A</h1><p>main text of the page that goes on</p></article>"
    head = "<head><meta charset=utf-8><title>T</title><style>p {}</style><script>x</script><noscript><img src=x></noscript>"
    heads = (f"{head}</head><body>", f"{head}<body>", head, f"{head}</head>", f"<head>{head}<body>", "<title>T</title>", "<head><body>")
    pages = [f"<!doctype html><html>{h}{article}{end}" for h in heads for end in ("</body></html>", "</body>", "")]
    rows = [(k, "u", page) for k, page in enumerate(pages)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: "A\nmain text of the page that goes on" for k in range(len(pages))}
    loose = html.parse(f"{head}words <b>of</b> the body<img src=x></head>").blocks
    assert [" ".join("".join(runs).split()) for _, runs in loose] == ["words of the body"]


def test_extraction_of_formulas(spark):
    """Formulas and the text that stands for an object belong to the text around them; a formula's source is not shown."""
    formula = (
        "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
        '<annotation encoding="application/x-tex">E=mc^2</annotation></semantics></math>'
    )
    table = "<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>0</mn></mtd></mtr><mtr><mtd><mn>0</mn></mtd></mtr></mtable></math>"
    page = f'<article><p>We know that {formula} holds, see <object data="x.svg">a drawing of it</object> and {table} here.</p></article>'
    got = html.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).first().text
    assert got == "We know that E=mc2 holds, see a drawing of it and 1 0 0 here."
    cut = html.parse("<p>a <math><semantics><mi>x</mi><annotation>y<p>b <b>c</b></p>").blocks
    assert [" ".join("".join(runs).split()) for _, runs in cut] == ["a x", "b c"]


def test_marginals_are_exact():
    model = html.train(html.labelled_pages())
    nodes = html.parse('<div class="content"><p>some text here</p><div class="ad"><p>x</p></div></div>').nodes
    own = [model.evidence(here) for here in html.seen(nodes)]
    total, main = 0.0, [0.0] * len(nodes)
    for code in range(1 << len(nodes)):
        state = [code >> k & 1 for k in range(len(nodes))]
        odds = model.prior[state[0]] + sum(own[k][state[k]] for k in range(len(nodes)))
        odds += sum(model.step[state[nodes[k].parent]][state[k]] for k in range(1, len(nodes)))
        weight = math.exp(odds)
        total += weight
        main = [m + weight * s for m, s in zip(main, state)]
    assert model.marginals(nodes) == pytest.approx([m / total for m in main])
