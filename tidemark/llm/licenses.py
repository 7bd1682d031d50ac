"""Licence scans: a positional index of rare words over licence templates.

A template is a short licence notice with mandatory key phrases.  The index
holds the places of each template's ``RAREST`` highest-IDF words, taken from
the key phrase that has the rarest word of all: where the template is found,
this phrase stands whole, so both words stand at their places.  In a file that
holds all words of a template's phrases, each place of such a word votes for
where the template would begin, and the beginnings on which all its postings
agree are kept, so none is lost.  A template is found where its key phrases
stand whole, at most ``SLACK`` words around their place.  Everything is an
expression of the file's own row, but for the document frequencies: one small
sum over the whole corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import carries_columns
from tidemark.llm.rules import bound

#: Words of a licence text: letters and digits of ASCII, and all else beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rarest words of each template that are looked up in a file.
RAREST = 2
#: Words that an edited notice may be longer or shorter before a key phrase.
SLACK = 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


#: Between the name and the version in the headers that the licences themselves ask for.
PUBLISHED = "as published by the free software foundation either"
#: Notices as they are commonly written, with the phrases that must stand in them.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("gpl-2.0", f"under the terms of the gnu general public license {PUBLISHED} version 2 of the license", ("gnu general public license", "version 2")),
    Template("gpl-3.0", f"under the terms of the gnu general public license {PUBLISHED} version 3 of the license", ("gnu general public license", "version 3")),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("lgpl", f"under the terms of the gnu lesser general public license {PUBLISHED} version", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("agpl", f"under the terms of the gnu affero general public license {PUBLISHED} version", ("affero general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
)
#: The phrases that count as places, with their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: The words of all phrases: what is looked up, and what must be there for it.
LEXICON = sorted({w for p in [*(p for t in TEMPLATES for p in t.phrases), *(p for p, _ in BASE_PHRASES)] for w in p.split()})
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_words(text: Column) -> Column:
    """Words with A-Z in lower case; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(LICENSE_WORD), F.lit(0))


def strings(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def place(template: Template, phrase: str) -> int:
    """Words of the template before the phrase."""
    return f" {template.text} ".split(f" {phrase} ")[0].strip().count(" ") + (not template.text.startswith(phrase))


def looked_up(template: Template, order: list[str]) -> list[tuple[str, int]]:
    """The rarest words, with their places in the template, of the phrase that has the rarest word."""
    phrase = min(template.phrases, key=lambda p: min(map(order.index, p.split())))
    rarest = sorted(set(phrase.split()), key=order.index)[:RAREST]
    return [(word, place(template, phrase) + phrase.split().index(word)) for word in rarest]


def templates(order: list[str]) -> Column:
    """For each template its label, words, key phrases with their places, the phrases' words and the postings."""
    return F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                strings(t.text.split()).alias("words"),
                F.array(
                    *[F.struct(strings(p.split()).alias("words"), F.lit(place(t, p)).alias("at")) for p in t.phrases]
                ).alias("phrases"),
                strings(sorted({w for p in t.phrases for w in p.split()})).alias("needs"),
                F.array(
                    *[F.struct(F.lit(w).alias("word"), F.lit(at).alias("at")) for w, at in looked_up(t, order)]
                ).alias("postings"),
            )
            for t in TEMPLATES
        ]
    )


def stands(words: Column, phrase: Column, at: Column) -> Column:
    """Whether the phrase's words stand consecutively from place ``at`` (from 0)."""
    return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """Documents that hold each lexicon word, over the whole corpus: at most one row per lexicon word."""
    present = F.array_intersect(license_words(F.col("text")), strings(LEXICON))
    return docs.select(F.explode(present).alias("word")).groupBy("word").agg(F.count("*").alias("df"))


def rarity_order(docs: DataFrame) -> list[str]:
    """The lexicon from the highest IDF to the lowest (ties by the word)."""
    df = {row["word"]: row["df"] for row in document_frequencies(docs).collect()}  # at most len(LEXICON) rows
    return sorted(LEXICON, key=lambda word: (df.get(word, 0), word))


@carries_columns
def scan(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) beside what the scan finds.

    n_words; places, the starts of base phrases in order; base_labels and
    labels (arrays, distinct and sorted; ``labels`` has the templates' too);
    score, the share of a found template's words that stand at their place, 0.5
    at least where a base phrase stands, else 0.  Null and empty texts have no
    words, no labels and score 0.  Repeated rows are scanned alike; columns of
    the same names are replaced.
    """
    order = rarity_order(docs)
    words, present, known = F.col("_words"), F.col("_present"), templates(order)
    none = F.array().cast("array<struct<label:string,score:double>>")

    def starts(phrase: str) -> Column:
        first = F.lit(phrase.split()[0])
        at = F.filter(F.transform(words, lambda w, at: F.when(w == first, at)), lambda at: at.isNotNull())
        found = F.filter(at, lambda at: stands(words, strings(phrase.split()), at))
        return F.when(F.array_contains(present, first), found).otherwise(F.array().cast("array<int>"))

    def beginnings(template: Column) -> Column:
        """Where the template would begin, at most ``SLACK`` words off, by what all its postings agree on."""
        votes = F.transform(
            template["postings"],
            lambda p: F.transform(F.filter(F.col("_hits"), lambda hit: hit["word"] == p["word"]), lambda hit: hit["at"] - p["at"]),
        )
        agreed = F.array_intersect(*[F.get(votes, F.lit(k)) for k in range(RAREST)])
        around = F.transform(agreed, lambda begin: F.sequence(begin - SLACK, begin + SLACK))
        return F.array_distinct(F.flatten(around))

    def verified(template: Column, begin: Column) -> Column:
        return F.forall(
            template["phrases"],
            lambda phrase: F.exists(
                F.sequence(F.lit(-SLACK), F.lit(SLACK)),
                lambda shift: stands(words, phrase["words"], begin + phrase["at"] + shift),
            ),
        )

    def scored(template: Column, begin: Column) -> Column:
        same = F.filter(
            template["words"],
            lambda word, at: F.exists(
                F.sequence(F.lit(-SLACK), F.lit(SLACK)),
                lambda shift: F.coalesce(F.get(words, begin + at + shift) == word, F.lit(False)),
            ),
        )
        score = F.size(same).cast("double") / F.size(template["words"])
        return F.struct(template["label"].alias("label"), score.alias("score"))

    def found(template: Column) -> Column:
        begins = F.filter(beginnings(template), lambda begin: verified(template, begin))
        return F.transform(begins, lambda begin: scored(template, begin))

    likely = F.filter(known, lambda t: F.size(F.array_except(t["needs"], present)) == 0)
    wanted = F.flatten(F.transform("_likely", lambda t: F.transform(t["postings"], lambda p: p["word"])))
    spots = F.transform(words, lambda word, at: F.struct(word.alias("word"), at.alias("at")))
    hits = bound(wanted, lambda wanted: F.filter(spots, lambda spot: F.array_contains(wanted, spot["word"])))
    matches = F.flatten(F.transform("_likely", found))
    base = F.array_compact(
        F.array(*[F.when(F.size(F.col(f"_base{k}")) > 0, F.lit(label)) for k, (_, label) in enumerate(BASE_PHRASES)])
    )
    wide = docs.withColumn("_words", license_words(F.col("text"))).withColumn(
        "_present", F.array_intersect(words, strings(LEXICON))
    )
    wide = wide.withColumn("_likely", likely).withColumn("_hits", F.when(F.size("_likely") > 0, hits))
    for k, (phrase, _) in enumerate(BASE_PHRASES):
        wide = wide.withColumn(f"_base{k}", starts(phrase))
    wide = wide.withColumn("_matches", F.when(F.size("_hits") > 0, matches).otherwise(none))
    every = F.concat(*[F.col(f"_base{k}") for k in range(len(BASE_PHRASES))])
    wide = (
        wide.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("places", F.sort_array(every))
        .withColumn("base_labels", F.sort_array(base))
        .withColumn(
            "labels",
            F.sort_array(F.array_distinct(F.concat("base_labels", F.transform("_matches", lambda m: m["label"])))),
        )
        .withColumn(
            "score",
            F.greatest(
                F.coalesce(F.array_max(F.transform("_matches", lambda m: m["score"])), F.lit(0.0)),
                F.when(F.size("places") > 0, 0.5).otherwise(0.0),
            ),
        )
    )
    return wide.drop("_words", "_present", "_likely", "_hits", "_matches", *[f"_base{k}" for k in range(len(BASE_PHRASES))])
