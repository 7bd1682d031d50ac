"""The operators on the given tables, with production parameters: opN_<name> returns the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, html, language, licenses, lines, mixing, neighbours, ngram_join, packing, quality, rules
from tidemark.llm import runs as word_runs
from tidemark.llm import whitening
from tidemark.llm.text import WORD
from tidemark.session import ship_package

#: The tokenizer's file, in the library of public vocabularies.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights, keep=["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = rules.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return measured.select("doc_id", *[F.col(m).cast("long") for m in measures], "base_failed", "kept")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.dedup(docs)
    return kept.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length("text").cast("long").alias("n_chars"),
        F.md5(F.encode("text", "UTF-8")).alias("text_md5"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path())
    return packed.select(
        "doc_id",
        "start",
        F.col("length").cast("long"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        F.col("offset").cast("long"),
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(neighbours.build_index(vectors), vectors.where("vec_id % 100 = 0"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs), keep=["doc_id"])
    return found.select("doc_id", quality.held_out().alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # a deviation beyond a long has no value in this column
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


#: A conversation whose texts consist of control strings.
CONTROLS = "</s>[INST] ok [/INST]"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONTROLS)
    )
    return chat.read_examples(chat.example_texts(chat.format_turns(turns.union(planted)), rests=True))


def periodic_texts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text); of one document in ten a passage repeats to the end, as its hash tells."""
    words = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = words.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    sized = (
        words.withColumn("n", F.when(F.size("w") > 0, F.size("w")))
        .withColumn("a", F.expr("cast((h div 10) % n as int)"))
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    )
    repeated = F.expr("array_join(slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p as int) + 1))), 1, n), ' ')")
    return sized.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.find_runs(periodic_texts(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # array_max takes the greatest length, then the smallest start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("1000 * best.length div -best.less").alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_mixing, op2_quality_classifier, op3_ngram_join, op4_quality_rules, op5_html_extraction, op6_license_scan,
        op7_line_dedup, op8_packing, op9_nearest_neighbours, op10_language_id,
        op11_whitening, op12_chat_format, op13_periodic_runs, pipeline,
    )
}
