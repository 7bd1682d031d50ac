"""A look-up that reads only the codes a batch needs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators.joins import lookup_join
from tidemark.sources.lookup import KeyedLookup, read_lookup


@pytest.fixture
def table(spark, folder):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("dic_code"), F.concat(F.lit("n"), "id").alias("dic_name"))
    rows.write.parquet(f"{folder}/codes")
    return f"{folder}/codes"


def facts(spark, *codes):
    return spark.createDataFrame([(code, n) for n, code in enumerate(codes)], "code STRING, n INT")


def joined(spark, lookup, *codes):
    return lookup_join(facts(spark, *codes), lookup, "code", "label")


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_only_needed_codes_are_read_and_kept(spark, table):
    lookup = read_lookup(spark, table, keyed="dic_code")
    rows = joined(spark, lookup, "7", "8", "7", None, "unknown")
    assert sorted((r.n, r.label) for r in rows.collect()) == [(0, "n7"), (1, "n8"), (2, "n7")]
    assert "BroadcastHashJoin" in plan_of(rows) and "FileScan" not in plan_of(rows)
    pruned = plan_of(lookup.wanted(spark.read.parquet(table), ["7", "8"]))
    assert "PushedFilters: [In(dic_code, [7,8])]" in pruned
    assert lookup.fetches == 1
    # known codes are not read again, unknown ones too are known to be so
    assert joined(spark, lookup, "8", "unknown").count() == 1 and lookup.fetches == 1
    assert joined(spark, lookup, "8", "9").count() == 2 and lookup.fetches == 2


def test_codes_that_are_too_old_are_read_again(spark):
    versions = iter("abc")
    lookup = KeyedLookup(lambda: spark.sql(f"SELECT '1' AS dic_code, '{next(versions)}' AS dic_name"), ttl=0.0)
    assert [joined(spark, lookup, "1").collect()[0].label for _ in range(3)] == ["a", "b", "c"]


@pytest.mark.parametrize("bounds", [{"most_rows": 3}, {"most_bytes": 40}])
def test_more_than_the_bound_is_never_broadcast(spark, table, bounds):
    lookup = KeyedLookup(lambda: spark.read.parquet(table), **bounds)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = joined(spark, lookup, "1", "2", "3", "4", "5")
        assert sorted(r.label for r in rows.collect()) == ["n1", "n2", "n3", "n4", "n5"]
        assert "BroadcastHashJoin" not in plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_codes_with_several_or_too_many_rows(spark):
    rows = spark.sql("SELECT '1' AS dic_code, string(id) AS dic_name FROM range(5)")
    assert joined(spark, KeyedLookup(lambda: rows), "1", "1").count() == 10
    assert joined(spark, KeyedLookup(lambda: rows, most_rows=3), "1", "1").count() == 10


def test_what_was_used_longest_ago_is_forgotten(spark, table):
    lookup = KeyedLookup(lambda: spark.read.parquet(table), most_rows=2)
    for codes in (("1", "2"), ("3",), ("2", "3")):
        assert joined(spark, lookup, *codes).count() == len(codes)
    assert set(lookup._known) == {"2", "3"} and lookup.fetches == 2


def test_a_stream_is_joined_batch_by_batch(spark, table, folder):
    facts(spark, "1").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("code STRING, n INT").parquet(f"{folder}/in")
    with pytest.raises(ValueError):
        lookup_join(stream, read_lookup(spark, table, keyed="dic_code"), "code", "label")


def test_sql_evaluates_the_words_once(spark):
    texts.register_keyword_function(spark)
    rows = spark.sql("SELECT word FROM VALUES ('abc 小米盒 かな한글말')  AS log(item), LATERAL keywords(item)")
    assert sorted(r.word for r in rows.collect()) == sorted(["abc", "小米", "米盒", "かな", "な한", "한글", "글말"])
    logical = rows._jdf.queryExecution().analyzed().toString()
    assert logical.count("regexp_extract_all") == 1
