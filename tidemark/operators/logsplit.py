"""Splitting one log record into the records of five streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.records import fields_of

TAGS = ("page", "start", "display", "action", "error")


def _part(value: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(value, path, kind)


def _without(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda name, _: ~name.isin(*names))


def _with(fields: Column, **more: Column) -> Column:
    """``fields`` with others put in their place; NULL ones are left out."""
    put = F.create_map(*[part for name, value in more.items() for part in (F.lit(name), value)])
    return F.map_concat(_without(fields, *more), F.map_filter(put, lambda _, value: value.isNotNull()))


def _inside(objects: Column) -> Column:
    """Texts of JSON objects without their braces."""
    return F.transform(objects, lambda text: F.substring(text, F.lit(2), F.length(text) - 2))


def _object(name: Column, value: Column) -> Column:
    """The text of an object with one field; the names in an object are written faster than in a variant."""
    own = _part(value, "map<string,variant>")
    return F.when(own.isNotNull(), F.to_json(F.create_map(name, own))).otherwise(F.to_json(F.create_map(name, value)))


def _member(name: str, value: Column) -> Column:
    """The text of one field of an object; NULL without a value."""
    return F.when(value.isNotNull(), F.element_at(_inside(F.array(F.to_json(F.create_map(F.lit(name), value)))), 1))


def _marked(record: Column, mark: Column) -> Column:
    """The record with this new-visitor mark, if it has one."""
    common = _part(record["common"], "map<string,variant>")
    put = _with(common, is_new=mark.cast("variant"))
    differs = _part(record["common"], "string", "$.is_new") != mark
    return F.when(differs, _with(record, common=F.to_variant_object(put))).otherwise(record)


def tagged(records: DataFrame, common_as_string: bool = False, tags: Sequence[str] = TAGS) -> DataFrame:
    """(tag, value) rows: one pass over the log, one output row per derived record.

    Records are texts (``value``) and the new-visitor mark they shall have
    (``common.is_new``).  A record with ``err`` goes to *error* as a whole,
    then goes on without it.  A record with ``start`` goes to *start* and
    nowhere else.  Every other one gives its displays (with the page's time),
    its actions (with their own time) and the page itself without both.  All
    other fields go along as they are.  ``common_as_string`` embeds the common
    fields in displays and actions as JSON text, not as an object.  Records of
    streams that are not among ``tags`` are not made.
    """
    # a generator keeps the parse apart: it is used many times below
    return tagged_fields(
        records.select(F.col("common.is_new").alias("_mark"), F.explode(F.array(known_fields("value"))).alias("_given")),
        common_as_string,
        tags,
    )


def known_fields(value: str) -> Column:
    """The fields of a JSON object that have a value; NULL for all other text."""
    return F.map_filter(fields_of(F.col(value)), lambda _, field: ~F.is_variant_null(field))


def tagged_fields(read: DataFrame, common_as_string: bool = False, tags: Sequence[str] = TAGS) -> DataFrame:
    """The same for records that are parsed: their fields (``_given``) and their mark (``_mark``)."""
    whole = read.select(_marked(F.col("_given"), F.col("_mark")).alias("_record"))

    record, none = F.col("_record"), F.array().cast("array<struct<tag: string, value: string>>")
    launch = record["start"].isNotNull()
    rest = _without(record, "err", "displays", "actions")
    kept = F.when(~launch, rest)
    each = F.transform(F.map_entries(kept), lambda field: _object(field["key"], field["value"]))
    # to write a variant as text is most of the work, so what the page, its displays and its actions share is written once
    sharing = {"display", "action"} & set(tags)
    written = whole.select("_record", F.map_from_arrays(F.map_keys(kept), _inside(each)).alias("_texts")) if sharing else whole
    texts = F.col("_texts")
    if sharing:
        common = _member("common", F.to_json(record["common"]).cast("variant")) if common_as_string else texts["common"]
        page_id = _member("page_id", _part(record["page"], "variant", "$.page_id"))
        shared = F.when(~launch, F.nullif(F.concat_ws(",", common, page_id), F.lit("")))
        written = written.select("_record", "_texts", shared.alias("_shared"))

    def one(tag: str, value: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), value.alias("value"))

    def many(tag: str, items: str, *more: str) -> Column:
        # an item that is no object has no fields of its own
        listed = _part(record[items], "array<map<string,variant>>")
        own = F.transform(listed, lambda item: F.coalesce(item, F.create_map().cast("map<string,variant>")))
        fields = _inside(F.transform(own, lambda item: F.to_json(_without(item, "common", "page_id", *more))))

        def whole_item(text: Column) -> Column:
            members = F.concat_ws(",", F.nullif(text, F.lit("")), F.col("_shared"), *[texts[name] for name in more])
            return one(tag, F.concat(F.lit("{"), members, F.lit("}")))

        return F.when(~launch, F.coalesce(F.transform(fields, whole_item), none)).otherwise(none)

    page = F.concat(F.lit("{"), F.array_join(F.map_values(texts), ","), F.lit("}")) if sharing else F.to_json(rest)
    made = {
        "error": lambda: F.when(record["err"].isNotNull(), F.array(one("error", F.to_json(record)))).otherwise(none),
        "start": lambda: F.when(launch, F.array(one("start", F.to_json(_without(record, "err"))))).otherwise(none),
        "display": lambda: many("display", "displays", "ts"),
        "action": lambda: many("action", "actions"),
        "page": lambda: F.when(~launch, F.array(one("page", page))).otherwise(none),
    }
    parts = F.concat(*[part() for tag, part in made.items() if tag in tags])
    # the outer form, because the plain one is tested for emptiness first, which makes the parts twice
    rows = written.select(parts.alias("_parts")).select(F.explode_outer("_parts").alias("_part")).select("_part.tag", "_part.value")
    # of all streams a record gives at least one
    return rows if set(tags) == set(TAGS) else rows.filter(F.col("tag").isNotNull())


def split_log(records: DataFrame, common_as_string: bool = False) -> dict[str, DataFrame]:
    """The five streams by tag, each a DataFrame of JSON ``value`` rows."""
    rows = tagged(records, common_as_string)
    return {tag: rows.filter(F.col("tag") == tag).select("value") for tag in TAGS}
