"""CDC JSON to typed columns, one parse per message.

A record is the row image at ``payload.after`` or, without one, a flat object with ``id`` and ``amount``. One typed parse
reads both forms. Absent members and explicit nulls are both null in it; which of them a null is says the presence mask,
the names of the members, made only for images with a null among the wanted members: an absent component
counts as 0, an explicit null as missing. Messages that the typed parse can not settle (numbers sent as text, payloads that
are null, empty or no object) are parsed again, as texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import timing
from txnlake.schemas import V_COLS

IMAGE = "_image"
COMPONENTS = [c.lower() for c in V_COLS]
NUMBERS = [*COMPONENTS, "amount"]
# Members whose absence means something else than a null.
MASKED = [*NUMBERS, "id", "class"]
TEXTS = ["processed_at", "__deleted"]
KINDS = {**{c: "DOUBLE" for c in NUMBERS}, "id": "LONG", "account_id": "LONG", "time_stamp": "LONG", "class": "INT", **{c: "STRING" for c in TEXTS}}
BAD = "_bad"
CHANGE_SCHEMA = "id LONG, amount DOUBLE, class INT, __deleted STRING, __table STRING, __lsn LONG, __source_ts_ms LONG"


def _once(df: DataFrame, **structs: Column) -> DataFrame:
    """Add columns through a generator: filters and fields above it do not repeat the parsing."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in structs.items()]))))


def _parsed(text: Column, fields: list[str]) -> Column:
    """A struct of the fields (``name TYPE``); ``_bad`` holds the text where it is no JSON object or a field has another type."""
    return F.from_json(text, ", ".join([*fields, f"{BAD} STRING"]), {"columnNameOfCorruptRecord": BAD})


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _any_null(row: Column) -> Column:
    return reduce(or_, [row[c].isNull() for c in MASKED])


def _there(row: Column, member: str, names: Column) -> Column:
    return row[member].isNotNull() | F.coalesce(F.array_contains(names, member), F.lit(False))


def _members(value: Column) -> Column:
    """The number of members of a variant; null where it is no object."""
    return F.cardinality(F.try_variant_get(value, "$", "map<string,variant>"))


def _again(value: Column) -> Column:
    """The image of a message from a parse of its members as texts; null where it has none.

    A member that is there but no number is missing: it keeps its name in the presence mask.
    """

    def text_of(outer: Column) -> Column:
        payload = outer["payload"]
        after = F.try_variant_get(payload, "$.after", "variant")
        n = _members(after)
        blank = after.isNull() | F.is_variant_null(after) | (n == 0)
        text = F.when(outer[BAD].isNotNull(), None).when(payload.isNull(), value).when(_members(payload).isNull(), None)
        return F.struct(text.when(n > 0, F.to_json(after)).when(blank, value).alias("text"), F.coalesce(n > 0, F.lit(False)).alias("wrapped"))

    def cast(row: Column, member: str, kind: str) -> Column:
        own = row[member].try_cast(kind)
        # A whole number may be written with a fraction.
        return F.coalesce(own, row[member].try_cast("decimal(38,9)").try_cast(kind)) if kind in ("LONG", "INT") else own

    def image(chosen: Column, row: Column) -> Column:
        left = F.when(_any_null(row), F.json_object_keys(chosen["text"]))
        valid = row[BAD].isNull() & (chosen["wrapped"] | (_there(row, "id", left) & _there(row, "amount", left)))
        names = F.coalesce(left, F.array(*[F.lit(c) for c in MASKED]))
        typed_row = [cast(row, c, kind).alias(c) for c, kind in KINDS.items()]
        return F.when(valid, F.struct(*typed_row, row["created_at"].alias("created_at"), names.alias("names")))

    fields = [*[f"{c} STRING" for c in KINDS], "created_at VARIANT"]
    read = lambda chosen: F.when(chosen["text"].isNotNull(), _let(_parsed(chosen["text"], fields), lambda row: image(chosen, row)))
    return _let(_parsed(value, ["payload VARIANT"]), lambda outer: _let(text_of(outer), read))


def with_image(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the row image as a typed struct; its field ``valid`` is false for an undecodable record.

    An image that is null or empty falls back to the flat form. A payload that is explicitly null,
    or no object, makes the record undecodable.
    """
    fields = [*[f"{c} {kind}" for c, kind in KINDS.items()], "created_at VARIANT"]
    inner = ", ".join(f.replace(" ", ": ") for f in fields)
    message = F.col(f"`{value}`")
    first = _once(df, _first=_parsed(message, [*fields, f"payload STRUCT<after: STRUCT<{inner}>>"]))
    flat, after = F.col("_first"), F.col("_first.payload.after")
    # A payload may be spelled with escapes. An image of nulls may be an empty one.
    no_payload = ~message.contains("payload") & ~message.contains("\\u")
    filled = F.coalesce(*[after[c].cast("string") for c in ("id", "amount", "class", "account_id")]).isNotNull()
    form = F.when(message.isNull() | (F.trim(message) == ""), "none").when(flat[BAD].isNotNull(), "again")
    form = form.when(no_payload, "flat").when(filled, "wrapped").otherwise("again")
    names = F.when((form == "flat") & _any_null(flat), F.json_object_keys(message))
    names = names.when((form == "wrapped") & _any_null(after), F.json_object_keys(F.get_json_object(message, "$.payload.after")))
    settled = _once(first, _form=form, _names=names, _more=F.when(form == "again", _again(message)))
    kind, more = F.col("_form"), F.col("_more")

    def member(c: str) -> Column:
        return F.when(kind == "flat", flat[c]).when(kind == "wrapped", after[c]).otherwise(more[c])

    valid = F.when(kind == "flat", _there(flat, "id", F.col("_names")) & _there(flat, "amount", F.col("_names")))
    valid = valid.when(kind == "wrapped", True).otherwise(more.isNotNull())
    made = member("created_at")
    image = F.struct(
        valid.alias("valid"),
        *[member(c).alias(c) for c in KINDS],
        F.try_variant_get(made, "$", "string").alias("created_at"),
        (F.schema_of_variant(made) == "STRING").alias("created_is_text"),
        F.when(kind == "again", more["names"]).otherwise(F.col("_names")).alias("names"),
    )
    return settled.withColumn(IMAGE, image).drop("_first", "_form", "_names", "_more")


def split_valid(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decodable records and the quarantined rest."""
    return parted(with_image(df, value))


def parted(imaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of :func:`with_image` that have an image, and those without."""
    valid = F.col(f"{IMAGE}.valid")
    return imaged.where(valid), imaged.where(~valid).drop(IMAGE)


def live(valid: DataFrame) -> DataFrame:
    """Without the deletes the connector rewrites to records."""
    return valid.where(F.coalesce(F.col(f"{IMAGE}.__deleted"), F.lit("false")) != "true")


def _number(name: str, absent: str = "0D") -> Column:
    """Typed value: ``absent`` for an absent member, null where there is no number."""
    return F.expr(f"IF({IMAGE}.{name} IS NULL AND NOT array_contains({IMAGE}.names, '{name}'), {absent}, {IMAGE}.{name}) AS {name}")


def typed(df: DataFrame, epoch_units: str = "calendar") -> DataFrame:
    """Typed columns of the row image.

    Numbers sent as text are cast; text that is no number becomes null and counts as missing.
    """
    rest = [c for c in df.columns if c not in (IMAGE, "value")]
    read = df.select(
        *rest,
        *[F.col(f"{IMAGE}.{c}").alias(n) for c, n in (("id", "id"), ("account_id", "account_id"), ("time_stamp", "time_offset"))],
        *[_number(c) for c in NUMBERS],
        _number("class", "0"),
        F.col(f"{IMAGE}.created_at").alias("_made"),
        F.col(f"{IMAGE}.created_is_text").alias("_text"),
        F.col(f"{IMAGE}.processed_at").alias("processed_text"),
    )
    made, is_text = F.col("_made"), F.col("_text")
    epoch = made.try_cast("double")
    present = made.isNotNull() & F.when(is_text, made != "").otherwise(F.coalesce(epoch != 0, F.lit(True)))
    parsed = F.when(is_text, timing.parse_created_text(made)).otherwise(timing.parse_created_epoch(epoch, epoch_units))
    return read.select(
        *rest,
        *["id", "account_id", "time_offset", *COMPONENTS, "amount", "class"],
        F.when(present, parsed).alias("created"),
        F.coalesce(present, F.lit(False)).alias("created_present"),
        "processed_text",
    )


def change_columns(df: DataFrame) -> DataFrame:
    """Key, order, delete mark, table and source time added by the connector, plus the amount.

    Read from the flat record; a tombstone (null value) has none of them.
    """
    return _once(df.select("value"), _t=F.from_json("value", CHANGE_SCHEMA)).select(
        "_t.id",
        F.col("_t.__lsn").alias("lsn"),
        F.coalesce(F.col("_t.__deleted") == "true", F.lit(False)).alias("deleted"),
        F.col("_t.__table").alias("source_table"),
        F.col("_t.__source_ts_ms").alias("source_ts_ms"),
        "_t.amount",
        "_t.class",
    )


def message_size(df: DataFrame, value: str = "value") -> DataFrame:
    """Length in characters of each message."""
    return df.withColumn("message_length", F.length(value))
