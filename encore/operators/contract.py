"""G15, types: what the fields of raw messages really hold, against a declared
contract. Messages are parsed as VARIANT, so nothing has to be known beforehand
and no field is lost by not being in a schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE = "(message)"          # stands for the message as a whole
MALFORMED, MISSING = "MALFORMED", "MISSING"


class Field(NamedTuple):
    """Variant types that a field may have, and whether it must be there."""
    types: tuple[str, ...]
    required: bool = True


#: The event message as produced (schemas.EVENT_MESSAGE, by variant type).
EVENT_CONTRACT = {
    "event_id": Field(("STRING",)),
    "user_id": Field(("BIGINT",)),
    "song_id": Field(("STRING",)),
    "timestamp": Field(("STRING",)),
    "event_type": Field(("STRING",)),
    "duration_seconds": Field(("BIGINT", "VOID"), required=False),
}


def parse_variant(messages: DataFrame, column: str = "value") -> DataFrame:
    """One column ``v``: the message as VARIANT, null where it is no JSON."""
    return messages.select(F.try_parse_json(F.col(column).cast("string")).alias("v"))


def field_types(messages: DataFrame, contract: dict[str, Field] = EVENT_CONTRACT,
                column: str = "value") -> DataFrame:
    """field, type, messages, ok: one row for each field and type that occurs
    in any message.

    Fields outside the contract are listed too (not ok), and so are required
    fields that messages lack (MISSING), messages that are no JSON (MALFORMED)
    and those that are JSON but no object (their type), the latter two as the
    field ``(message)``. A JSON null has the type VOID. Numbers with a fraction
    appear as DECIMAL or DOUBLE without their precision.

    One pass: each message gives an array of its field-type pairs, which are
    counted with partial sums, so the shuffle carries one row per pair and task."""
    def kind(value: Column) -> Column:
        return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)

    whole = parse_variant(messages, column).withColumn("kind", F.when(F.col("v").isNull(), MALFORMED).otherwise(
        kind(F.col("v"))))
    odd = whole.filter("kind <> 'OBJECT'").select(F.lit(MESSAGE).alias("field"), F.col("kind").alias("type"))
    spark = messages.sparkSession
    inside = whole.filter("kind = 'OBJECT'").select("v")
    given = (inside.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
             .select(F.col("key").alias("field"), kind(F.col("value")).alias("type")))
    lacking = [F.when(F.try_variant_get("v", f"$.{name}", "variant").isNull(), F.lit(name))
               for name, f in contract.items() if f.required]
    missing = (inside.select(F.explode(F.array_compact(F.array(*lacking))).alias("field"))
               .withColumn("type", F.lit(MISSING)))
    counted = (odd.unionByName(given).unionByName(missing).groupBy("field", "type")
               .agg(F.count("*").alias("messages")))
    ok = F.lit(False)
    for name, f in contract.items():
        ok = ok | ((F.col("field") == name) & F.col("type").isin(*f.types))
    return counted.select("field", "type", "messages", ok.alias("ok"))


def merged_schema(messages: DataFrame, column: str = "value") -> DataFrame:
    """One row, ``schema``: the least type that holds every readable message
    (a field of conflicting types becomes VARIANT)."""
    return parse_variant(messages, column).filter("v is not null").agg(
        F.schema_of_variant_agg("v").alias("schema"))
