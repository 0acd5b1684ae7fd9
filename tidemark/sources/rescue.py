"""Keep what does not fit the pinned schema instead of losing it or failing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, StructType

RESCUED = "_rescued_data"


def rescue(df: DataFrame, pinned: StructType, name: str = RESCUED) -> DataFrame:
    """Project onto the pinned schema; other fields, and values that do not cast or lose by it, go to a JSON column.

    Works on streams. Read the files with their superset schema (``mergeSchema``)
    first. The JSON is NULL where nothing was left over.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    kept, left = [], []
    for field in pinned.fields:
        if field.name not in have:
            kept.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{field.name}`")
        if have[field.name] == field.dataType:
            kept.append(raw)
            continue
        typed = raw.try_cast(field.dataType)
        if not isinstance(have[field.name], StringType):
            # A value that does not come back from the cast has lost something: 2.7 as a whole number, a time as a date.
            typed = F.when(typed.try_cast(have[field.name]).eqNullSafe(raw), typed)
        kept.append(typed.alias(field.name))
        left.append(F.when(typed.isNull(), raw).alias(field.name))
    left += [F.col(f"`{c}`") for c in have if c not in pinned.fieldNames()]
    if not left:
        return df.select(*kept, F.lit(None).cast("string").alias(name))
    packed = F.to_json(F.struct(*left))
    return df.select(*kept, F.when(packed != "{}", packed).alias(name))


def rescue_json(df: DataFrame, payload: str, pinned: StructType, name: str = RESCUED) -> DataFrame:
    """Parse a JSON text column into pinned fields; other keys go to the JSON column.

    The payload is read once as a map of raw values, so nothing is dropped; text
    that is not a JSON object is kept whole.
    """
    raw = F.from_json(F.col(payload), "map<string,string>")
    known = F.array(*[F.lit(f) for f in pinned.fieldNames()])
    fields = [F.col("_map")[f.name].try_cast(f.dataType).alias(f.name) for f in pinned.fields]
    unfit = [
        F.col("_map")[f.name].isNotNull() & F.col("_map")[f.name].try_cast(f.dataType).isNull() for f in pinned.fields
    ]
    bad = F.array_compact(F.array(*[F.when(u, F.lit(f.name)) for u, f in zip(unfit, pinned.fields, strict=True)]))
    rest = F.map_filter("_map", lambda k, _: ~F.array_contains(known, k) | F.array_contains(bad, k))
    others = [c for c in df.columns if c != payload]
    leftover = (
        F.when(F.col("_map").isNull(), F.col(payload))
        .when(F.size(rest) > 0, F.to_json(rest))
        .otherwise(F.lit(None).cast("string"))
    )
    return df.withColumn("_map", raw).select(*others, *fields, leftover.alias(name))


def _taken(value: Column, kind: DataType) -> Column:
    """A VARIANT value as ``kind``; NULL where it does not cast or loses by it."""
    typed = F.try_variant_get(value, "$", kind.simpleString())
    truth = F.lower(F.try_variant_get(value, "$", "string")).isin("true", "false")
    if isinstance(kind, NumericType):
        # 2.7 is no whole number, and true is no number.
        same = ~truth & (F.try_variant_get(value, "$", "double") == typed.cast("double"))
    elif isinstance(kind, DateType):
        same = F.try_variant_get(value, "$", "timestamp_ntz") == typed.cast("timestamp_ntz")
    elif isinstance(kind, BooleanType):
        same = truth
    else:
        return typed
    return F.when(same, typed)


def rescue_variant(df: DataFrame, payload: str, pinned: StructType, name: str = RESCUED) -> DataFrame:
    """Parse a JSON text column into pinned fields; all else goes to a VARIANT column with its types and nesting.

    Works on streams: a key that appears in mid-stream is kept from its first row on, without a restart or a new
    schema, and files written before it are read along with the later ones. The column is NULL where nothing was left
    over; a JSON value that is no object is kept whole, and so is text that is no JSON, as a string.
    """
    value = F.try_parse_json(F.col(payload))
    known = F.array(*[F.lit(f) for f in pinned.fieldNames()])
    fields = [_taken(F.col("_map")[f.name], f.dataType).alias(f.name) for f in pinned.fields]
    unfit = [
        F.col("_map")[f.name].isNotNull() & ~F.is_variant_null(F.col("_map")[f.name]) & _taken(F.col("_map")[f.name], f.dataType).isNull()
        for f in pinned.fields
    ]
    bad = F.array_compact(F.array(*[F.when(u, F.lit(f.name)) for u, f in zip(unfit, pinned.fields, strict=True)]))
    rest = F.map_filter("_map", lambda k, _: ~F.array_contains(known, k) | F.array_contains(bad, k))
    leftover = (
        F.when(F.col("_map").isNotNull(), F.when(F.size(rest) > 0, F.to_variant_object(rest)))
        .when(F.col("_value").isNotNull(), F.col("_value"))
        .when(F.col(payload).isNotNull(), F.col(payload).cast("variant"))
    )
    others = [c for c in df.columns if c != payload]
    return df.withColumn("_value", value).withColumn("_map", F.col("_value").try_cast("map<string,variant>")).select(*others, *fields, leftover.alias(name))


def rescued_schema(df: DataFrame, name: str = RESCUED) -> DataFrame:
    """One row: the schema that covers every rescued VARIANT value, as text (``appeared``)."""
    return df.agg(F.schema_of_variant_agg(name).alias("appeared"))
