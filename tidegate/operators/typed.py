"""Typed values: infer a schema from JSON bodies, conform bodies to one, report drift."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

PROFILES = ("avro", "json", "protobuf")
ITEM = "[]"  # path step into the first element of an array
WIDEST_SCHEMA = 20_000

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def check_profile(profile: str) -> str:
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}")
    return profile


def json_kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        if INT_MIN <= value <= INT_MAX:
            return "int"
        return "long" if LONG_MIN <= value <= LONG_MAX else "big"
    if isinstance(value, float):
        return "double"
    if isinstance(value, str):
        return "string"
    return "array" if isinstance(value, list) else "object"


def describe(value, path: tuple, found: list) -> None:
    """(path, position, kind) of every field; an array speaks through its first element."""
    if isinstance(value, dict):
        for position, (name, child) in enumerate(value.items()):
            where = path + (name,)
            found.append((where, position, json_kind(child)))
            describe(child, where, found)
    elif isinstance(value, list) and value:
        where = path + (ITEM,)
        found.append((where, 0, json_kind(value[0])))
        describe(value[0], where, found)


FIELD_NOTES = "path array<string>, kind string, position int, n_messages bigint"
NOTES_HELD = 100_000  # notes a task holds before it hands them on


def note_fields(batches):
    """Counts of (path, kind) over a task's bodies: aggregated before the shuffle."""

    def table(notes):
        rows = [(list(path), kind, at, n) for (path, kind), (at, n) in notes.items()]
        return pd.DataFrame(rows, columns=["path", "kind", "position", "n_messages"])

    notes: dict = {}
    for pdf in batches:
        for body in pdf["body"]:
            found: list = []
            try:
                value = json.loads(body)
                if isinstance(value, dict):
                    describe(value, (), found)
            except (ValueError, RecursionError):
                continue
            for path, position, kind in found:
                at, n = notes.get((path, kind), (position, 0))
                notes[path, kind] = (min(at, position), n + 1)
        if len(notes) > NOTES_HELD:
            yield table(notes)
            notes = {}
    yield table(notes)


def is_json_object(body: Column) -> Column:
    text = F.get_json_object(body, "$")
    return F.coalesce(text.startswith("{") & F.ltrim(body).startswith("{"), F.lit(False))


def observed_fields(df: DataFrame) -> DataFrame:
    """(path, kinds, position, n_messages): one row per field path over all object
    bodies. Partial aggregation keeps the shuffle to one row per path and task."""
    notes = df.where(is_json_object(F.col("body"))).select("body").mapInPandas(note_fields, FIELD_NOTES)
    return notes.groupBy("path").agg(
        F.collect_set("kind").alias("kinds"),  # nine kinds at most
        F.min("position").alias("position"),
        F.sum("n_messages").alias("n_messages"),
    )


def widest(kinds: Column, profile: str) -> Column:
    """One kind out of all that were seen at a path."""
    seen = F.array_except(kinds, F.array(F.lit("null")))
    only = lambda *names: F.size(F.array_except(seen, F.array(*[F.lit(n) for n in names]))) == 0
    integers = ("int", "long", "big") if profile == "json" else ("int", "long")
    return (
        F.when(F.size(seen) == 0, "string")
        .when(only("boolean"), "boolean")
        .when(only("int"), "long" if profile == "json" else "int")
        .when(only("int", "long"), "long")
        .when(only(*integers, "double"), "double")
        .when(only("object"), "string" if profile == "protobuf" else "object")
        .when(only("array"), "array")
        .otherwise("string")
    )


def inferred_fields(df: DataFrame, profile: str) -> DataFrame:
    """(path, kind, n_messages) by the profile's rules, merged over all bodies."""
    check_profile(profile)
    return observed_fields(df).select(
        "path", widest(F.col("kinds"), profile).alias("kind"), "position", "n_messages"
    )


SCALARS = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def infer_schema(df: DataFrame, profile: str, first_only: bool = False) -> T.StructType | None:
    """The value schema. ``first_only`` looks at the earliest object body alone.
    Only the field list reaches the driver, never the rows. None where the profile
    cannot express the bodies (nested repeated fields)."""
    rows = df
    if first_only:
        rows = (
            df.where(is_json_object(F.col("body")))
            .orderBy("received_at", "message_id").limit(1)
        )
    listed = inferred_fields(rows, profile).limit(WIDEST_SCHEMA + 1).collect()
    if len(listed) > WIDEST_SCHEMA:
        raise ValueError("bodies have too many different fields to be one schema")
    fields = {tuple(r.path): (r.position, r.kind) for r in listed}
    children: dict[tuple, list] = {}
    for path, (position, _) in fields.items():
        children.setdefault(path[:-1], []).append((position, path[-1]))

    def type_of(path: tuple, item: bool):
        kind = fields[path][1]
        if kind == "object":
            return struct_of(path)
        if kind == "array":
            if item and profile != "json":
                return T.StringType() if profile == "avro" else None
            inner = path + (ITEM,)
            element = type_of(inner, True) if inner in fields else T.StringType()
            return None if element is None else T.ArrayType(element)
        return SCALARS[kind]

    def struct_of(path: tuple):
        members = []
        for _, name in sorted(children.get(path, [])):
            member = type_of(path + (name,), False)
            if member is None:
                return None
            members.append(T.StructField(name, member))
        return T.StructType(members)

    return struct_of(())


def schema_name(topic: str) -> str:
    """Record name of a topic's value."""
    return "".join(c if c.isascii() and c.isalnum() else "_" for c in topic) + "_value"


# --- conforming -------------------------------------------------------------------

# What an absent scalar of the protobuf profile reads as.
PROTOBUF_DEFAULTS = {
    T.StringType(): "",
    T.BooleanType(): False,
    T.IntegerType(): 0,
    T.LongType(): 0,
    T.FloatType(): 0.0,
    T.DoubleType(): 0.0,
}


def variant_step(value: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(value, f"$['{name}']" if "'" not in name else f'$["{name}"]', kind)


def is_container(value: Column) -> Column:
    return F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")


def cast_variant(value: Column, kind: T.DataType, profile: str) -> Column:
    """A variant as a typed value; what cannot be cast is null."""
    if isinstance(kind, T.StructType):
        made = build_struct(value, kind, profile)
        return F.when(F.schema_of_variant(value).startswith("OBJECT"), made)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        return F.transform(items, lambda v: cast_variant(v, kind.elementType, profile))
    scalar = F.try_variant_get(value, "$", kind.simpleString())
    return F.when(~is_container(value), scalar)


def build_struct(value: Column, schema: T.StructType, profile: str) -> Column:
    members = []
    for field in schema.fields:
        child = variant_step(value, field.name, "variant")
        member = cast_variant(child, field.dataType, profile)
        if profile == "protobuf":
            if isinstance(field.dataType, T.ArrayType):
                member = F.coalesce(member, F.array().cast(field.dataType))
            else:
                default = PROTOBUF_DEFAULTS.get(field.dataType)
                if default is not None:
                    member = F.coalesce(member, F.lit(default).cast(field.dataType))
        members.append(member.alias(field.name))
    return F.struct(*members)


def fits(value: Column, kind: T.DataType) -> Column:
    """Whether a present variant is acceptable to the strict (protobuf) reader."""
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        every = F.forall(
            items, lambda v: ~F.is_variant_null(v) & F.coalesce(fits(v, kind.elementType), F.lit(False))
        )
        return F.coalesce(every, F.lit(False))
    scalar = F.try_variant_get(value, "$", kind.simpleString()).isNotNull() & ~is_container(value)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        number = F.try_variant_get(value, "$", "double")
        return scalar & (number == F.floor(number)) & (F.schema_of_variant(value) != "BOOLEAN")
    if isinstance(kind, T.BooleanType):
        text = F.try_variant_get(value, "$", "string")
        return scalar & text.isin("true", "false")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return scalar & (F.schema_of_variant(value) != "BOOLEAN")
    return scalar


def convertible(value: Column, schema: T.StructType) -> Column:
    tests = []
    for field in schema.fields:
        child = variant_step(value, field.name, "variant")
        tests.append(
            child.isNull() | F.is_variant_null(child)
            | F.coalesce(fits(child, field.dataType), F.lit(False))
        )
    return reduce(and_, tests) if tests else F.lit(True)


def conform(df: DataFrame, schema: T.StructType | None, profile: str) -> DataFrame:
    """Add ``typed`` (the struct, null where the body stays text) and ``raw`` (the
    body where it stays text). Unknown fields go, absent ones are null, or their
    default in the protobuf profile."""
    check_profile(profile)
    body = F.col("body")
    if schema is None:
        return df.withColumns({"typed": F.lit(None).cast("string"), "raw": body})
    parsed = F.try_parse_json(body)
    rows = df.withColumn("parsed", F.when(F.ltrim(body).startswith("{"), parsed))
    value = F.col("parsed")
    test = value.isNotNull()
    if profile == "protobuf":
        test = test & convertible(value, schema)
    typed = F.when(test, build_struct(value, schema, profile))
    return rows.withColumn("typed", typed).withColumn(
        "raw", F.when(F.col("typed").isNull(), body)
    ).drop("parsed")


def schema_drift(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing and extra top-level fields of each object body, and whether the
    cached schema may be reused for it in the avro profile."""
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    keys = F.json_object_keys("body")
    return df.where(is_json_object(F.col("body"))).withColumns(
        {
            "missing": F.array_sort(F.array_except(names, keys)),
            "extra": F.array_sort(F.array_except(keys, names)),
        }
    ).withColumn("reusable", F.size("missing") == 0)


def validation_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per (message, field, violation); the messages themselves flow on.
    The top level is closed and all its fields are required; inner objects are open,
    and the types of their fields and of array items are checked."""
    drift = schema_drift(df, schema).withColumn("parsed", F.try_parse_json("body"))
    names = [F.when(test, F.lit(path)) for path, test in type_checks(F.col("parsed"), schema, "")]
    none = F.array().cast("array<string>")
    wrong_type = F.filter(F.array(*names), lambda n: n.isNotNull()) if names else none

    def rows(listed: Column, violation: str) -> Column:
        return F.transform(
            listed, lambda n: F.struct(n.alias("field"), F.lit(violation).alias("violation"))
        )

    listed = F.concat(
        rows(F.col("missing"), "missing_required"),
        rows(F.col("extra"), "extra"),
        rows(wrong_type, "wrong_type"),
    )
    return drift.select("message_id", F.explode(listed).alias("v")).select(
        "message_id", "v.field", "v.violation"
    )


def type_checks(value: Column, schema: T.StructType, prefix: str) -> list[tuple[str, Column]]:
    """(dotted path, whether the value there has the wrong type)."""
    found = []
    for field in schema.fields:
        path = prefix + field.name
        child = variant_step(value, field.name, "variant")
        given = child.isNotNull() & ~F.is_variant_null(child)
        found.append((path, given & ~right_kind(child, field.dataType)))
        if isinstance(field.dataType, T.StructType):
            found += type_checks(child, field.dataType, path + ".")
    return found


def right_kind(value: Column, kind: T.DataType) -> Column:
    """JSON type of a variant against the schema's type (no coercion)."""
    seen = F.schema_of_variant(value)
    if isinstance(kind, T.StructType):
        return seen.startswith("OBJECT")
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        every = F.forall(items, lambda v: F.is_variant_null(v) | right_kind(v, kind.elementType))
        return seen.startswith("ARRAY") & F.coalesce(every, F.lit(False))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return seen == "BIGINT"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return seen.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return seen == ("BOOLEAN" if isinstance(kind, T.BooleanType) else "STRING")
