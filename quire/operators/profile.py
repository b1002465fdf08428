"""Schema inference over records: types, nullability, enumerations, required keys; and rendering as JSON Schema."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct strings up to which a path is an enumeration, and properties beyond which none are required.
ENUM, REQUIRED = 12, 60


def leaves(df: DataFrame, columns: list[str]) -> DataFrame:
    """(path, type, value): a row for each row and column."""
    kind = {"string": "string", "bigint": "integer", "int": "integer", "smallint": "integer", "double": "number", "float": "number", "boolean": "boolean"}
    types = dict(df.dtypes)
    each = [F.struct(F.lit(c).alias("path"), F.when(F.col(c).isNull(), "null").otherwise(kind.get(types[c], "string")).alias("type"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def _kind(of: T.DataType) -> str:
    if isinstance(of, T.BooleanType):
        return "boolean"
    if isinstance(of, T.IntegralType):
        return "integer"
    if isinstance(of, T.NumericType):
        return "number"
    if isinstance(of, (T.StructType, T.MapType)):
        return "object"
    return "array" if isinstance(of, T.ArrayType) else "string"


def _key(name: Column) -> Column:
    """A key as a step of a path: what parts paths is written otherwise."""
    return F.replace(F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("."), F.lit("~1")), F.lit("["), F.lit("~2"))


def _inside(value: Column, of: T.DataType, path: Column) -> Column:
    """A value and all that it holds, as an array of (path, type, value)."""
    kind = _kind(of)
    text = value.cast("string") if kind not in ("object", "array") else F.lit(None).cast("string")
    own = F.array(F.struct(path.alias("path"), F.when(value.isNull(), "null").otherwise(kind).alias("type"), text.alias("value")))
    if isinstance(of, T.StructType):
        below = [_inside(value[f.name], f.dataType, F.concat(path, F.lit("."), _key(F.lit(f.name)))) for f in of.fields]
        return F.when(value.isNull(), own).otherwise(F.concat(own, *below))
    if isinstance(of, T.ArrayType):
        below = F.flatten(F.transform(value, lambda x: _inside(x, of.elementType, F.concat(path, F.lit("[]")))))
        return F.when(value.isNull(), own).otherwise(F.concat(own, below))
    if isinstance(of, T.MapType):
        key = lambda e: _key(e["key"].cast("string"))
        below = F.flatten(F.transform(F.map_entries(value), lambda e: _inside(e["value"], of.valueType, F.concat(path, F.lit("."), key(e)))))
        return F.when(value.isNull(), own).otherwise(F.concat(own, below))
    return own


def nested_leaves(df: DataFrame, columns: list[str]) -> DataFrame:
    """(path, type, value) of columns and of all that they hold, at any depth: a.b for fields and keys, a[] for elements.

    Objects and arrays have rows of their own, without a value. Nothing is shuffled: a row gives its own leaves.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    each = [_inside(F.col(f"`{c}`"), kinds[c], _key(F.lit(c))) for c in columns]
    return df.select(F.explode(F.concat(*each)).alias("x")).select("x.*")


def json_leaves(df: DataFrame, column: str) -> DataFrame:
    """(path, type, value) of the top-level keys of JSON objects."""
    exploded = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("path", "value"))
    kind = F.when(F.col("value").isNull(), "null").when(F.col("value").rlike(r"^-?\d+$"), "integer").when(F.col("value").rlike(r"^-?\d+\.\d+([eE][-+]?\d+)?$"), "number").when(F.col("value").isin("true", "false"), "boolean").otherwise("string")
    return exploded.select("path", kind.alias("type"), "value")


def profile(leaf: DataFrame, objects: int | None = None) -> DataFrame:
    """By path: present, types (integer with number is number), nullable, distinct strings, the enumeration if there is one.

    Distinct values are counted after partial de-duplication, so a path with many values costs one shuffle.
    """
    values = leaf.groupBy("path", "type", "value").agg(F.count("*").alias("n"))
    got = values.groupBy("path").agg(
        F.sum("n").alias("present"),
        F.array_sort(F.collect_set(F.when(F.col("type") != "null", F.col("type")))).alias("types"),
        F.bool_or(F.col("type") == "null").alias("nullable"),
        F.count(F.when(F.col("type") == "string", 1)).alias("strings"),
    )
    number = F.array_contains("types", "number") & F.array_contains("types", "integer")
    got = got.withColumn("types", F.when(number, F.array_remove("types", "integer")).otherwise(F.col("types")))
    return got if objects is None else got.withColumn("required", F.col("present") == objects)


def enumerations(leaf: DataFrame, most: int = ENUM) -> DataFrame:
    """Paths of strings with most values or fewer, and those values in order."""
    values = leaf.filter("type = 'string'").select("path", "value").distinct()
    few = values.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") <= most)
    return values.join(few.select("path"), "path").groupBy("path").agg(F.array_sort(F.collect_list("value")).alias("values"))


def _steps(path: str) -> list[str]:
    """The paths from the column down to this one."""
    cuts = [i for i, c in enumerate(path) if c in ".["]
    return [*(path[:i] for i in cuts), path]


def json_schema(title: str, profiled: DataFrame, enums: DataFrame, objects: int | None = None) -> str:
    """A draft 2020-12 schema from profile() and enumerations(); rows are as few as paths.

    Paths of nested_leaves() make nested objects and arrays. A key is required where it stands as often as what
    holds it; at the top that is the number of objects, if given, else what profile() told.
    """
    values = {r["path"]: r["values"] for r in enums.collect()}
    rows = {r["path"]: r.asDict() for r in profiled.collect()}
    top: dict[str, object] = {"type": "object"}
    made: dict[str, dict] = {"": top}
    for path, r in sorted(rows.items(), key=lambda x: (len(_steps(x[0])), x[0])):
        types = [*r["types"], *(["null"] if r["nullable"] else [])]
        made[path] = one = {"type": types[0] if len(types) == 1 else types}
        if r["types"] == ["string"] and path in values:
            one["enum"] = [*values[path], *([None] if r["nullable"] else [])]
        parent = "" if len(_steps(path)) == 1 else _steps(path)[-2]
        if path.endswith("[]"):
            made[parent]["items"] = one
            continue
        holder, key = made[parent], path[len(parent) :].removeprefix(".").replace("~2", "[").replace("~1", ".").replace("~0", "~")
        holder.setdefault("properties", {})[key] = one
        need = r["present"] == (rows[parent]["present"] if parent else objects)
        if need or (not parent and objects is None and r.get("required")):
            holder.setdefault("required", []).append(key)
    for one in made.values():
        if len(one.get("properties", {})) > REQUIRED:
            one.pop("required", None)
        elif "required" in one:
            one["required"].sort()
    schema = {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, "type": "array", "items": top}
    return json.dumps(schema, ensure_ascii=False, indent=2, sort_keys=True)
