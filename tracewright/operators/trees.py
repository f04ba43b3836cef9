"""Trees inside variants: every node with its pointer, the subschemas of a schema, and flat paths of an output schema.

A walk takes a level a round: the nodes of a level are exploded by ``variant_explode``, so no value is walked in Python and
a wide node is as many rows as it has children. Levels are written to the shared folder; there are as many rounds as the
deepest document has levels. Null documents have no nodes; JSON's null is a node; empty containers are nodes without
children; keys may repeat, then their trees are told apart by nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.session import written

#: Keywords of JSON Schema that hold one schema, schemas by name, and lists of schemas.
ONE_SCHEMA = ("items", "additionalProperties", "contains", "propertyNames", "not", "if", "then", "else")
NAMED_SCHEMAS = ("properties", "patternProperties", "$defs", "definitions", "dependentSchemas")
LISTED_SCHEMAS = ("prefixItems", "oneOf", "anyOf", "allOf")
#: Fixed value: levels of an output schema that its flat paths tell apart.
FLAT_DEPTH = 3


def _token(name: Column, pos: Column) -> Column:
    return F.coalesce(F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), pos.cast("string"))


def _children(nodes: DataFrame, node: str = "node") -> DataFrame:
    """The nodes' columns with ``pos``, ``name`` (null in arrays) and ``child`` of each child."""
    parts = nodes.sparkSession.tvf.variant_explode(F.col(node).outer()).toDF("pos", "name", "child")
    return nodes.lateralJoin(parts)


def _kind(node: Column) -> Column:
    name = F.schema_of_variant(node)
    return F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").otherwise("scalar")


def _walked(level: DataFrame, below) -> DataFrame:
    """All levels: ``below`` gives the next one of (keys, pointer, depth, node)."""
    level = written(level, "tree-level")
    out = level
    while not level.isEmpty():
        level = written(below(level), "tree-level")
        out = out.unionAll(level)
    return out


def tree_nodes(df: DataFrame, key: str, document: str) -> DataFrame:
    """(key, pointer, depth, kind, value) of every node: object, array or scalar, with a scalar's JSON."""
    start = df.where(F.col(document).isNotNull()).select(key, F.lit("").alias("pointer"), F.lit(0).alias("depth"), F.col(document).alias("node"))

    def below(level: DataFrame) -> DataFrame:
        inner = level.where(_kind(F.col("node")) != "scalar")
        return _children(inner).select(key, F.concat("pointer", F.lit("/"), _token(F.col("name"), F.col("pos"))).alias("pointer"), (F.col("depth") + 1).alias("depth"), F.col("child").alias("node"))

    kind = _kind(F.col("node"))
    return _walked(start, below).select(key, "pointer", "depth", kind.alias("kind"), F.when(kind == "scalar", F.to_json("node")).alias("value"))


def schema_nodes(df: DataFrame, key: str, schema: str) -> DataFrame:
    """(key, pointer, depth, type) of a schema's objects and of all schemas in it; other members aren't walked."""
    is_object = lambda c: _kind(F.col(c)) == "object"
    start = df.where(F.col(schema).isNotNull() & is_object(schema)).select(key, F.lit("").alias("pointer"), F.lit(0).alias("depth"), F.col(schema).alias("node"))

    def below(level: DataFrame) -> DataFrame:
        members = _children(level).select(key, "depth", F.col("name").alias("word"), F.concat("pointer", F.lit("/"), F.col("name")).alias("pointer"), "child")
        one = members.where(F.col("word").isin(*ONE_SCHEMA)).select(key, "pointer", "depth", "child")
        held = members.where((F.col("word").isin(*NAMED_SCHEMAS) & is_object("child")) | (F.col("word").isin(*LISTED_SCHEMAS) & (_kind(F.col("child")) == "array")))
        many = _children(held.withColumnRenamed("child", "node")).select(key, F.concat("pointer", F.lit("/"), _token(F.col("name"), F.col("pos"))).alias("pointer"), "depth", "child")
        return one.unionAll(many).where(is_object("child")).select(key, "pointer", (F.col("depth") + 1).alias("depth"), F.col("child").alias("node"))

    return _walked(start, below).select(key, "pointer", "depth", F.try_variant_get("node", "$.type", "string").alias("type"))


def success_data(schema: Column) -> Column:
    """The schema of ``data`` in the branch of ``oneOf`` whose ``success`` is true, else in the first that has data."""
    branches = F.coalesce(F.try_variant_get(schema, "$.oneOf", "array<variant>"), F.array().cast("array<variant>"))
    marked = F.filter(branches, lambda b: F.coalesce(F.to_json(F.try_variant_get(b, "$.properties.success.const", "variant")) == "true", F.lit(False)))
    with_data = F.filter(branches, lambda b: F.try_variant_get(b, "$.properties.data", "variant").isNotNull())
    return F.try_variant_get(F.coalesce(F.get(marked, 0), F.get(with_data, 0)), "$.properties.data", "variant")


def flat_paths(schema: Column, deepest: int = FLAT_DEPTH) -> Column:
    """The paths of a schema's fields, as ``items[].id``, sorted within each level; what lies below ``deepest`` levels is
    told by the path above it."""
    none = F.array().cast("array<string>")

    def flat(node: Column, prefix: Column, depth: int) -> Column:
        if depth > deepest:
            return none
        kind = F.try_variant_get(node, "$.type", "string")
        items = F.try_variant_get(node, "$.items", "map<string,variant>")
        members = F.try_variant_get(node, "$.properties", "map<string,variant>")
        here = F.when(prefix != "", F.array(prefix)).otherwise(none)

        def field(e: Column) -> Column:
            path = F.when(prefix != "", F.concat(prefix, F.lit("."), e["key"])).otherwise(e["key"])
            below = F.array(flat(e["value"], path, depth + 1))  # as an argument, so that it is computed once
            return F.get(F.transform(below, lambda b: F.when(F.size(b) > 0, b).otherwise(F.array(path))), 0)

        inside = F.flatten(F.transform(F.array_sort(F.map_keys(members)), lambda k: field(F.struct(k.alias("key"), F.try_element_at(members, k).alias("value")))))
        found = F.when((kind == "array") & items.isNotNull(), flat(F.try_variant_get(node, "$.items", "variant"), F.concat(prefix, F.lit("[]")), depth + 1))
        found = found.when(F.coalesce(F.size(members), F.lit(0)) > 0, inside).otherwise(here)
        return F.when(F.try_variant_get(node, "$", "map<string,variant>").isNull(), none).otherwise(found)

    return flat(schema, F.lit(""), 0)
