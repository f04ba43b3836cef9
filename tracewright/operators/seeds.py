"""Environment seeds from catalogue entries and older seeds, inside variants: projection, migration, sets that must hold together.

Entries are variants, and each is one row from start to end. A projection that can't be made gives a null seed and a reason
instead of an error, so one bad entry doesn't end a job; a null entry has the reason ``no document``. Members of a variant
come in the order of their names; JSON's null and a missing member are the same here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of an entry that are no metadata; members of older seeds that are gone; members of a tool that
#: are taken over under other names; fields that rank tools by use, the first that all tools have; the new version.
NOT_METADATA = ("qualifiedName", "description", "tools", "iconUrl")
OBSOLETE = ("tool_count", "data_directions", "organization_status")
TOOL_MEMBERS = ("name", "description", "inputSchema", "outputSchema")
USE_FIELDS = ("useCount", "use_count")
SEED_VERSION = "1.1"
THEME_METADATA = ("qualifiedName", "homepage", "repository", "useCount", "verified")


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _items(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def _text(v: Column, member: str) -> Column:
    """A member's text, also of numbers; null for containers."""
    return F.try_variant_get(v, f"$.{member}", "string")


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).rlike(kind), F.lit(False))


def _objects(items: Column) -> Column:
    return F.filter(items, lambda v: _is(v, "^OBJECT"))


def _member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def snake(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"(?<!^)(?=[A-Z])", "_"))


def snake_members(v: Column, without: tuple[str, ...]) -> Column:
    """The members of a variant by their names in snake case; of names that become one the last stays."""
    entries = F.transform(F.filter(F.map_entries(_members(v)), lambda e: ~e["key"].isin(*without)), lambda e: F.struct(snake(e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])))


def id_name(name: Column) -> Column:
    """Letters and digits in lower case, all else one underscore between them."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, "[^0-9a-zA-Z]+", "_"), "^_+|_+$", ""))


def _properties(schema: Column) -> Column:
    return F.coalesce(F.when(_is(_member(schema, "properties"), "^OBJECT"), _member(schema, "properties")), F.parse_json(F.lit("{}")))


def _reference_tool(tool: Column) -> Column:
    return F.struct(_text(tool, "name").alias("name"), F.lit("function").alias("type"), _text(tool, "description").alias("description"), _properties(_member(tool, "inputSchema")).alias("input"), _properties(_member(tool, "outputSchema")).alias("output"))


def _by_use(tools: Column, field: str) -> tuple[Column, Column]:
    """Whether every tool has a sound number of uses, and the tools by it, most used first, equals in their order."""
    uses = F.transform(tools, lambda t: F.when(_is(_member(t, field), "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(t, f"$.{field}", "double")))
    sound = F.forall(uses, lambda u: F.coalesce((u >= 0) & (u < float("inf")), F.lit(False)))
    order = F.array_sort(F.transform(uses, lambda u, i: F.struct((-u).alias("u"), i.alias("i"))))
    return sound, F.transform(order, lambda x: F.get(tools, x["i"]))


def capped_tools(tools: Column, most: int) -> tuple[Column, Column]:
    """At most ``most`` tools and by which rule: all, the most used ones where all tell their use, else the first ones."""
    picked, rule = F.slice(tools, 1, most), F.lit("source_order")
    for field in reversed(USE_FIELDS):
        sound, ranked = _by_use(tools, field)
        picked, rule = F.when(sound, F.slice(ranked, 1, most)).otherwise(picked), F.when(sound, field).otherwise(rule)
    few = F.size(tools) <= most
    return F.when(few, tools).otherwise(picked), F.when(few, "all").otherwise(rule)


def seeds_of_entries(df: DataFrame, key: str, entry: str, index: str, source: str, site: str, most: int) -> DataFrame:
    """(key, reason, global_id, url, name, index, description, tools, metadata, received, invalid, removed, rule) of each entry.

    Tools need a name and a description that aren't blank; ``site`` is the address before the name. All columns but key
    and reason are null where there is a reason.
    """
    v = F.col(entry)
    name, description = F.trim(F.coalesce(_text(v, "qualifiedName"), F.lit(""))), F.trim(F.coalesce(_text(v, "description"), F.lit("")))
    reason = F.when(v.isNull(), "no document").when((name == "") | (description == ""), "no name or description").when(id_name(name) == "", "no id from the name")
    raw = _items(_member(v, "tools"))
    sound = F.filter(_objects(raw), lambda t: (F.trim(F.coalesce(_text(t, "name"), F.lit(""))) != "") & _is(_member(t, "description"), "^STRING") & (F.trim(_text(t, "description")) != ""))
    rows = df.select(key, reason.alias("reason"), name.alias("name"), description.alias("description"), F.col(index).alias("index"), v.alias("v"), F.size(raw).alias("received"), sound.alias("sound"))
    picked, rule = capped_tools(F.col("sound"), most)
    rows = rows.withColumns({"picked": picked, "rule": rule})
    made = {
        "global_id": F.concat_ws("_", F.lit(source), id_name(F.col("name")), F.col("index")),
        "url": F.array(F.concat(F.lit(site), F.col("name"))),
        "name": F.col("name"),
        "index": F.col("index"),
        "description": F.col("description"),
        "tools": F.transform("picked", _reference_tool),
        "metadata": snake_members(F.col("v"), NOT_METADATA),
        "received": F.col("received"),
        "invalid": F.col("received") - F.size("sound"),
        "removed": F.size("sound") - F.size("picked"),
        "rule": F.col("rule"),
    }
    return rows.select(key, "reason", *(F.when(F.col("reason").isNull(), c).alias(n) for n, c in made.items()))


def themes_of_entries(df: DataFrame, key: str, entry: str, site: str) -> DataFrame:
    """(key, label, url, description, operations, directions, metadata): operations are the names of an entry's tools, or those it
    lists where none has one; metadata members that are empty are left out. Entries without a name give no theme."""
    v = F.col(entry)
    name = _text(v, "qualifiedName")
    named = F.filter(F.transform(_objects(_items(_member(v, "tools"))), lambda t: _text(t, "name")), lambda n: F.coalesce(n != "", F.lit(False)))
    listed = F.transform(_items(_member(v, "toolNames")), lambda n: F.try_variant_get(n, "$", "string"))
    directions = F.filter(F.transform(_items(_member(v, "dataDirections")), lambda d: F.try_variant_get(d, "$", "string")), lambda d: F.coalesce(d != "", F.lit(False)))
    told = F.map_filter(_members(v), lambda k, x: k.isin(*THEME_METADATA) & ~F.is_variant_null(x) & (F.to_json(x) != '""'))
    label = F.coalesce(F.nullif(_text(v, "displayName"), F.lit("")), name)
    rows = df.where(name.isNotNull())
    return rows.select(key, label.alias("label"), F.concat(F.lit(site), name).alias("url"), F.coalesce(_text(v, "description"), F.lit("")).alias("description"), F.when(F.size(named) > 0, named).otherwise(listed).alias("operations"), directions.alias("directions"), told.alias("metadata"))


def migrated_seeds(df: DataFrame, key: str, seed: str) -> DataFrame:
    """(key, schema_version, url, tools, n_tools, others) of seeds of older versions.

    One address becomes a list; tools of the older form get fields for their schemas and keep what else they have, as
    members of ``rest``; tools of the newer form stay as they are; obsolete members of ``others`` go.
    """
    v = F.col(seed)
    url = _member(v, "environment.basic_info.url")
    urls = F.when(_is(url, "^ARRAY"), F.try_variant_get(url, "$", "array<string>")).otherwise(F.array(F.try_variant_get(url, "$", "string")))

    def tool(t: Column) -> Column:
        new = F.map_contains_key(_members(t), "input")
        own = lambda member, schema: F.when(new, _member(t, member)).otherwise(_properties(_member(t, schema)))
        known = F.when(new, F.array(*map(F.lit, ("name", "type", "description", "input", "output")))).otherwise(F.array(*map(F.lit, TOOL_MEMBERS)))
        rest = F.map_filter(_members(t), lambda k, _: ~F.array_contains(known, k))
        return F.struct(_text(t, "name").alias("name"), F.when(new, _text(t, "type")).otherwise("function").alias("type"), _text(t, "description").alias("description"), own("input", "inputSchema").alias("input"), own("output", "outputSchema").alias("output"), rest.alias("rest"))

    tools = F.transform(_objects(_items(_member(v, "init_ref_tools"))), tool)
    others = F.map_filter(F.coalesce(_members(_member(v, "others")), F.create_map().cast("map<string,variant>")), lambda k, _: ~k.isin(*OBSOLETE))
    return df.where(v.isNotNull()).select(key, F.lit(SEED_VERSION).alias("schema_version"), urls.alias("url"), tools.alias("tools"), F.size(tools).alias("n_tools"), others.alias("others"))


def seed_set_issues(seeds: DataFrame, key: str, source: str) -> DataFrame:
    """(key, issue, detail) over a set of seeds (key, global_id, name, index, tools, n_tools): ids and indexes that several
    seeds bear, ids that don't follow from name and index, tools that repeat in a seed, counts that aren't those of the tools.

    Sharing is found by an aggregate per id and per index, so no group of equal ids is gathered. Null ids and indexes
    are missing, not shared.
    """
    issue = lambda rows, name, detail: rows.select(key, F.lit(name).alias("issue"), detail.cast("string").alias("detail"))

    def shared(column: str) -> DataFrame:
        several = seeds.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("tw_n")).where("tw_n > 1")
        return issue(seeds.join(several, column), f"shared {column}", F.col(column))

    expected = F.concat_ws("_", F.lit(source), id_name(F.col("name")), F.col("index"))
    names = F.transform("tools", lambda t: t["name"])
    again = F.array_sort(F.array_distinct(F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1)))
    found = [shared("global_id"), shared("index"), issue(seeds.where(~F.col("global_id").eqNullSafe(expected)), "id does not follow", expected)]
    found += [issue(seeds.where(F.size(again) > 0), "repeated tools", F.array_join(again, ",")), issue(seeds.where(~F.col("n_tools").eqNullSafe(F.coalesce(F.size("tools"), F.lit(0)))), "wrong count", F.col("n_tools"))]
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out


def selected_seed(seeds: DataFrame, global_id: str) -> DataFrame:
    """The seed of an id; an error, when the result is read, if there is none or several."""
    rows = seeds.where(F.col("global_id") == global_id)
    n = rows.agg(F.count(F.lit(1)).alias("tw_n"))
    one = F.when(F.col("tw_n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.col("tw_n").cast("string"), F.lit(f" seeds of the id {global_id}"))))
    told = n.select(F.lit(global_id).alias("tw_id"), one.alias("tw_one"))
    return told.where("tw_one").join(rows, F.col("global_id") == F.col("tw_id"), "left").drop("tw_id", "tw_one")
