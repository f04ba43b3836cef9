"""Semantic checks of declared environments and of rubric packages: what a schema of their form can't tell.

A declaration is a row with nested values, and its checks are Columns over them: no shuffle, no Python. Issues are rows
(key, code, path, detail), path a JSON pointer; a declaration without issues gives none. Null lists and maps are empty, null
ids are ids of their own and never known; equal declarations give equal issues, so keys should be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.issues import at_path, bad_value, found, holds, issue, listed, of_each, repeated, texts

FIELD = "struct<type:string,nullable:boolean,scope:string>"
RECORD_SETS = f"array<struct<id:string,fields:map<string,{FIELD}>,key_fields:array<string>>>"
END = "struct<record_set:string,fields:array<string>>"
RELATIONSHIPS = f"array<struct<id:string,left:{END},right:{END}>>"
#: Names that no record set or scope may bear, a prefix likewise, types of single values.
RESERVED_IDS, RESERVED_PREFIX = ("raw", "derived", "output", "temp", "misc"), "sqlite_"
SCALARS = ("string", "integer", "number", "boolean")


def environment_issues(df: DataFrame, key: str, record_sets: str, scopes: str, relationships: str) -> DataFrame:
    """Repeated and reserved ids; keys that are no fields or not plain values that are always there; fields of unknown scopes;
    relationship ends of unknown record sets, without fields, with fields that aren't plain values, of unequal lengths."""
    sets, files, links = listed(F.col(record_sets), RECORD_SETS), texts(F.col(scopes)), listed(F.col(relationships), RELATIONSHIPS)
    ids = {record_sets: F.transform(sets, lambda s: s["id"]), scopes: files, relationships: F.transform(links, lambda r: r["id"])}
    every_issue = [found(F.size(repeated(v)) > 0, issue("duplicate_id", at_path(f"/{c}"), F.array_join(repeated(v), ",", "null"))) for c, v in ids.items()]
    reserved = lambda v: v.isin(*RESERVED_IDS) | v.startswith(RESERVED_PREFIX)
    every_issue += [of_each(ids[c], bad_value(reserved, "reserved_id", c)) for c in (record_sets, scopes)]

    def of_set(s: Column, i: Column) -> Column:
        entries = F.array_sort(F.coalesce(F.map_entries(s["fields"]), F.array().cast(f"array<struct<key:string,value:{FIELD}>>")))
        strays = of_each(entries, lambda e, _: found(e["value"]["scope"].isNotNull() & ~holds(files, e["value"]["scope"]), issue("unknown_scope", at_path(f"/{record_sets}/", i, "/fields/", e["key"]), e["value"]["scope"])))

        def of_key(name: Column, _: Column) -> Column:
            field, at = F.try_element_at(s["fields"], name), at_path(f"/{record_sets}/", i, "/key_fields")
            plain = F.coalesce(field["type"].isin(*SCALARS), F.lit(False)) & field["nullable"].eqNullSafe(False)
            return F.concat(found(field.isNull(), issue("unknown_key_field", at, name)), found(field.isNotNull() & ~plain, issue("invalid_key_field", at, name)))

        return F.concat(strays, of_each(texts(s["key_fields"]), of_key))

    by_id = F.map_from_entries(F.transform(F.filter(sets, lambda s, i: s["id"].isNotNull() & (F.array_position(F.transform(sets, lambda t: t["id"]), s["id"]) == i + 1)), lambda s: F.struct(s["id"], s["fields"])))

    def of_link(r: Column, i: Column) -> Column:
        def of_end(side: str) -> Column:
            end, at = r[side], at_path(f"/{relationships}/", i, f"/{side}")
            there = F.coalesce(F.map_contains_key(by_id, end["record_set"]), F.lit(False))
            fields = F.try_element_at(by_id, end["record_set"])
            plain = lambda name: F.coalesce(F.try_element_at(fields, name)["type"].isin(*SCALARS), F.lit(False))
            names = texts(end["fields"])
            inner = F.concat(found(F.size(names) == 0, issue("empty_end", at, end["record_set"])), of_each(names, lambda name, _: found(~plain(name), issue("invalid_end_field", at, name))))
            return F.when(end.isNull(), F.array().cast("array<struct<code:string,path:string,detail:string>>")).when(~there, F.array(issue("unknown_record_set", at, end["record_set"]))).otherwise(inner)

        n = [F.size(texts(r[side]["fields"])) for side in ("left", "right")]
        uneven = found(r["left"].isNotNull() & r["right"].isNotNull() & (n[0] != n[1]), issue("unequal_ends", at_path(f"/{relationships}/", i), F.concat_ws(":", *(x.cast("string") for x in n))))
        return F.concat(of_end("left"), of_end("right"), uneven)

    every = F.concat(*every_issue, of_each(sets, of_set), of_each(links, of_link))
    return df.select(key, F.explode(every).alias("issue")).select(key, "issue.*")


RUBRICS = "array<struct<id:string,weight:double,scale:string,criteria:map<string,string>,quotes:array<string>,tools:array<string>,required:array<string>>>"
TOOLS = "array<struct<id:string,rubrics:array<string>>>"
COVERAGE = "array<struct<quote:string,rubrics:array<string>>>"
#: How many levels each scale has.
LEVELS = {"binary": 2, "ordinal_5": 6}
_IDENTIFIER = r"^[\p{L}_][\p{L}\p{N}_]*$"


def package_issues(df: DataFrame, key: str, rubrics: str, tools: str, coverage: str, task: str) -> DataFrame:
    """Ids that repeat or are no identifiers; weights that aren't positive and finite; scales; levels without a criterion; quotes
    that the task doesn't hold (a null task: any may be right); tools and rubrics that are unknown or know each other one
    way only; required tools that aren't declared; requirements without known rubrics; rubrics that no requirement covers."""
    # lists that the checks of every rubric, tool and requirement look at are columns, so they are made once a row
    df = df.select(key, task, listed(F.col(rubrics), RUBRICS).alias("tw_rows"), listed(F.col(tools), TOOLS).alias("tw_helpers"), listed(F.col(coverage), COVERAGE).alias("tw_wanted"))
    df = df.select("*", F.transform("tw_rows", lambda r: r["id"]).alias("tw_ids"), F.transform("tw_helpers", lambda t: t["id"]).alias("tw_tool_ids"))
    rows, helpers, wanted, ids, tool_ids = (F.col(f"tw_{c}") for c in ("rows", "helpers", "wanted", "ids", "tool_ids"))
    minus = lambda a, b: F.array_join(F.array_sort(F.array_except(a, b)), ",", "null")
    unquoted = lambda q: (F.trim(F.coalesce(q, F.lit(""))) == "") | F.coalesce(~F.contains(F.col(task), q), F.lit(False))
    blank = lambda v: F.coalesce(v, F.lit("")) == ""
    every_issue = [found(F.size(v) == 0, issue("nothing", at_path(f"/{c}"), F.lit(""))) for c, v in ((rubrics, rows), (coverage, wanted))]
    every_issue += [found(F.size(repeated(v)) > 0, issue("duplicate_id", at_path(f"/{c}"), F.array_join(repeated(v), ",", "null"))) for c, v in ((rubrics, ids), (tools, tool_ids))]
    every_issue += [of_each(v, bad_value(lambda x: ~F.coalesce(x.rlike(_IDENTIFIER), F.lit(False)), "invalid_id", c)) for c, v in ((rubrics, ids), (tools, tool_ids))]

    def of_rubric(r: Column, i: Column) -> Column:
        at = lambda member: at_path(f"/{rubrics}/", i, f"/{member}")
        sound = (r["weight"] > 0) & (r["weight"] < float("inf"))
        levels = F.coalesce(*(F.when(r["scale"] == s, F.array(*(F.lit(str(k)) for k in range(n)))) for s, n in LEVELS.items()), F.array().cast("array<string>"))
        empty = F.filter(levels, lambda k: blank(F.try_element_at(r["criteria"], k)))
        quotes, used = texts(r["quotes"]), texts(r["tools"])
        silent = F.transform(F.filter(helpers, lambda t: holds(used, t["id"]) & ~holds(texts(t["rubrics"]), r["id"])), lambda t: t["id"])
        return F.concat(
            found(~F.coalesce(sound, F.lit(False)), issue("invalid_weight", at("weight"), r["weight"].cast("string"))),
            found(~F.coalesce(r["scale"].isin(*LEVELS), F.lit(False)), issue("invalid_scale", at("scale"), r["scale"])),
            found(F.size(empty) > 0, issue("missing_criteria", at("criteria"), F.array_join(empty, ","))),
            found((F.size(quotes) == 0) | F.exists(quotes, unquoted), issue("invalid_quote", at("quotes"), F.array_join(F.filter(quotes, unquoted), ",", "null"))),
            found(F.size(F.array_except(used, tool_ids)) > 0, issue("unknown_tool", at("tools"), minus(used, tool_ids))),
            found(F.size(F.array_except(texts(r["required"]), used)) > 0, issue("undeclared_tool", at("required"), minus(texts(r["required"]), used))),
            found(F.size(silent) > 0, issue("one_way", at("tools"), F.array_join(F.array_sort(silent), ","))),
        )

    def of_tool(t: Column, i: Column) -> Column:
        own, at = texts(t["rubrics"]), at_path(f"/{tools}/", i, "/rubrics")
        silent = F.transform(F.filter(rows, lambda r: holds(own, r["id"]) & ~holds(texts(r["tools"]), t["id"])), lambda r: r["id"])
        return F.concat(found((F.size(own) == 0) | (F.size(F.array_except(own, ids)) > 0), issue("unknown_rubric", at, minus(own, ids))), found(F.size(silent) > 0, issue("one_way", at, F.array_join(F.array_sort(silent), ","))))

    def of_requirement(c: Column, i: Column) -> Column:
        refs = texts(c["rubrics"])
        return F.concat(
            found(unquoted(c["quote"]), issue("invalid_quote", at_path(f"/{coverage}/", i, "/quote"), c["quote"])),
            found((F.size(refs) == 0) | (F.size(F.array_except(refs, ids)) > 0), issue("unknown_rubric", at_path(f"/{coverage}/", i, "/rubrics"), minus(refs, ids))),
        )

    covered = F.flatten(F.transform(wanted, lambda c: texts(c["rubrics"])))
    bare = found(F.size(F.array_except(ids, covered)) > 0, issue("uncovered", at_path(f"/{coverage}"), minus(ids, covered)))
    every = F.concat(*every_issue, of_each(rows, of_rubric), of_each(helpers, of_tool), of_each(wanted, of_requirement), bare)
    return df.select(key, F.explode(every).alias("issue")).select(key, "issue.*")
