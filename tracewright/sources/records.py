"""Other sources: JSON documents, SQLite record sets, archives, Markdown tables, JUnit reports, embedded JSON, discovery.

Containers are read by Spark's binary source and opened in tasks, a file at a time: a file has to fit a task's memory, many
files spread over tasks. Functions over text take DataFrames, so any source of lines or paths will do.
"""

from __future__ import annotations

import gzip
import io
import sqlite3
import tarfile
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions.formats import safe_relative

MEMBERS = "path string, member string, bytes long, content binary"


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str, label: str) -> DataFrame:
    """(path, fields) of whole files that each hold one JSON object; anything else is an error that names the file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    object_ = F.trim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    checked = F.when(object_, F.col("value")).otherwise(F.raise_error(F.concat(F.lit(f"{label}: no JSON object in "), F.col("path"))))
    return files.select("path", F.from_json(checked, schema).alias("tw_row")).select("path", "tw_row.*")


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def sqlite_table(files: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Rows of one table of SQLite files (path, content), with declared types: booleans from 0 and 1, JSON text parsed.

    A value outside its declared type is an error, as a record set's declaration is closed.
    """
    plain = T.StructType([T.StructField("path", T.StringType()), *(f if isinstance(f.dataType, T.AtomicType) else T.StructField(f.name, T.StringType()) for f in schema.fields)])
    kinds = [(f.name, f.dataType.simpleString()) for f in schema.fields]

    def value(x, kind: str):
        if x is None or kind != "boolean":
            return x
        if x not in (0, 1):
            raise ValueError(f"{x!r} is no boolean")
        return bool(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(plain)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                db = sqlite3.connect(":memory:")
                db.deserialize(content.as_py())
                names = ", ".join('"' + name.replace('"', '""') + '"' for name, _ in kinds)
                rows = db.execute(f'SELECT {names} FROM "{table.replace(chr(34), chr(34) * 2)}" ORDER BY rowid')
                while part := rows.fetchmany(10_000):
                    columns = [[path] * len(part), *([value(r[k], kind) for r in part] for k, (_, kind) in enumerate(kinds))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)
                db.close()

    found = files.select("path", "content").mapInArrow(run, plain)
    nested = [f for f in schema.fields if not isinstance(f.dataType, T.AtomicType)]
    return found.withColumns({f.name: F.from_json(f.name, f.dataType) for f in nested})


def sqlite_catalog(files: DataFrame) -> DataFrame:
    """(path, kind, name, ddl, user_version, application_id, sha256) of the objects of SQLite files; the hash is of their
    definitions in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                db = sqlite3.connect(":memory:")
                db.deserialize(content.as_py())
                objects = db.execute("SELECT type, name, coalesce(sql, '') FROM sqlite_master ORDER BY type, name").fetchall()
                versions = [db.execute(f"PRAGMA {p}").fetchone()[0] for p in ("user_version", "application_id")]
                db.close()
                columns = list(zip(*objects, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(objects), pa.string()), *(pa.array(c, pa.string()) for c in columns), *(pa.array([v] * len(objects), pa.int64()) for v in versions)], names=["path", "kind", "name", "ddl", "user_version", "application_id"])

    rows = files.select("path", "content").mapInArrow(run, "path string, kind string, name string, ddl string, user_version long, application_id long")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("kind", "name", "ddl"))), lambda o: F.concat_ws("\x1f", o["kind"], o["name"], o["ddl"])), "\n")
    return rows.join(rows.groupBy("path").agg(F.sha2(text, 256).alias("sha256")), "path")


def _members(path: str, raw: bytes) -> Iterator[tuple[str, int, bool, object]]:
    """(name, size, is_link, reader) of the files of a ZIP, a TAR or one GZIP."""
    stream = io.BytesIO(raw)
    if zipfile.is_zipfile(stream):
        with zipfile.ZipFile(stream) as archive:
            for item in archive.infolist():
                if not item.is_dir():
                    yield item.filename, item.file_size, (item.external_attr >> 28) == 0xA, lambda item=item: archive.read(item)
        return
    stream.seek(0)
    try:
        with tarfile.open(fileobj=stream, mode="r:*") as archive:
            for item in archive:
                if item.isfile() or item.issym() or item.islnk():
                    yield item.name, item.size, not item.isfile(), lambda item=item: archive.extractfile(item).read()
        return
    except tarfile.ReadError:
        pass
    if raw[:2] != b"\x1f\x8b":
        raise ValueError(f"{path} is no ZIP, TAR or GZIP")
    name = PurePosixPath(path).name.removesuffix(".gz") or "content"
    content = gzip.decompress(raw)
    yield name, len(content), False, lambda: content


def archive_members(files: DataFrame, most_bytes: int) -> DataFrame:
    """(path, member, bytes, content) of the files in archives; links, unsafe names and archives of over ``most_bytes``
    unpacked are errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total = 0
                for name, size, is_link, read in _members(path, content.as_py()):
                    parts = PurePosixPath(name).parts
                    if is_link or name.startswith("/") or ".." in parts or "\\" in name:
                        raise ValueError(f"unsafe member {name!r} in {path}")
                    total += size
                    if total > most_bytes:
                        raise ValueError(f"{path} unpacks to over {most_bytes} bytes")
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([name]), pa.array([size], pa.int64()), pa.array([read()], pa.binary())], names=["path", "member", "bytes", "content"])

    return files.select("path", "content").mapInArrow(run, MEMBERS)


def markdown_rows(lines: DataFrame, document: str, line: str = "line", value: str = "value") -> DataFrame:
    """(document, line, heading, cells) of the body rows of Markdown tables.

    ``heading`` is the last heading above the row; an empty cell takes the value above it in the same table (merged cells).
    """
    order = Window.partitionBy(document).orderBy(line)
    text = F.trim(value)
    is_row = text.startswith("|") & text.endswith("|")
    rows = lines.select(document, line, text.alias("tw_text"), is_row.alias("tw_is_row"))
    heading = F.when(F.col("tw_text").rlike("^#{1,6} "), F.trim(F.regexp_replace("tw_text", "^#{1,6} ", "")))
    rows = rows.withColumn("heading", F.last(heading, ignorenulls=True).over(order)).withColumn("tw_table", F.count_if(~F.col("tw_is_row")).over(order))
    within = Window.partitionBy(document, "tw_table").orderBy(line)
    rows = rows.where("tw_is_row").withColumn("tw_k", F.row_number().over(within)).where("tw_k > 2")
    cells = F.transform(F.split(F.regexp_replace("tw_text", r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    flat = rows.select(document, line, "heading", "tw_table", F.posexplode(cells).alias("tw_at", "tw_cell"))
    column = Window.partitionBy(document, "tw_table", "tw_at").orderBy(line)
    filled = flat.withColumn("tw_cell", F.coalesce(F.last(F.nullif("tw_cell", F.lit("")), ignorenulls=True).over(column), F.lit("")))
    again = filled.groupBy(document, line).agg(F.first("heading").alias("heading"), F.array_sort(F.collect_list(F.struct("tw_at", "tw_cell"))).alias("tw_cells"))
    return again.select(document, line, "heading", F.transform("tw_cells", lambda c: c["tw_cell"]).alias("cells"))


def junit_cases(spark: SparkSession, path: str, most: int = 2000) -> DataFrame:
    """(path, suite, name, seconds, status, message) of the test cases of JUnit reports.

    A failure outranks an error, an error a skip; everything else has passed. Messages are cut to ``most`` characters.
    """
    outcome = "struct<_message: string, _VALUE: string>"
    cases = spark.read.format("xml").option("rowTag", "testcase").schema(f"_classname string, _name string, _time double, failure {outcome}, error {outcome}, skipped {outcome}").load(path)
    status = F.when(F.col("failure").isNotNull(), "failed").when(F.col("error").isNotNull(), "error").when(F.col("skipped").isNotNull(), "skipped").otherwise("passed")
    said = F.coalesce(*(F.coalesce(F.col(f"{c}._message"), F.col(f"{c}._VALUE")) for c in ("failure", "error", "skipped")))
    return cases.select(F.col("_metadata.file_path").alias("path"), F.col("_classname").alias("suite"), F.col("_name").alias("name"), F.col("_time").alias("seconds"), status.alias("status"), F.substring(said, 1, most).alias("message"))


def junit_runs(cases: DataFrame) -> DataFrame:
    """Per report: suites, cases and how they ended; a run fails if any case failed or had an error."""
    return cases.groupBy("path").agg(F.count_distinct("suite").alias("suites"), F.count("*").alias("cases"), *(F.count_if(F.col("status") == s).alias(s) for s in ("passed", "failed", "error", "skipped")), F.bool_or(F.col("status").isin("failed", "error")).alias("run_failed"))


def embedded_json(html: Column, element: str) -> Column:
    """The JSON text in a script element of an HTML page by its id, null where it is absent or no JSON."""
    found = F.regexp_extract(html, rf"""(?is)<script[^>]*\bid=["']{element}["'][^>]*>(.*?)</script>""", 1)
    return F.when(F.try_parse_json(found).isNotNull(), F.regexp_replace(found, r"^\s+|\s+$", ""))


def listing(resources: DataFrame, scope: str | None, query: str, limit: int, offset: int) -> DataFrame:
    """A page of resources (scope, path, ...) of a scope whose path holds the query, letter case aside."""
    rows = resources if scope is None else resources.where(F.col("scope") == scope)
    return rows.where(F.contains(F.lower("path"), F.lit(query.lower()))).orderBy("path", "scope").offset(offset).limit(limit)


def preview(content: Column, most: int) -> Column:
    """The text of the first ``most`` bytes, without a character that the cut splits."""
    cut = F.substring(content, 1, most)
    tail = F.hex(F.substring(cut, -3, 3))
    # bytes of a last character that is not whole: a lead of two, three or four with too few bytes behind it
    open_ = F.when(tail.rlike("[CDEF][0-9A-F]$"), 1).when(tail.rlike("[EF][0-9A-F][89AB][0-9A-F]$"), 2).when(tail.rlike("F[0-9A-F]([89AB][0-9A-F]){2}$"), 3).otherwise(0)
    kept = F.when(F.length(content) > most, F.length(cut) - open_).otherwise(F.length(cut))
    return F.decode(F.substring(cut, F.lit(1), kept), "UTF-8")


def verdict_paths(files: DataFrame) -> DataFrame:
    """(case, path, modified) of the latest verdict of each case, told from paths like .../verifiers/<case>/verdict.json.

    Of verdicts modified at the same time the one with the least path stays.
    """
    case = F.regexp_extract("path", r"/verifiers/([^/]+)/verdict\.json$", 1)
    rows = files.select(case.alias("case"), "path", "modified").where("case <> ''")
    place = F.row_number().over(Window.partitionBy("case").orderBy(F.desc("modified"), "path"))
    return rows.withColumn("tw_place", place).where("tw_place = 1").drop("tw_place")


def verified_passes(attempts: DataFrame, excluded: DataFrame) -> DataFrame:
    """Canonical passes of (case, canonical, label, outcome, ...) that are not excluded.

    Two of one case are an error, and so is one whose verdict isn't a pass, when the result is read.
    """
    rows = attempts.where("canonical AND label = 'verifier_pass'").join(excluded.select("case").distinct(), "case", "left_anti")
    counts = rows.groupBy("case").agg(F.count("*").alias("tw_n"))
    checked = rows.join(counts, "case").where(F.when(F.col("tw_n") > 1, F.raise_error(F.concat(F.lit("two passes of "), "case"))).when(~F.col("outcome").eqNullSafe("pass"), F.raise_error(F.concat(F.lit("no pass of "), "case"))).otherwise(F.lit(True)))
    return checked.drop("tw_n")


def delivery_index(paths: DataFrame, pattern: str) -> DataFrame:
    """(environment, paths): the deliveries of each environment, sorted; ``pattern`` captures the environment's name."""
    named = paths.select(F.regexp_extract("path", pattern, 1).alias("environment"), "path").where("environment <> ''")
    return named.groupBy("environment").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def latest_cases(runs: DataFrame) -> DataFrame:
    """(environment, run, task) of the tasks of each environment's latest complete run, by the runs' names."""
    latest = runs.where("complete").groupBy("environment").agg(F.max_by(F.struct("run", "tasks"), "run").alias("latest"))
    return latest.select("environment", "latest.run", F.explode("latest.tasks").alias("task"))


def newest_checkpoints(files: DataFrame, pattern: str) -> DataFrame:
    """(bundle, step, path) of each bundle's newest checkpoint; ``pattern`` captures the bundle and the step."""
    rows = files.select(F.regexp_extract("path", pattern, 1).alias("bundle"), F.regexp_extract("path", pattern, 2).try_cast("long").alias("step"), "path").where("bundle <> '' AND step IS NOT NULL")
    return rows.groupBy("bundle").agg(F.max("step").alias("step"), F.max_by("path", F.struct("step", "path")).alias("path"))


def wrapped_items(document: Column, names: tuple[str, ...]) -> Column:
    """The items of a JSON list, or of the first of these members that holds one, as an array of variants."""
    options = [F.try_variant_get(document, path, "array<variant>") for path in ("$", *(f"$.{n}" for n in names))]
    return F.coalesce(*options)


def unsafe_paths(files: DataFrame) -> DataFrame:
    return files.where(~safe_relative(F.col("path")))


def file_statistics(files: DataFrame) -> DataFrame:
    """(path, records) of files (path, content): lines of JSON lines and CSV (without its header), items of a JSON list or
    of the member that holds one, else 1."""
    text = F.decode("content", "UTF-8")
    lines = F.size(F.filter(F.split(text, "\r?\n"), lambda x: F.trim(x) != ""))
    items = F.size(wrapped_items(F.try_parse_json(text), ("records", "items", "data", "rows")))
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return files.select("path", F.when(suffix == "jsonl", lines).when(suffix == "csv", F.greatest(lines - 1, F.lit(0))).when((suffix == "json") & items.isNotNull(), items).otherwise(1).cast("long").alias("records"))


