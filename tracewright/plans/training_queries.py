"""Training records over conversations: rewrites, messages, annotations, prompts, integrity and window partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import assembly, training
from tracewright.session import table

_RULES = [("[0-9]+", "#"), ("[eé]r", "<er>"), ("src#", "web")]


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as trajectories: a step per assistant turn, with a call in every third, another in every sixth."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    call = "named_struct('id', concat('c', turn % {m}), 'name', concat('tool', turn % 3), 'arguments', named_struct('n', length(text)), 'output', substring(text, 1, {m}), 'is_error', turn % 2 = 0, 'started', turn)"
    calls = F.expr(f"CASE WHEN turn % 6 = 1 THEN array({call.format(m=5)}, {call.format(m=4)}) WHEN turn % 3 = 1 THEN array({call.format(m=5)}) ELSE array() END")
    step = F.struct("turn", F.expr("CASE WHEN turn % 5 = 3 THEN '' ELSE text END").alias("text"), calls.alias("calls"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("steps"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as messages: assistants call a tool each, users of even conversations are the tool that answers."""
    turns = table(spark, sf_dir, "conversations")
    role = "CASE WHEN role = 'user' AND conv_id % 2 = 0 AND turn > 0 THEN 'tool' ELSE role END"
    answers = "CASE WHEN role = 'user' AND conv_id % 2 = 0 AND turn > 0 THEN concat('c', (turn - 1 + conv_id % 3) % 7) END"
    calls = "CASE WHEN role = 'assistant' AND conv_id % 2 = 0 THEN array(named_struct('id', concat('c', turn % 7), 'name', concat('tool', turn % 4))) END"
    entry = F.struct("turn", F.expr(role).alias("role"), F.col("text").alias("content"), F.expr(answers).alias("tool_call_id"), F.expr(calls).alias("tool_calls"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("messages"))


def deep_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.struct(F.struct("source", "lang").alias("meta"), F.create_map(F.lit("text"), F.split("text", "\n")).alias("parts"), F.col("n_chars").alias("size")).alias("record"))
    found = training.with_rewritten(docs, ["record"], training.replacing(_RULES))
    text = F.concat_ws("|", "record.meta.source", "record.meta.lang", F.array_join(F.element_at("record.parts", "text"), "\n"), F.col("record.size").cast("string"))
    return found.select("doc_id", F.sha2(text, 256).alias("record_sha256"))


def audit_free_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _steps(spark, sf_dir)
    clean = training.without_fields(F.col("steps"), rows.schema["steps"].dataType, {"started", "output", "text"})
    return rows.select("conv_id", F.to_json(clean).alias("steps"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _steps(spark, sf_dir).select("conv_id", F.posexplode(training.step_messages(F.col("steps"))).alias("pos", "m"))
    arguments = F.array_join(F.transform("m.tool_calls", lambda c: F.concat_ws(":", c["id"], c["name"], c["arguments"])), " ")
    return rows.select("conv_id", "pos", "m.role", "m.content", "m.tool_call_id", arguments.alias("calls"))


def _kind(name: Column) -> Column:
    return F.when(name == "tool0", "native").otherwise("domain")


def annotated_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations of all calls, and of those whose message is in the first half of the conversation."""
    rows = _steps(spark, sf_dir).withColumn("annotations", training.call_annotations(F.col("steps"), _kind))
    half = training.step_messages(F.slice("steps", 1, F.ceil(F.size("steps") / 2).cast("int")))
    rows = rows.withColumn("kept", training.kept_annotations(F.col("annotations"), training.message_call_ids(half)))
    return rows.select("conv_id", "kept", F.explode("annotations").alias("call_id", "a")).select("conv_id", "call_id", "a.name", "a.kind", "a.is_error", F.map_contains_key("kept", F.col("call_id")).alias("in_window"))


def undefined_tool_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _steps(spark, sf_dir)
    called = F.transform(F.flatten(F.transform("steps", lambda s: s["calls"])), lambda c: c["name"])
    defined = F.when(F.expr("conv_id % 2 = 0"), F.array(F.lit("tool1"))).otherwise(F.array(F.lit("tool1"), F.lit("tool2")))
    return rows.select("conv_id", F.array_join(training.undefined_tools(called, defined), ",").alias("undefined"))


def task_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(spark, sf_dir).withColumn("original", F.get(F.filter("messages", lambda m: m["role"] == "user"), F.lit(0))["content"])
    prompt = F.when(F.expr("conv_id % 3 = 0"), F.col("original")).otherwise(F.concat(F.lit("Task: "), F.substring("original", 1, 20)))
    found = training.with_task_prompt(rows.withColumn("prompt", prompt), "messages", F.col("prompt"), F.col("original"))
    joined = F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    return found.select("conv_id", F.col("replacements").cast("long").alias("replacements"), "one_prompt", F.sha2(joined, 256).alias("messages_sha256"))


def system_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(spark, sf_dir)
    return rows.select("conv_id", training.system_root(F.col("messages"), "([A-Z][a-z]{6,}) ").alias("root"))


def message_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _messages(spark, sf_dir)
    defined = F.array(*(F.lit(f"tool{k}") for k in range(3)))
    found = (F.array_join(training.conversation_issues(F.col("messages"), defined, end), ",") for end in (False, True))
    return rows.select("conv_id", *(f.alias(n) for f, n in zip(found, ("issues", "issues_open_end"), strict=True)))


def cleaned_name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the part names of a brand stay apart when cut to a letter."""
    names = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set("p_name").alias("names"))
    short = F.transform("names", lambda n: F.regexp_extract(n, "^[a-z]+ ([a-z])", 1))
    return names.select("p_brand", F.size("names").cast("long").alias("n"), training.colliding(short).alias("collides"))


def window_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("turn").alias("item"))
    assigned = turns.where("NOT (conv_id % 5 = 1 AND turn = 2)").unionByName(turns.where("conv_id % 5 = 2 AND turn = 1"))
    return training.partition_issues(assigned, turns, ["conv_id"], "item", "turn")


def compaction_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").selectExpr("user_id", "event_type", "event_id", "row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS line")
    requests = lines.selectExpr("user_id", "line", "CASE WHEN event_type = 'error' THEN 'compaction' ELSE 'agent_step' END AS kind", "CASE WHEN event_id % 10 > 0 THEN event_id END AS request_id")
    compactions = lines.where("event_type = 'signup'").selectExpr("user_id", "line AS compaction", "CASE WHEN line % 7 > 0 THEN line + 3 END AS after_line")
    return training.pointed_requests(compactions, requests, ["user_id"]).select("user_id", "compaction", "after_line", "request_id", "reason")


def _base_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Joined rows and base records of conversations; every fourth environment was not delivered, some have no request."""
    turns = table(spark, sf_dir, "conversations")
    trajectories = _steps(spark, sf_dir).withColumns({"env": F.col("conv_id") % 4, "tools": F.array(F.lit("tool2"), F.lit("tool0")), "steps": F.transform("steps", lambda s: s.dropFields("turn"))})
    said = turns.where("role <> 'assistant'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))
    requests = said.where("conv_id % 7 > 0").select("conv_id", F.lit(1).alias("line"), F.transform("messages", lambda m: m.dropFields("turn")).alias("messages"), F.array(F.lit("tool0")).alias("defined"))
    requests = requests.unionByName(requests.where("conv_id % 2 = 0").withColumns({"line": F.lit(9), "messages": F.slice("messages", 1, 1)}))
    deliveries = turns.where("conv_id % 4 < 3").select((F.col("conv_id") % 4).alias("env"), F.concat(F.lit("v"), F.col("turn")).alias("path"), F.array(F.lit("tool0"), F.lit("tool2")).alias("delivered")).distinct()
    rows = assembly.joined(trajectories, requests, deliveries, "conv_id", "env")
    first = F.get(F.filter("messages", lambda m: m["role"] == "user"), F.lit(0))["content"]
    prompt = F.concat(F.lit("Task: "), first)
    names = F.create_map(F.lit("tool1"), F.when(F.col("conv_id") % 3 == 0, "tool0").otherwise("tool9"))
    return rows, assembly.base_records(rows, "conv_id", "steps", "messages", prompt, first, _kind, {"started"}, "no root (.)", names)


def training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole training records of conversations: cleaned, joined with requests and deliveries, annotated and flagged."""
    records = _base_records(spark, sf_dir)[1]
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), F.coalesce(m["content"], F.lit("")))), "\n")
    return records.select("conv_id", "path", F.size("messages").alias("n_messages"), F.size("annotations").alias("n_annotations"), F.array_join("flags", ",").alias("flags"), F.coalesce(F.try_element_at("scrubbed", F.lit("names")), F.lit(0).cast("long")).alias("renamed"), F.sha2(text, 256).alias("messages_sha256"))


def unassembled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembly.unassembled(_base_records(spark, sf_dir)[0], "conv_id")


def continuation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuation records of windows of two steps."""
    records = _base_records(spark, sf_dir)[1]
    windows = records.select("conv_id", F.explode(F.sequence(F.lit(0), F.floor(F.size("steps") / 2).cast("int"))).alias("window")).where("window > 0").select("conv_id", "window", (F.col("window") * 2 - 2).alias("first"), F.lit(2).alias("n"), F.concat(F.lit("part "), F.col("window")).alias("summary"))
    found = assembly.continuation_records(records, windows, "conv_id")
    return found.select("conv_id", "window", F.size("messages").alias("n_messages"), F.array_join(F.array_sort(F.map_keys("annotations")), ",").alias("call_ids"))


QUERIES = {f.__name__: f for f in (deep_rewrite, audit_free_steps, chat_messages, annotated_calls, undefined_tool_flags, task_prompts, system_roots, message_integrity, cleaned_name_collisions, window_partitions, compaction_targets, training_records, unassembled_records, continuation_windows)}


def _sql_replaced(col: str) -> str:
    for pattern, by in _RULES:
        col = f"regexp_replace({col}, '{pattern}', '{by}', 'g')"
    return col


_CALLS = """(SELECT conv_id, turn, k, 'c' || CASE k WHEN 0 THEN turn % 5 ELSE turn % 4 END AS id, 'tool' || turn % 3 AS name, length(text) AS n, substring(text, 1, CASE k WHEN 0 THEN 5 ELSE 4 END) AS output, turn % 2 = 0 AS is_error
  FROM conversations, (VALUES (0), (1)) AS each(k) WHERE role = 'assistant' AND turn % 3 = 1 AND (k = 0 OR turn % 6 = 1))"""
_ASSISTANTS = "(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS step, count(*) OVER (PARTITION BY conv_id) AS n_steps FROM conversations WHERE role = 'assistant')"
_ROLES = "(SELECT conv_id, turn, CASE WHEN role = 'user' AND conv_id % 2 = 0 AND turn > 0 THEN 'tool' ELSE role END AS role, text, max(turn) OVER (PARTITION BY conv_id) AS last_turn FROM conversations)"


def _integrity_sql(end: bool) -> str:
    last = " AND c.turn < c.last_turn" if end else ""
    return f"""(SELECT conv_id, array_to_string(list_filter([
      CASE WHEN (SELECT count(*) > count(DISTINCT id) FROM calls c WHERE c.conv_id = m.conv_id) THEN 'duplicate call' END,
      CASE WHEN (SELECT count(*) > count(DISTINCT id) FROM answers a WHERE a.conv_id = m.conv_id) THEN 'duplicate result' END,
      CASE WHEN NOT bool_or(role = 'assistant') THEN 'no assistant' END,
      CASE WHEN EXISTS (SELECT 1 FROM answers a WHERE a.conv_id = m.conv_id AND NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = a.conv_id AND c.id = a.id AND c.turn < a.turn)) THEN 'result before call' END,
      CASE WHEN EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = m.conv_id AND c.tool > 2) THEN 'undefined tool' END,
      CASE WHEN EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = m.conv_id{last} AND NOT EXISTS (SELECT 1 FROM answers a WHERE a.conv_id = c.conv_id AND a.id = c.id)) THEN 'unresolved' END
    ], lambda x: x IS NOT NULL), ',') AS issues FROM {_ROLES} m GROUP BY conv_id)"""


_ASSEMBLED = "conv_id % 7 > 0 AND conv_id % 4 < 3 AND conv_id IN (SELECT conv_id FROM conversations WHERE role <> 'assistant')"
_NUMBERED_CALLS = "(SELECT conv_id, turn, unnest(CASE WHEN turn % 6 = 1 THEN [5, 4] WHEN turn % 3 = 1 THEN [5] END) AS m, generate_subscripts(CASE WHEN turn % 6 = 1 THEN [5, 4] WHEN turn % 3 = 1 THEN [5] END, 1) AS k, text FROM conversations WHERE role = 'assistant')"
_NUMBERED_STEPS = "(SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, CASE WHEN turn % 5 = 3 THEN '' ELSE text END) - 1 AS step FROM conversations WHERE role = 'assistant')"
ORACLE_SQL = {
    "deep_rewrite": f"SELECT doc_id, sha256(concat_ws('|', {_sql_replaced('source')}, {_sql_replaced('lang')}, array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_sql_replaced('x')}), chr(10)), n_chars)) AS record_sha256 FROM documents",
    "audit_free_steps": f"""
        SELECT conv_id, '[' || string_agg('{{"turn":' || turn || ',"calls":[' || coalesce(calls, '') || ']}}', ',' ORDER BY turn) || ']' AS steps
        FROM {_ASSISTANTS} LEFT JOIN (SELECT conv_id, turn, string_agg('{{"id":"' || id || '","name":"' || name || '","arguments":{{"n":' || n || '}},"is_error":' || is_error || '}}', ',' ORDER BY k) AS calls FROM {_CALLS} GROUP BY ALL) USING (conv_id, turn) GROUP BY conv_id""",
    "chat_messages": f"""
        WITH said AS (SELECT conv_id, turn, -1 AS k, 'assistant' AS role, CASE WHEN turn % 5 = 3 OR text = '' THEN NULL ELSE text END AS content, NULL AS tool_call_id,
            coalesce((SELECT string_agg(id || ':' || name || ':{{"n":' || n || '}}', ' ' ORDER BY k) FROM {_CALLS} c WHERE c.conv_id = t.conv_id AND c.turn = t.turn), '') AS calls FROM conversations t WHERE role = 'assistant'
          UNION ALL SELECT conv_id, turn, k, 'tool', output, id, NULL FROM {_CALLS})
        SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) - 1 AS INT) AS pos, role, content, tool_call_id, calls FROM said""".replace("{{", "{").replace("}}", "}"),
    "annotated_calls": f"""
        WITH firsts AS (SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY turn, k) AS place FROM {_CALLS})
        SELECT conv_id, id AS call_id, name, CASE WHEN name = 'tool0' THEN 'native' ELSE 'domain' END AS kind, is_error,
          EXISTS (SELECT 1 FROM {_CALLS} c JOIN {_ASSISTANTS} s USING (conv_id, turn) WHERE c.conv_id = f.conv_id AND c.id = f.id AND s.step <= ceil(s.n_steps / 2)) AS in_window
        FROM firsts f WHERE place = 1""",
    "undefined_tool_flags": f"""
        SELECT conv_id, coalesce((SELECT string_agg(DISTINCT name, ',' ORDER BY name) FROM {_CALLS} c WHERE c.conv_id = t.conv_id AND name <> 'tool1' AND (name <> 'tool2' OR t.conv_id % 2 = 0)), '') AS undefined
        FROM (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant') t""",
    "task_prompts": f"""
        WITH firsts AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS original FROM {_ROLES} GROUP BY conv_id),
        prompted AS (SELECT *, CASE WHEN conv_id % 3 = 0 THEN original ELSE 'Task: ' || substring(original, 1, 20) END AS prompt FROM firsts),
        done AS (SELECT m.*, role = 'user' AND text = original AND text <> prompt AS changed, CASE WHEN role = 'user' AND text = original THEN prompt ELSE text END AS content, prompt FROM {_ROLES} m JOIN prompted USING (conv_id))
        SELECT conv_id, count(*) FILTER (changed) AS replacements, count(*) FILTER (role = 'user' AND content = prompt) = 1 AS one_prompt, sha256(string_agg(coalesce(content, ''), chr(10) ORDER BY turn)) AS messages_sha256 FROM done GROUP BY conv_id""",
    "system_roots": """
        SELECT conv_id, CASE WHEN len(found) = 1 THEN found[1] END AS root FROM (
          SELECT conv_id, list_distinct(flatten(list(regexp_extract_all(text, '([A-Z][a-z]{6,}) ', 1)) FILTER (role = 'system'))) AS found FROM conversations GROUP BY conv_id)""",
    "message_integrity": f"""
        WITH calls AS (SELECT conv_id, turn, last_turn, 'c' || turn % 7 AS id, turn % 4 AS tool FROM {_ROLES} WHERE role = 'assistant' AND conv_id % 2 = 0),
        answers AS (SELECT conv_id, turn, 'c' || (turn - 1 + conv_id % 3) % 7 AS id FROM {_ROLES} WHERE role = 'tool')
        SELECT a.conv_id, a.issues, b.issues AS issues_open_end FROM {_integrity_sql(False)} a JOIN {_integrity_sql(True)} b USING (conv_id)""",
    "cleaned_name_collisions": "SELECT p_brand, count(DISTINCT p_name) AS n, count(DISTINCT p_name) > count(DISTINCT regexp_extract(p_name, '^[a-z]+ ([a-z])', 1)) AS collides FROM part GROUP BY p_brand",
    "window_partitions": "SELECT conv_id, count(*) - count(*) FILTER (conv_id % 5 = 1 AND turn = 2) + count(*) FILTER (conv_id % 5 = 2 AND turn = 1) AS assigned, count(*) AS expected, NOT bool_or((conv_id % 5 = 1 AND turn = 2) OR (conv_id % 5 = 2 AND turn = 1)) AS partitioned FROM conversations GROUP BY conv_id",
    "compaction_targets": """
        WITH lines AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS line FROM events),
        pointed AS (SELECT user_id, line AS compaction, CASE WHEN line % 7 > 0 THEN line + 3 END AS after_line FROM lines WHERE event_type = 'signup')
        SELECT p.user_id, p.compaction, p.after_line, CASE WHEN l.event_type <> 'error' AND l.event_id % 10 > 0 THEN l.event_id END AS request_id,
          CASE WHEN l.event_id IS NULL THEN 'no such request' WHEN l.event_type = 'error' OR l.event_id % 10 = 0 THEN 'not an agent step' END AS reason
        FROM pointed p LEFT JOIN lines l ON l.user_id = p.user_id AND l.line = p.after_line""",
    "training_records": f"""
        WITH said AS (SELECT *, role = 'user' AND text = arg_min(text, turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS task FROM conversations),
        m AS (SELECT conv_id, 0 AS part, turn, 0 AS sub, role || ':' || CASE WHEN task THEN 'Task: ' || text ELSE text END AS line FROM said WHERE role <> 'assistant'
          UNION ALL SELECT conv_id, 1, turn, 0, 'assistant:' || CASE WHEN turn % 5 = 3 THEN '' ELSE text END FROM conversations WHERE role = 'assistant'
          UNION ALL SELECT conv_id, 1, turn, k, 'tool:' || substring(text, 1, m) FROM {_NUMBERED_CALLS}),
        c AS (SELECT conv_id, count(*) AS calls, count(DISTINCT 'c' || turn % m) AS ids FROM {_NUMBERED_CALLS} GROUP BY conv_id)
        SELECT m.conv_id, p.path, CAST(count(*) AS INT) AS n_messages, CAST(coalesce(max(c.ids), 0) AS INT) AS n_annotations, CASE WHEN max(c.calls) > 0 AND m.conv_id % 3 > 0 THEN 'undefined:tool9' ELSE '' END AS flags, coalesce(max(c.calls), 0) AS renamed,
          sha256(string_agg(line, chr(10) ORDER BY part, turn, sub)) AS messages_sha256
        FROM m LEFT JOIN c USING (conv_id) JOIN (SELECT conv_id % 4 AS env, min('v' || turn) AS path FROM conversations GROUP BY 1) p ON p.env = m.conv_id % 4
        WHERE {_ASSEMBLED} AND m.conv_id IN (SELECT conv_id FROM conversations WHERE role = 'assistant') GROUP BY m.conv_id, p.path""",
    "unassembled_records": "SELECT DISTINCT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'no request' ELSE 'no delivery with these tools' END AS reason FROM conversations WHERE role = 'assistant' AND (conv_id % 7 = 0 OR conv_id % 4 = 3)",
    "continuation_windows": f"""
        SELECT s.conv_id, CAST(s.step // 2 + 1 AS INT) AS "window", CAST(1 + count(DISTINCT s.step) + count(c.k) AS INT) AS n_messages, coalesce(string_agg(DISTINCT 'c' || c.turn % c.m, ',' ORDER BY 'c' || c.turn % c.m), '') AS call_ids
        FROM {_NUMBERED_STEPS} s LEFT JOIN {_NUMBERED_CALLS} c USING (conv_id, turn) WHERE {_ASSEMBLED} GROUP BY s.conv_id, s.step // 2 HAVING count(DISTINCT s.step) = 2""",
}
