"""Queries over profiles of support, tiered choices and dialogue corpora, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import profiles, tiers
from tracewright.session import table
from tracewright.sources import dialogues


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as subjects, lines as cards of evidence."""
    parts, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    subject = lambda c: (F.concat(F.lit("t"), F.col(c) % 3).alias("subject_type"), F.col(c).cast("string").alias("subject_name"))
    origins = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "seed"), F.when(F.col("p_size") % 3 < 2, "scenario")))
    universe = parts.select(*subject("p_partkey"), origins.alias("origins"))
    status = F.when(F.col("l_quantity") > 49, "supported").when(F.col("l_quantity") > 44, "partial").when(F.col("l_quantity") > 3, "missing").otherwise("odd")
    path = F.format_string("%012d/%d", "l_orderkey", "l_linenumber")
    cards = lines.select(*subject("l_partkey"), status.alias("status"), F.when(F.col("l_linestatus") == "O", "semantic_evidence").otherwise("record").alias("role"), path.alias("path"), F.concat_ws(":", "l_returnflag", "l_suppkey").alias("reason"))
    free = parts.where("p_size = 7").select(*subject("p_partkey"), F.col("p_name").alias("reason"))
    return profiles.subject_coverage(universe, cards, free)


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as works, their customers' balances as what supports them."""
    nations = table(spark, sf_dir, "nation")
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9500").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    work = rich.select(F.col("n_name").alias("task_name"), F.when(F.col("c_acctbal") > 9950, "supported").otherwise("partial").alias("status"), F.col("c_mktsegment").alias("reason"))
    return profiles.work_status(nations.select(F.concat(F.lit(" "), "n_name").alias("task_name")), work)


def subject_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subject's support and the card that tells it."""
    return _coverage(spark, sf_dir).withColumn("origins", F.array_join("origins", ","))


def profile_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.measures(_coverage(spark, sf_dir))


def work_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.work_measure(_work(spark, sf_dir))


def profile_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.gaps(_coverage(spark, sf_dir), _work(spark, sf_dir))


COUNT, PENALTY = 4, 0.5


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chains of the size classes of their parts."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 12).cast("string").alias("tool"))
    lines = table(spark, sf_dir, "lineitem").join(parts, "l_partkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "tool"))).alias("at"), F.sum(F.col("l_quantity").cast("long")).alias("score"))
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("c_nationkey", "o_orderkey", F.col("at.tool").alias("chain"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), "score")


def tiered_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's best chains, tier by tier, unlike each other."""
    chosen = tiers.tiered_selection(_chains(spark, sf_dir), "c_nationkey", "o_orderkey", "chain", "tier", "score", COUNT, PENALTY)
    return chosen.withColumn("value", F.round("value", 9))


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in the form of a dialogue corpus: a frame per turn, whose parts hang on the length of its text."""
    rows = table(spark, sf_dir, "conversations").withColumn("n", F.length(F.coalesce("text", F.lit(""))))
    frame = """named_struct(
        'service', element_at(array('Trains_1', 'Hotels_2', 'Weather_1'), n % 3 + 1),
        'state', named_struct('active_intent', CASE n % 4 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Find' WHEN 2 THEN 'Book' END, 'requested_slots', CASE n % 5 WHEN 0 THEN array('time') WHEN 1 THEN array('time', 'price') END),
        'service_call', CASE WHEN role = 'assistant' AND n % 2 = 0 THEN named_struct('method', 'Get', 'parameters', map('n', string(n))) END,
        'service_results', CASE WHEN n % 7 = 0 THEN array() WHEN n % 7 > 1 THEN array(map('a', '1'), map('a', '2')) END,
        'actions', CASE WHEN n % 6 = 0 THEN array(named_struct('act', 'INFORM'), named_struct('act', 'NOTIFY_SUCCESS')) END)"""
    turn = F.struct("turn", "role", "text", F.struct(F.upper("role").alias("speaker"), F.col("text").alias("utterance"), F.expr(f"CASE WHEN n % 11 > 0 THEN array({frame}) END").alias("frames")).alias("t"))
    turns = rows.groupBy(F.col("conv_id").alias("dialogue_id")).agg(F.collect_list(turn).alias("every"))
    by = F.array_sort(F.transform("every", lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text"), x["t"]["utterance"].alias("utterance"), x["t"]["speaker"].alias("speaker"), x["t"]["frames"].alias("frames"))), lambda a, b: F.when(a["turn"] < b["turn"], -1).when(a["turn"] > b["turn"], 1).when(a["role"] < b["role"], -1).when(a["role"] > b["role"], 1).when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0))
    return turns.select("dialogue_id", F.transform(by, lambda x: F.struct(x["speaker"].alias("speaker"), x["utterance"].alias("utterance"), x["frames"].alias("frames"))).alias("turns"))


def dialogue_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each dialogue asks for and whether its calls can be verified."""
    tasks = dialogues.dialogue_tasks(_dialogues(spark, sf_dir))
    return tasks.select("dialogue_id", F.array_join("intents", ",").alias("intents"), F.array_join("requested_slots", ",").alias("slots"), "n_turns", "n_user_turns", F.size("calls").alias("n_calls"), "successes", "verifiable", F.md5(F.array_join("utterances", "\n")).alias("utterances"))


def dialogue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.corpus_summary(dialogues.dialogue_tasks(_dialogues(spark, sf_dir)))


def dialogue_intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.intent_dialogues(dialogues.dialogue_tasks(_dialogues(spark, sf_dir)))


def dialogue_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six examples: one of several calls, one that asks for prices, one without calls, then the first of the others."""
    tasks = dialogues.dialogue_tasks(_dialogues(spark, sf_dir))
    wanted = [(F.size("calls") >= 2) & F.col("verifiable"), F.array_contains("requested_slots", "price"), F.size("calls") == 0]
    return tiers.first_of_each(tasks.withColumn("at", F.col("dialogue_id")), "dialogue_id", "at", wanted, 6).drop("at")


QUERIES = {f.__name__: f for f in (subject_profile, profile_measures, work_profile, profile_gaps, tiered_chains, dialogue_tasks, dialogue_summary, dialogue_intents, dialogue_examples)}

_CARDS = """(SELECT l_partkey AS k, CASE WHEN l_quantity > 49 THEN 'supported' WHEN l_quantity > 44 THEN 'partial' ELSE 'missing' END AS status, printf('%012d/%d', l_orderkey, l_linenumber) AS path, l_returnflag || ':' || l_suppkey AS reason
    FROM lineitem WHERE l_linestatus <> 'O' QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN l_quantity > 49 THEN 3 WHEN l_quantity > 44 THEN 2 ELSE 1 END DESC, path DESC, reason DESC) = 1)"""
_SUBJECTS = f"""(SELECT 't' || p_partkey % 3 AS subject_type, CAST(p_partkey AS VARCHAR) AS subject_name, list_filter([CASE WHEN p_size % 2 = 0 THEN 'seed' END, CASE WHEN p_size % 3 < 2 THEN 'scenario' END], lambda x: x IS NOT NULL) AS origins,
    CASE WHEN p_size = 7 THEN 'not_required' ELSE coalesce(status, 'missing') END AS status, CASE WHEN k IS NULL THEN 'none' ELSE 'record' END AS basis, path, CASE WHEN p_size = 7 THEN p_name ELSE reason END AS reason FROM part LEFT JOIN {_CARDS} ON k = p_partkey)"""
_WORKS = """(SELECT n_name, CASE WHEN max(c_acctbal) > 9950 THEN 'supported' WHEN max(c_acctbal) > 9500 THEN 'partial' ELSE 'missing' END AS status,
    CASE WHEN max(c_acctbal) > 9950 THEN max(c_mktsegment) FILTER (c_acctbal > 9950) ELSE max(c_mktsegment) FILTER (c_acctbal > 9500) END AS reason FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name)"""
_MEASURED = "count(*) FILTER (status = 'supported') AS supported, count(*) FILTER (status <> 'not_required') AS total, count(*) FILTER (status = 'not_required') AS not_required, count(*) AS listed, coalesce(100.0::DOUBLE * count(*) FILTER (status = 'supported') / nullif(count(*) FILTER (status <> 'not_required'), 0), 100) AS percent"
_TURNS = """(SELECT conv_id, role, text, length(coalesce(text, '')) AS n, length(coalesce(text, '')) % 11 > 0 AS framed, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS o FROM conversations)"""
_CALLED = "framed AND role = 'assistant' AND n % 2 = 0"
_TASKS = f"""(SELECT conv_id AS dialogue_id,
    array_to_string(list_sort(coalesce(list(DISTINCT CASE n % 4 WHEN 1 THEN 'Find' WHEN 2 THEN 'Book' END) FILTER (framed AND n % 4 IN (1, 2)), [])), ',') AS intents,
    CASE WHEN bool_or(framed AND n % 5 = 1) THEN 'price,time' WHEN bool_or(framed AND n % 5 = 0) THEN 'time' ELSE '' END AS slots,
    CAST(count(*) AS INT) AS n_turns, CAST(count(*) FILTER (role = 'user') AS INT) AS n_user_turns, CAST(count(*) FILTER ({_CALLED}) AS INT) AS n_calls, CAST(count(*) FILTER (framed AND n % 6 = 0) AS INT) AS successes,
    count(*) FILTER ({_CALLED}) > 0 AND count(*) FILTER ({_CALLED} AND n % 7 < 2) = 0 AS verifiable, md5(coalesce(string_agg(coalesce(text, ''), chr(10) ORDER BY o) FILTER (role = 'user'), '')) AS utterances FROM {_TURNS} GROUP BY conv_id)"""
ORACLE_SQL = {
    "subject_profile": f"SELECT * REPLACE (array_to_string(origins, ',') AS origins) FROM {_SUBJECTS}",
    "profile_measures": f"SELECT origin, subject_type, {_MEASURED} FROM (SELECT unnest(origins) AS origin, * FROM {_SUBJECTS}) GROUP BY GROUPING SETS ((origin, subject_type), (origin))",
    "work_profile": f"SELECT count(*) FILTER (status = 'supported') AS supported, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'missing') AS missing, count(*) AS total, 100.0::DOUBLE * count(*) FILTER (status = 'supported') / count(*) AS percent FROM {_WORKS}",
    "profile_gaps": f"SELECT subject_type, subject_name, status, reason FROM {_SUBJECTS} WHERE status IN ('missing', 'partial') UNION ALL SELECT 'work', n_name, status, reason FROM {_WORKS} WHERE status <> 'supported'",
    "tiered_chains": f"""
        WITH RECURSIVE lines AS (SELECT l_orderkey, list(CAST(p_size % 12 AS VARCHAR) ORDER BY l_linenumber, CAST(p_size % 12 AS VARCHAR)) AS chain, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS score FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
        cand AS (SELECT c_nationkey AS g, o_orderkey AS k, chain, CAST(left(o_orderpriority, 1) AS INT) AS tier, score, list_distinct(list_transform(range(1, len(chain)), lambda i: chain[i] || '>' || chain[i + 1])) AS steps FROM orders JOIN customer ON o_custkey = c_custkey JOIN lines ON l_orderkey = o_orderkey),
        scaled AS (SELECT *, score / max(score) OVER (PARTITION BY g, tier) AS share FROM cand),
        pick AS (
            SELECT 0 AS place, g, CAST(NULL AS BIGINT) AS k, CAST(0 AS DOUBLE) AS value, CAST([] AS BIGINT[]) AS ks, CAST([] AS VARCHAR[][]) AS used FROM (SELECT DISTINCT g FROM cand)
            UNION ALL
            SELECT place, g, k, value, list_append(ks, k), list_append(used, steps) FROM (
                SELECT p.place + 1 AS place, g, s.k, s.steps, p.ks, p.used, s.tier, s.score, s.chain,
                    s.share - {PENALTY} * coalesce(list_max(list_transform(p.used, lambda u: CASE WHEN least(len(u), len(s.steps)) = 0 THEN 0 ELSE len(list_intersect(u, s.steps)) / least(len(u), len(s.steps)) END)), 0) AS value
                FROM pick p JOIN scaled s USING (g) WHERE p.place < {COUNT} AND NOT list_contains(p.ks, s.k))
            QUALIFY row_number() OVER (PARTITION BY g ORDER BY tier DESC, value DESC, score DESC, len(chain) DESC, chain DESC, k) = 1)
        SELECT g AS c_nationkey, k AS o_orderkey, place, round(value, 9) AS value FROM pick WHERE place > 0""",
    "dialogue_tasks": f"FROM {_TASKS}",
    "dialogue_summary": f"""
        SELECT count(*) AS dialogues, CAST(sum(n_turns) AS BIGINT) AS turns, CAST(sum(n_calls) AS BIGINT) AS calls, (SELECT count(*) FROM {_TURNS} WHERE {_CALLED} AND n % 7 > 1) AS calls_with_results, CAST(sum(successes) AS BIGINT) AS successes, count(*) FILTER (verifiable) AS verifiable,
            (SELECT count(*) FROM {_TURNS} WHERE {_CALLED} AND n % 7 > 1) / sum(n_calls) AS result_rate, count(*) FILTER (verifiable) / count(*) AS verifiable_rate FROM {_TASKS}""",
    "dialogue_intents": f"SELECT ['Trains_1', 'Hotels_2', 'Weather_1'][n % 3 + 1] AS service, CASE n % 4 WHEN 1 THEN 'Find' ELSE 'Book' END AS intent, count(DISTINCT conv_id) AS dialogues FROM {_TURNS} WHERE framed AND n % 4 IN (1, 2) GROUP BY ALL",
    "dialogue_examples": f"""
        WITH t AS (FROM {_TASKS}), a AS (SELECT min(dialogue_id) AS d FROM t WHERE n_calls >= 2 AND verifiable), b AS (SELECT min(dialogue_id) AS d FROM t WHERE slots = 'price,time' AND dialogue_id NOT IN (FROM a WHERE d IS NOT NULL)),
        c AS (SELECT min(dialogue_id) AS d FROM t WHERE n_calls = 0 AND dialogue_id NOT IN (SELECT d FROM a WHERE d IS NOT NULL UNION ALL SELECT d FROM b WHERE d IS NOT NULL)),
        chosen AS (SELECT d, 0 AS wanted FROM a UNION ALL SELECT d, 1 FROM b UNION ALL SELECT d, 2 FROM c),
        every AS (SELECT d, wanted FROM chosen WHERE d IS NOT NULL UNION ALL SELECT dialogue_id, NULL FROM t WHERE dialogue_id NOT IN (SELECT d FROM chosen WHERE d IS NOT NULL))
        SELECT d AS dialogue_id, CAST(row_number() OVER (ORDER BY wanted NULLS LAST, d) AS INT) AS place, wanted FROM every QUALIFY place <= 6""",
}
