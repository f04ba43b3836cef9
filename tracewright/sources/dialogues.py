"""Dialogue corpora in shards: arrays of dialogues, each with turns, frames, calls and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = "struct<service:string,state:struct<active_intent:string,requested_slots:array<string>>,service_call:struct<method:string,parameters:map<string,string>>,service_results:array<map<string,string>>,actions:array<struct<act:string>>>"
TURNS = f"array<struct<speaker:string,utterance:string,frames:array<{FRAME}>>>"
DIALOGUE = f"struct<dialogue_id:string,services:array<string>,turns:{TURNS}>"
#: No intent, the speaker who asks, the act that reports success.
NO_INTENT, USER, SUCCESS = "NONE", "USER", "NOTIFY_SUCCESS"


def read_dialogues(spark: SparkSession, root: str) -> DataFrame:
    """(split, path, place, dialogue_id, services, turns) of ``root/<split>/dialogues_*.json``.

    A shard is one task and is some megabytes by its format; one that isn't an array of objects is an error.
    """
    files = spark.read.text(f"{root.rstrip('/')}/*/dialogues_*.json", wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    parsed = F.from_json("value", f"array<{DIALOGUE}>", {"mode": "FAILFAST"})
    sound = F.when(F.ltrim("value").startswith("["), parsed).otherwise(F.raise_error(F.concat(F.lit("not a list of dialogues: "), F.col("path"))))
    rows = files.select(F.element_at(F.split("path", "/"), -2).alias("split"), "path", F.posexplode(sound).alias("place", "d"))
    return rows.select("split", "path", "place", "d.*")


def _all(value: Column, empty_as: str) -> Column:
    return F.coalesce(value, F.array().cast(empty_as))


def _frames() -> Column:
    return F.flatten(F.transform(_all(F.col("turns"), TURNS), lambda t: _all(t["frames"], f"array<{FRAME}>")))


def frame_rows(dialogues: DataFrame, keys: list[str]) -> DataFrame:
    """A row per frame: keys, turn and frame numbers from 0, speaker, frame; turns without frames give none."""
    turns = dialogues.select(*keys, F.posexplode("turns").alias("turn", "t"))
    return turns.select(*keys, "turn", F.col("t.speaker").alias("speaker"), F.posexplode("t.frames").alias("frame_no", "frame"))


def dialogue_tasks(dialogues: DataFrame) -> DataFrame:
    """A row per dialogue, without a shuffle: intents and slots asked for (sorted, once each), calls, whether they can be verified.

    Adds intents, pairs (service and intent), n_turns, n_user_turns, requested_slots, calls, verifiable (it has calls and all
    have results), successes and utterances; other columns stay. Null lists are empty.
    """
    frames = dialogues.withColumn("tw_frames", _frames())
    active = lambda f: (f["state"]["active_intent"] != NO_INTENT) & (f["state"]["active_intent"] != "")
    held = F.filter("tw_frames", lambda f: F.coalesce(active(f), F.lit(False)))
    pairs = F.transform(F.filter(held, lambda f: F.coalesce(f["service"] != "", F.lit(False))), lambda f: F.struct(f["service"].alias("service"), f["state"]["active_intent"].alias("intent")))
    slots = F.flatten(F.transform("tw_frames", lambda f: _all(f["state"]["requested_slots"], "array<string>")))
    results = lambda f: F.greatest(F.coalesce(F.size(f["service_results"]), F.lit(0)), F.lit(0))
    calls = F.transform(F.filter("tw_frames", lambda f: f["service_call"].isNotNull()), lambda f: F.struct(f["service_call"]["method"].alias("method"), f["service_call"]["parameters"].alias("parameters"), results(f).alias("results")))
    told = lambda f: F.coalesce(F.exists(f["actions"], lambda a: a["act"] == SUCCESS), F.lit(False))
    asked = F.filter(_all(F.col("turns"), TURNS), lambda t: F.coalesce(t["speaker"] == USER, F.lit(False)))
    out = frames.withColumns({
        "intents": F.array_sort(F.array_distinct(F.transform(held, lambda f: f["state"]["active_intent"]))),
        "pairs": F.array_sort(F.array_distinct(pairs)),
        "n_turns": F.size(_all(F.col("turns"), TURNS)),
        "n_user_turns": F.size(asked),
        "requested_slots": F.array_sort(F.array_distinct(F.array_compact(slots))),
        "calls": calls,
        "successes": F.size(F.filter("tw_frames", told)),
        "utterances": F.transform(asked, lambda t: F.coalesce(t["utterance"], F.lit(""))),
    })
    return out.withColumn("verifiable", (F.size("calls") > 0) & F.forall("calls", lambda c: c["results"] > 0)).drop("tw_frames", "turns")


def corpus_summary(tasks: DataFrame) -> DataFrame:
    """One row of totals and rates; rates of nothing are 0."""
    with_results = F.size(F.filter("calls", lambda c: c["results"] > 0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = tasks.agg(F.count(F.lit(1)).alias("dialogues"), total("n_turns").alias("turns"), total(F.size("calls")).alias("calls"), total(with_results).alias("calls_with_results"), total("successes").alias("successes"), F.count_if("verifiable").alias("verifiable"))
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return sums.withColumns({"result_rate": rate("calls_with_results", "calls"), "verifiable_rate": rate("verifiable", "dialogues")})


def intent_dialogues(tasks: DataFrame) -> DataFrame:
    """(service, intent, dialogues): in how many dialogues an intent was active in a service."""
    return tasks.select(F.explode("pairs").alias("p")).groupBy("p.service", "p.intent").agg(F.count(F.lit(1)).alias("dialogues"))
