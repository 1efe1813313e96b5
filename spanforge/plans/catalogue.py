"""Registered queries over the driver's tables, each one operator or a chain of them. Their SQL is in ``oracles``."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanforge.operators import arguments, attribution, baseline, checks, dataset, discovery, rates, recordings, redaction, runs, sequence
from spanforge.operators.spans import classified
from spanforge.plans import lens, oracles
from spanforge.storage import Scratch
from spanforge.streaming import incremental, sessions

RUN = sequence.RUN
SALT = "spanforge-public-test-salt"
#: Parts of the facts beside the counts, by the check that reads them.
NEEDS = {"no_search_cascade": "cascades", "trajectory": "trajectory", "cost_latency": "usage", "valid_tool_args": "arguments", "evaluator_ready": "ready"}
PARTS = tuple(NEEDS.values())


def longs(df: DataFrame) -> DataFrame:
    """Whole numbers as long, so that types do not depend on the engine."""
    return df.select(*(F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, T.IntegerType) else F.col(f.name) for f in df.schema.fields))


def text_time(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def steps(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return classified(lens.spans(spark, sf_dir, **options), lens.CONFIG)


def facts(spark: SparkSession, sf_dir: str, needs: tuple[str, ...] = PARTS, **options) -> DataFrame:
    """What the checks read, for each run: aggregates on one key, each combined before its shuffle. ``needs`` names
    the parts that are joined to the counts."""
    s = steps(spark, sf_dir, **options)
    found = runs.run_facts(s, lens.CONFIG)
    if "cascades" in needs:
        found = found.join(sequence.worst_cascades(sequence.cascades(s, lens.CONFIG)), list(RUN), "left")
    if "trajectory" in needs:
        wanted = runs.expectations(s.select(*RUN).distinct().withColumn("intent", F.expr(lens.INTENT.replace("VARCHAR(20)", "STRING"))), lens.expected(spark))
        found = found.join(sequence.matched_prefixes(s, wanted, max(map(len, lens.CONFIG.expected.values()))), list(RUN), "left")
    if "usage" in needs:
        used = runs.usage(lens.chats(spark, sf_dir, **options)).select(*RUN, "uncached_input_tokens", "output_tokens", "peak_input_tokens")
        found = found.join(used, list(RUN), "left")
    if "arguments" in needs:
        found = found.join(arguments.argument_facts(s, lens.tools(spark), lens.CONFIG), list(RUN), "left")
    if "ready" in needs:
        has = s.groupBy(*RUN).agg(F.lit(True).alias("has_query"), F.max(F.col("result") != "").alias("has_response"), F.max(F.col("definitions") != "").alias("has_definitions"))
        found = found.join(has, list(RUN), "left")
    return found


def verdicts(spark: SparkSession, sf_dir: str, names: tuple[str, ...] | None = None, **options) -> DataFrame:
    """Verdicts of the checks in ``names``, or of all, from the facts that they need."""
    chosen = tuple(c for c in checks.CHECKS if names is None or c.name in names)
    needs = tuple(NEEDS[c.name] for c in chosen if c.name in NEEDS)
    return checks.verdicts(facts(spark, sf_dir, needs, **options), lens.CONFIG, chosen)


def halves(spark: SparkSession, sf_dir: str, names: tuple[str, ...] | None = None, op: str = lens.USER_OP) -> tuple[DataFrame, DataFrame]:
    """Verdicts of the time before the split, and after it; by user, so that most runs are in both."""
    make = lambda sign: verdicts(spark, sf_dir, names, op=op, where=f"ts {sign} {lens.SPLIT}")
    return make("<"), make(">=")


def steps_projection(spark, sf_dir):
    return steps(spark, sf_dir).select(*RUN, "ord", "bare_tool", "error_kind", "errored", "empty", "truncated")


def run_summary(spark, sf_dir):
    found = runs.run_facts(steps(spark, sf_dir), lens.CONFIG)
    return found.select(
        *RUN, text_time("started"), F.round("duration_ms", 4).alias("duration_ms"), F.round("tool_ms", 4).alias("tool_ms"), "n_calls", "n_errors", "n_wasted", "n_empty",
        "n_truncated", "n_truncated_skills", "wasted", "empty_tools",
    )


def run_counters(spark, sf_dir):
    return runs.counters(runs.run_facts(steps(spark, sf_dir), lens.CONFIG))


def trajectory_text(spark, sf_dir):
    return runs.trajectories(steps(spark, sf_dir))


def gate_pass_rate(spark, sf_dir):
    scored = checks.scored_runs(verdicts(spark, sf_dir, lens.CONFIG.gating))
    return scored.groupBy("agent").agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"), F.round(F.avg(F.col("passed").cast("int")), 6).alias("rate"))


def one_check(name: str):
    def query(spark, sf_dir):
        rows = verdicts(spark, sf_dir, (name,))
        return rows.select(*RUN, "passed", "reason", F.round("score", 6).alias("score"))

    return query


def cascades(spark, sf_dir):
    return sequence.cascades(steps(spark, sf_dir), lens.CONFIG)


def trajectory_prf(spark, sf_dir):
    f = facts(spark, sf_dir, ("trajectory",)).where("n_wanted is not null")
    recall, precision = F.col("n_matched") / F.col("n_wanted"), F.col("n_matched") / F.col("n_calls")
    f1 = F.when(F.col("n_matched") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return longs(f.select(*RUN, "n_wanted", "n_matched", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1")))


def candidate_ranking(spark, sf_dir):
    found = discovery.top_candidates(discovery.candidates(lens.spans(spark, sf_dir), least_calls=3), 25)
    return found.select("op_id", text_time("started"), "agents", "agent_count", "spans", "tool_calls", "has_tool_defs", "usable")


def clean_runs(spark, sf_dir):
    rows = lens.spans(spark, sf_dir, op="concat('op', user_id, '-d', day(ts))")
    return discovery.clean_operations(rows, 1, 40).select("op_id", text_time("started"), "tool_calls")


def content_overlay_left_join(spark, sf_dir):
    rows = lens.spans(spark, sf_dir).withColumn("id", F.col("ord"))
    content = rows.where("ord % 3 = 0").select("id", F.when(F.expr("k % 2 = 0"), F.concat(F.lit("a"), "k")).otherwise("").alias("arguments"), F.concat(F.lit("r"), "k").alias("result"))
    joined = discovery.with_content(rows, content.union(content))
    return joined.select("ord", "arguments", "result")


def semi_join_ops(spark, sf_dir):
    rows = lens.spans(spark, sf_dir, op="concat('op', user_id, '-d', day(ts))")
    return discovery.whole_operations(rows, ("agent1",)).groupBy("op_id").agg(F.count("*").alias("spans"))


def toolbox_first_seen(spark, sf_dir):
    return longs(runs.toolboxes(lens.boxes(spark, sf_dir)))


def manifest_theta_join(spark, sf_dir):
    found = runs.tool_definitions(runs.toolboxes(lens.boxes(spark, sf_dir)), lens.manifests(spark))
    return found.select(*RUN, "tool", "source")


def expectation_fallback(spark, sf_dir):
    who = lens.spans(spark, sf_dir).select(*RUN).distinct().withColumn("intent", F.expr(lens.INTENT.replace("VARCHAR(20)", "STRING")))
    return runs.expectations(who, lens.expected(spark)).select(*RUN, F.array_join("want", ",").alias("want"))


def inbound_intent(spark, sf_dir):
    return runs.inbound_intents(lens.handoffs(spark, sf_dir), lens.CONFIG)


def intent_sources(spark, sf_dir):
    """Intents of runs with where each comes from, of what they were asked, handed and have handed on."""
    steps_ = lens.handoffs(spark, sf_dir)
    asked = steps_.groupBy(*RUN).agg(F.min("ord").alias("m")).select(*RUN, F.expr(lens.ASKED).alias("messages"))
    return runs.resolved_intents(asked, steps_, lens.CONFIG)


def run_details(spark, sf_dir):
    """The lists of each run, in long form."""
    rows = runs.run_details(steps(spark, sf_dir), lens.CONFIG)
    none = F.lit(None).cast("string")
    parts = [
        ("tool_names", F.col("x"), none, none), ("tool_errors", F.col("x.tool"), F.col("x.kind"), F.col("x.args")), ("empty_results", F.col("x.tool"), none, F.col("x.args")),
        ("search_cascades", F.col("x.tool"), F.col("x.length").cast("string"), F.array_join("x.args", ";")), ("actions", F.get("x.content", 0)["name"], F.col("x.role"), F.get("x.content", 0)["arguments"]),
    ]
    long = [
        rows.select(*RUN, F.posexplode(name).alias("place", "x")).select(*RUN, F.lit(name).alias("list"), F.col("place").cast("long").alias("place"), tool.alias("tool"), kind.alias("kind"), args.alias("args"))
        for name, tool, kind, args in parts
    ]
    whole = long[0]
    for part in long[1:]:
        whole = whole.unionByName(part)
    return whole


def nested_schema(spark, sf_dir):
    found = dataset.nested_schema(lens.spans(spark, sf_dir).select(F.expr(lens.NESTED).alias("json")))
    return found.select(F.array_join("path", "/").alias("path"), "types", "required", "n")


def usage_fallback(spark, sf_dir):
    return runs.usage(lens.chats(spark, sf_dir))


def pick_run_span(spark, sf_dir):
    return runs.run_span(lens.chats(spark, sf_dir))


def longest_definitions(spark, sf_dir):
    return runs.longest_definitions(lens.spans(spark, sf_dir))


def skill_hashes(spark, sf_dir):
    return runs.skills(steps(spark, sf_dir), lens.CONFIG).select(*RUN, "ord", "skill_name", "sha256", F.col("chars").cast("long").alias("chars"), "errored")


def skill_drift(spark, sf_dir):
    return runs.skill_drift(runs.skills(steps(spark, sf_dir), lens.CONFIG))


def arg_validation(spark, sf_dir):
    return arguments.argument_facts(steps(spark, sf_dir), lens.tools(spark), lens.CONFIG)


def arg_problems(spark, sf_dir):
    found = arguments.problems(steps(spark, sf_dir), lens.tools(spark), lens.CONFIG)
    return found.groupBy("tool", "problem").agg(F.count("*").alias("n"))


def score_rates(spark, sf_dir):
    found = rates.check_rates(verdicts(spark, sf_dir))
    return found.select("check", "gating", "passed", "applied", "skipped", F.round("rate", 6).alias("rate"))


def thresholds(spark, sf_dir):
    return rates.below_floor(rates.check_rates(verdicts(spark, sf_dir, lens.CONFIG.gating)), 0.9).select("check", F.round("rate", 6).alias("rate"))


def overall_rate(spark, sf_dir):
    found = rates.overall_rate(checks.scored_runs(verdicts(spark, sf_dir, lens.CONFIG.gating)))
    return found.select("passed", "total", F.round("rate", 6).alias("rate"))


def not_scored(spark, sf_dir):
    return rates.not_scored(verdicts(spark, sf_dir))


def tracking_rollup(spark, sf_dir):
    found = rates.tracking(facts(spark, sf_dir, ("usage",)), "agent")
    return found.withColumn("longest_ms", F.round("longest_ms", 4))


def baseline_diff(spark, sf_dir):
    before, after = halves(spark, sf_dir)
    return baseline.differences(after, before).where("change <> 'same'").select(*RUN, "check", "change")


def strict_failures(spark, sf_dir):
    before, after = halves(spark, sf_dir, ("no_tool_errors",), lens.HOUR_OP)  # only the keys are compared
    return baseline.strict_failures(after, before)


def gate_decision(spark, sf_dir):
    before, after = halves(spark, sf_dir, lens.CONFIG.gating, lens.HOUR_OP)
    pairs = Scratch(spark, "gate").stored(baseline.paired(after, before))  # read by the changes and by the strict comparison
    return baseline.decision(baseline.changes(pairs), baseline.strict(pairs))


def cassette_interactions(spark, sf_dir):
    found = recordings.interactions(steps(spark, sf_dir), lens.CONFIG)
    return longs(found.select("op_id", "seq", "agent", "tool", "key", "error_kind", "is_write", "truncated"))


def cassette_headers(spark, sf_dir):
    return recordings.recordings(recordings.interactions(steps(spark, sf_dir), lens.CONFIG))


def _played(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Calls of the time after the split, and the recording before it, by user; few keys, so that answers run out."""
    coarse = F.concat(F.substring_index("tool", "___", -1), F.lit("|"), F.expr("k % 5"))
    make = lambda sign: sequence.numbered(steps(spark, sf_dir, op=lens.USER_OP, where=f"ts {sign} {lens.SPLIT}"), "op_id").withColumn("key", coarse)
    return make(">=").withColumn("session", F.concat(F.lit("s"), "op_id")), make("<")


def journal(spark, sf_dir) -> DataFrame:
    calls, recorded = _played(spark, sf_dir)
    return recordings.replayed(calls, recorded)


def cassette_replay(spark, sf_dir):
    return longs(journal(spark, sf_dir).select("session", "seq", "key", "outcome", "recorded_seq", "is_write"))


def matched_prefix(spark, sf_dir):
    return longs(sequence.prefix_length(journal(spark, sf_dir), "session"))


def journal_summary(spark, sf_dir):
    return longs(recordings.journal_summary(journal(spark, sf_dir)).drop("op_id"))


def journal_counts(spark, sf_dir):
    return recordings.tools_called(journal(spark, sf_dir), only_diverged=True)


def local_tools(spark, sf_dir):
    return recordings.local_tools(steps(spark, sf_dir), ("tool_search",), lens.CONFIG)


def relabel_not_recorded(spark, sf_dir):
    errors = steps(spark, sf_dir).where("errored").select(*RUN, "ts", "ord", "tool", "error_kind")
    diverged = errors.where("error_kind = 'empty_failed'").groupBy(*RUN, F.substring_index("tool", "___", -1).alias("tool")).agg(F.ceil(F.count("*") / 2).alias("n"))
    return attribution.relabelled(errors, diverged).groupBy("error_kind").agg(F.count("*").alias("n"))


def _replays(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A replay for each user. Of eight users in turn, every two share a run and every other two a recording, so claims hang together in chains of eight.
    Journals hold the calls that the events show, but for some replays one of each tool less or two more."""
    users = lens.table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()
    users = users.selectExpr("u", "u - u % 8 + u % 8 div 2 as run", "u - u % 8 + (u % 8 + 1) div 2 as rec")
    manifests = users.select(
        "u", "run", F.format_string("r%06d", "u").alias("replay"), F.lit("agent0").alias("replay_agent"), F.expr("if(u % 31 = 0, null, cast(run as string))").alias("temp_version"),
        F.lit("tb@1").alias("toolbox"), F.expr("concat('rec', rec)").alias("recorded_op_id"), F.lit("agent0").alias("recorded_agent"), F.lit("agent0").alias("agent"),
        F.expr("u % 17 <> 0").alias("has_local"), F.expr("u % 19 <> 0").alias("honoured"), F.expr("u % 23 <> 0").alias("has_journal"),
    )
    ran = users.select("run").distinct()
    scored = ran.select(
        F.expr("concat('u', run)").alias("op_id"), F.lit("agent0").alias("agent"), F.expr("if(run % 7 = 0, 'none', cast(run as string))").alias("version"),
        F.expr("array(if(run % 41 = 0, 'live@2', 'tb@1'))").alias("toolboxes"), F.expr("if(run % 11 = 0, 1, 0)").alias("a2a_calls"),
        F.expr("if(run % 13 = 0, 1, 0)").alias("content_missing"),
    )
    scored = scored.union(scored.where("cast(substr(op_id, 2) as int) % 15 = 0").withColumns({"agent": F.lit("agent1")}))
    bare = F.substring_index("tool", "___", -1)
    calls = steps(spark, sf_dir, op=lens.USER_OP).groupBy("op_id", "agent", bare.alias("tool")).agg(F.count("*").alias("n"))
    pairs = manifests.select("replay", "u", F.expr("concat('u', run)").alias("op_id"), F.lit("agent0").alias("agent"))
    seen = pairs.join(calls, ["op_id", "agent"]).where("tool <> 'load_skill'")
    journal = seen.select("replay", "tool", F.expr("n - if(u % 29 = 0, 1, 0) + if(u % 37 = 0, 2, 0)").alias("n"))
    differ = attribution.tool_differences(pairs, calls, journal, pairs.select("replay", F.lit("load_skill").alias("tool")))
    manifests = manifests.join(differ, "replay", "left").fillna(0, ["excess", "missing"]).drop("u", "run")
    frozen = users.select("rec").distinct().where("rec % 12 <> 0").select(F.expr("concat('rec', rec)").alias("op_id"), F.lit("agent0").alias("agent"), F.lit("b1").alias("file"))
    return manifests, scored, frozen.union(frozen.where("cast(substr(op_id, 4) as int) % 13 = 0").withColumn("file", F.lit("b2")))


def attributed_replays(spark, sf_dir):
    found = attribution.attributed(*_replays(spark, sf_dir))
    told = F.array_join(F.transform("failures", lambda x: x["failure"]), "; ")
    return found.select("replay", "failure", told.alias("failures"), "retryable", F.when(F.col("failure").isNull(), F.col("file")).alias("file"))


def attribution_exit(spark, sf_dir):
    return longs(attribution.exit_code(attribution.attributed(*_replays(spark, sf_dir))))


def dataset_rows(spark, sf_dir):
    """Each message of each run, in long form."""
    rows = dataset.dataset_rows(steps(spark, sf_dir))
    return rows.select(*RUN, F.posexplode("messages").alias("place", "m")).select(
        *RUN, F.col("place").cast("long").alias("place"), "m.role", "m.call_id", "m.type", "m.name", F.length("m.content").cast("long").alias("chars")
    )


def dataset_round_trip(spark, sf_dir):
    """The outcomes of a dataset, classified again, give the counts of the steps they were made from."""
    again = dataset.outcome_steps(dataset.dataset_rows(steps(spark, sf_dir)), lens.CONFIG)
    return again.groupBy("agent").agg(F.count_if("errored").alias("errors"), F.count_if("empty").alias("empty"), F.count_if("truncated").alias("truncated"))


def port_scores(spark, sf_dir):
    rows = checks.above_threshold(verdicts(spark, sf_dir))
    return rows.groupBy("check").agg(F.count("*").alias("n"), F.count_if("reached").alias("reached"), F.round(F.avg("score"), 6).alias("score"))


def schema_inference(spark, sf_dir):
    return dataset.inferred_schema(lens.spans(spark, sf_dir).select(F.col("arguments").alias("json")))


def pseudonym_tokens(spark, sf_dir):
    docs = lens.table(spark, sf_dir, "documents")
    found = docs.select(F.explode(F.regexp_extract_all("text", F.lit(redaction.EMAIL), F.lit(0))).alias("literal"), F.lit("EMAIL").alias("kind"))
    return redaction.tokens(found, SALT)


def email_redaction(spark, sf_dir):
    """The addresses of each text in order, as their tokens, and whether any is left in the swept text."""
    docs = lens.table(spark, sf_dir, "documents").select("doc_id", "text")
    none = spark.createDataFrame([], "literal string, kind string")
    out = redaction.swept(docs, ["text"], none, SALT)
    named = F.regexp_extract_all("text", F.lit(r"EMAIL_[0-9a-f]{8}"), F.lit(0))
    return out.where(F.size(named) > 0).select("doc_id", F.array_join(named, ",").alias("tokens"), F.regexp_like("text", F.lit(redaction.EMAIL)).alias("left"))


def phone_redaction(spark, sf_dir):
    """The numbers of each text in order, as their tokens, and how many are left in the swept text, by the classes of characters that the sweep goes by."""
    docs = lens.table(spark, sf_dir, "documents").select("doc_id", "text")
    none = spark.createDataFrame([], "literal string, kind string")
    named = F.regexp_extract_all("text", F.lit(r"PHONE_[0-9a-f]{8}"), F.lit(0))
    left = F.regexp_count("text", F.lit(f"(?U){redaction.PHONE}")).cast("long")
    return redaction.swept(docs, ["text"], none, SALT).where(F.size(named) > 0).select("doc_id", F.array_join(named, ",").alias("tokens"), left.alias("left"))


def candidate_literals(spark, sf_dir):
    return redaction.candidates(lens.table(spark, sf_dir, "documents"))


def swept_texts(spark, sf_dir):
    """Whole texts with addresses, numbers and listed literals replaced."""
    listed = spark.createDataFrame([("example.com", "DOMAIN")], "literal string, kind string")
    docs = lens.table(spark, sf_dir, "documents").select("doc_id", "text")
    return redaction.swept(docs, ["text"], listed, SALT).select("doc_id", F.sha2("text", 256).alias("sha256"))


def residual_check(spark, sf_dir):
    listed = spark.createDataFrame([(w, "WORD") for w in ("the and", "la", "DER", "nowhere-at-all")], "literal string, kind string")
    return redaction.still_there(lens.table(spark, sf_dir, "conversations"), listed)


def watermark_window(spark, sf_dir):
    from datetime import datetime

    rows = incremental.due_operations(lens.spans(spark, sf_dir), datetime(2024, 1, 10), datetime(2024, 1, 11))
    return rows.groupBy("op_id").agg(F.count("*").alias("spans"), F.max("ts").alias("newest")).select("op_id", "spans", text_time("newest"))


def seeded_sample(spark, sf_dir):
    return rates.seeded_sample(lens.spans(spark, sf_dir).select(*RUN).distinct(), 50, 7, *RUN)


def stream_sessions(spark, sf_dir):
    """The journal of a stream of calls; the same outcomes as ``cassette_replay``, from state instead of windows."""
    schema = lens.table(spark, sf_dir, "events").schema
    _, recorded = _played(spark, sf_dir)
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").where(f"ts >= {lens.SPLIT}").withColumnRenamed("event_id", "ord")
    rows = events.withColumns({"k": F.expr(lens.K), "op_id": F.expr(lens.USER_OP), "tool": F.expr(lens.TOOL)})
    calls = rows.select(
        F.concat(F.lit("s"), "op_id").alias("session"), "op_id", "ord", "tool", F.concat(F.substring_index("tool", "___", -1), F.lit("|"), F.expr("k % 5")).alias("key")
    )
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='spanforge-stream-')}"
    at = f"{shared.rstrip('/')}/sessions-{spark.sql('select uuid()').first()[0]}"
    found = sessions.replay_sessions(calls, recorded)
    query = found.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return longs(spark.read.schema(sessions.JOURNAL).parquet(f"{at}/out").select("session", "seq", "key", "outcome"))


CHECK_QUERIES = {
    "wasted_calls": "no_wasted_calls", "dead_end_rate": "no_dead_ends", "error_rate": "no_tool_errors", "cascade_check": "no_search_cascade",
    "trajectory": "trajectory", "truncation": "no_truncation", "cost_latency": "cost_latency", "valid_tool_args": "valid_tool_args", "evaluator_ready": "evaluator_ready",
}
QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    steps_projection, run_summary, run_counters, trajectory_text, gate_pass_rate, cascades, trajectory_prf, candidate_ranking, clean_runs, content_overlay_left_join,
    semi_join_ops, toolbox_first_seen, manifest_theta_join, expectation_fallback, inbound_intent, intent_sources, run_details, nested_schema, usage_fallback, pick_run_span, longest_definitions, skill_hashes,
    skill_drift, arg_validation, arg_problems, score_rates, thresholds, overall_rate, not_scored, tracking_rollup, baseline_diff, strict_failures, gate_decision,
    cassette_interactions, cassette_headers, cassette_replay, matched_prefix, journal_summary, journal_counts, local_tools, relabel_not_recorded, attributed_replays,
    attribution_exit, dataset_rows, dataset_round_trip, port_scores, schema_inference, pseudonym_tokens, email_redaction, phone_redaction, candidate_literals, swept_texts, residual_check,
    watermark_window, seeded_sample, stream_sessions,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES} | {name: one_check(check) for name, check in CHECK_QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
