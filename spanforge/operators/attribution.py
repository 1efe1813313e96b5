"""Which run a replay was, and whether it ran against the recording alone.

A replay pairs with one scored run and one baseline row, or it fails: because no one run is found, or for all that speaks
against its having run against the recording alone, or because another replay has its run or recording. A failure
that more ingestion may cure is retryable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.operators.sequence import RUN
from spanforge.storage import Scratch

REQUIRED = ("replay_agent", "temp_version", "recorded_op_id", "recorded_agent")


def tool_differences(manifests: DataFrame, calls: DataFrame, journal: DataFrame, local: DataFrame) -> DataFrame:
    """replay, excess, missing: calls of the trace that the journal lacks (local tools aside), and the other way round.

    ``manifests``: replay, op_id, agent of the run; ``calls``: op_id, agent, tool (bare), n; ``journal``: replay, tool, n;
    ``local``: replay, tool."""
    made = manifests.select("replay", *RUN).join(calls, list(RUN)).select("replay", "tool", F.col("n").alias("_made"))
    remote = local.select("replay", "tool").distinct().withColumn("_local", F.lit(True))
    both = made.join(journal.select("replay", "tool", F.col("n").alias("_seen")), ["replay", "tool"], "full").join(remote, ["replay", "tool"], "left")
    made_n, seen_n = F.coalesce("_made", F.lit(0)), F.coalesce("_seen", F.lit(0))
    excess = F.when(F.col("_local").isNull(), F.greatest(made_n - seen_n, F.lit(0))).otherwise(0)
    return both.groupBy("replay").agg(F.sum(excess).alias("excess"), F.sum(F.greatest(seen_n - made_n, F.lit(0))).alias("missing"))


def relabelled(errors: DataFrame, diverged: DataFrame) -> DataFrame:
    """``errors`` (op_id, agent, ts, ord, tool, error_kind) with the first n failures without a result of a tool marked as not
    recorded, n being how many of its calls diverged. ``diverged``: op_id, agent, tool (bare), n."""
    bare = F.substring_index("tool", "___", -1)
    rank = F.row_number().over(Window.partitionBy(*RUN, bare, "error_kind").orderBy("ts", "ord"))
    joined = errors.withColumns({"_rank": rank, "_bare": bare}).join(diverged.select(*RUN, F.col("tool").alias("_bare"), "n"), [*RUN, "_bare"], "left")
    hit = (F.col("error_kind") == "empty_failed") & (F.col("_rank") <= F.coalesce("n", F.lit(0)))
    return joined.withColumn("error_kind", F.when(hit, "not_recorded").otherwise(F.col("error_kind"))).drop("_rank", "_bare", "n")


FAILURES = "array<struct<failure: string, retryable: boolean>>"


def attributed(manifests: DataFrame, runs: DataFrame, baselines: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """A row for each replay: replay, op_id, agent, file, failures (of failure and retryable; empty: attributed), and of these
    the first as failure, and retryable, which is true if all of them are.

    ``manifests``: replay, replay_agent, temp_version, toolbox, recorded_op_id, recorded_agent, agent, has_local, honoured,
    has_journal, excess, missing, and remote if it is known (calls of tools that the recording reached through its server);
    ``runs``: op_id, agent, version, toolboxes (array of ``name@version``), a2a_calls, content_missing; ``baselines``: op_id, agent, file; ``taken``:
    op_id, recorded_op_id and recorded_agent of replays that were attributed before."""
    remote = F.coalesce("remote", F.lit(0)) if "remote" in manifests.columns else F.lit(0)
    m = manifests.withColumn("_absent", F.exists(F.array(*(F.col(c).cast("string") for c in REQUIRED)), lambda x: F.coalesce(x, F.lit("")) == ""))
    others = runs.groupBy("op_id").agg(F.count("*").alias("_agents"))
    r = runs.join(others, "op_id").select(
        F.col("op_id").alias("_op"), F.col("agent").alias("_agent"), F.col("version").cast("string").alias("_version"),
        "toolboxes", "a2a_calls", "content_missing", "_agents",
    )
    on = (F.col("replay_agent") == F.col("_agent")) & (F.col("temp_version").cast("string") == F.col("_version"))
    # A pairing column that is null means that no run was found; at most one run is looked at behind it.
    per = Window.partitionBy("replay")
    pairs = m.join(r, on, "left").withColumn("_found", F.count("_op").over(per))
    own = F.array_contains("toolboxes", F.col("toolbox"))
    by_box = (F.col("_found") > 1) & F.col("toolbox").isNotNull()
    pairs = pairs.withColumn("_fits", F.when(by_box, F.coalesce(own, F.lit(False))).otherwise(F.col("_op").isNotNull()))
    pairs = pairs.withColumn("_left", F.count_if("_fits").over(per))
    one = Window.partitionBy("replay").orderBy(F.desc("_fits"), "_op")
    pairs = pairs.withColumn("_row", F.row_number().over(one)).where("_row = 1")
    key = ["recorded_op_id", "recorded_agent"]
    hits = baselines.groupBy(F.col("op_id").alias(key[0]), F.col("agent").alias(key[1])).agg(F.count("*").alias("_hits"), F.min("file").alias("file"))
    foreign = F.col("toolbox").isNotNull() & F.exists(F.coalesce("toolboxes", F.array().cast("array<string>")), lambda t: t != F.col("toolbox"))

    def when(hit: Column, text: str, again: bool = False) -> Column:
        return F.when(F.coalesce(hit, F.lit(False)), F.struct(F.lit(text).alias("failure"), F.lit(again).alias("retryable")))

    no_run = F.coalesce(
        when(F.col("_absent"), "the manifest lacks a field"), when(F.col("_found") == 0, "no scored run yet", True),
        when(by_box & (F.col("_left") == 0), "no run used the toolbox of the replay yet", True), when(F.col("_left") > 1, "several scored runs"),
    )
    # Each of these is told; behind them only the first, since it takes away what the next would be told from.
    each = [
        when(~F.col("agent").eqNullSafe(F.col("recorded_agent")), "another agent than the recorded one was replayed"),
        when(F.col("a2a_calls") > 0, "the run called other agents"), when(F.col("_agents") > 1, "other agents ran in the operation"),
        when(foreign, "the run used another toolbox"),
    ]
    first = F.coalesce(
        when(~F.col("has_local"), "the manifest has no local tools"), when(F.col("content_missing") > 0, "content is not ingested yet", True),
        when(~F.col("honoured"), "the server did not see the session"), when(~F.col("has_journal"), "the manifest has no journal"),
        when(F.col("honoured").isNull() & (remote > 0), "calls reached no session that is known"),
        when(F.col("excess") > 0, "calls that the server never saw"), when(F.col("missing") > 0, "journalled calls are not ingested yet", True),
    )
    told = F.when(no_run.isNotNull(), F.array(no_run)).otherwise(F.filter(F.array(*each, first), lambda x: x.isNotNull()))
    rows = pairs.withColumn("failures", told)
    bad, well = rows.where(F.size("failures") > 0), rows.where(F.size("failures") == 0)
    well = _claimed(well.join(hits, key, "left"), ["_op"], key, None if taken is None else taken.withColumnRenamed("op_id", "_op"))
    late = F.coalesce(
        when(F.col("_run_taken"), "the run is attributed to another replay"), when(F.col("_key_taken"), "the recording is replayed twice"),
        when(F.col("_hits").isNull(), "no baseline"), when(F.col("_hits") > 1, "several baselines"),
    )
    well = well.withColumn("failures", F.filter(F.array(late), lambda x: x.isNotNull()))
    columns = ["replay", F.col("_op").alias("op_id"), F.col("_agent").alias("agent"), "file", F.col("failures").cast(FAILURES).alias("failures")]
    found = bad.withColumn("file", F.lit(None).cast("string")).select(*columns).unionByName(well.select(*columns))
    return found.withColumns({
        "failure": F.get("failures", 0)["failure"], "retryable": F.when(F.size("failures") > 0, F.forall("failures", lambda x: x["retryable"])),
    })


def matched(claims: DataFrame, run: list[str], key: list[str]) -> DataFrame:
    """Of ``claims`` (``order`` and the columns of ``run`` and ``key``, none null), those that are met if they are taken in order and each takes a run and a
    key that are both free.

    In each round the claims win that come first among the open ones of their run and of their key; with them go all others
    of the same run or key. Both are written down before the next round, which reads only what is still open, until
    nothing is. Claims that hang together in one long chain win one after another, so there may be half as many rounds as the
    longest chain has claims; other claims need few.
    """
    scratch = Scratch(claims.sparkSession, "claims")
    open_, won = scratch.stored(claims.select("order", *run, *key)), []
    while not open_.isEmpty():
        first_run = open_.groupBy(*run).agg(F.min("order").alias("_run"))
        first_key = open_.groupBy(*key).agg(F.min("order").alias("_key"))
        won.append(scratch.stored(open_.join(first_run, run).join(first_key, key).where("order = _run and order = _key").select("order", *run, *key)))
        left = open_.join(won[-1].select(*run), run, "left_anti").join(won[-1].select(*key), key, "left_anti")
        before, open_ = scratch.n - 1, scratch.stored(left)
        scratch.drop(before)
    whole = open_
    for part in won:
        whole = whole.unionByName(part)
    return whole


def _claimed(rows: DataFrame, run: list[str], key: list[str], before: DataFrame | None) -> DataFrame:
    """``rows`` with _run_taken and _key_taken: whether an earlier replay has the run or the recording. Only a replay with just one
    baseline takes them, and one that is refused takes nothing, which frees a run for a later one. Order is that of ``replay``; of rows equal in it,
    the one stored first is earlier. ``before`` are runs and keys that were taken before all of these."""
    run_before = key_before = F.lit(False)
    if before is not None:
        rows = rows.join(before.select(*run).distinct().withColumn("_run_before", F.lit(True)), run, "left")
        rows = rows.join(before.select(*key).distinct().withColumn("_key_before", F.lit(True)), key, "left")
        run_before, key_before = F.col("_run_before").isNotNull(), F.col("_key_before").isNotNull()
    rows = Scratch(rows.sparkSession, "replays").stored(rows.withColumn("order", F.struct("replay", F.monotonically_increasing_id().alias("n"))))
    won = matched(rows.where((F.col("_hits") == 1) & ~run_before & ~key_before), run, key)
    by_run = won.select(*run, F.col("order").alias("_by_run"))
    by_key = won.select(*key, F.col("order").alias("_by_key"))
    taken = rows.join(by_run, run, "left").join(by_key, key, "left")
    earlier = lambda c: F.coalesce(F.col(c) < F.col("order"), F.lit(False))
    return taken.withColumns({"_run_taken": run_before | earlier("_by_run"), "_key_taken": key_before | earlier("_by_key")}).drop("_by_run", "_by_key", "order")


def failures_of(found: DataFrame) -> DataFrame:
    """replay, failure, retryable: every failure of every replay."""
    return found.select("replay", F.inline("failures"))


def exit_code(found: DataFrame) -> DataFrame:
    """0 if all are attributed, 3 if all failures of all replays are retryable, else 1."""
    n, again = F.sum(F.size("failures")), F.sum(F.size(F.filter("failures", lambda x: x["retryable"])))
    return found.agg(F.when(F.coalesce(n, F.lit(0)) == 0, 0).when(n == again, 3).otherwise(1).alias("exit_code"))


def as_recorded(spans: DataFrame, found: DataFrame) -> DataFrame:
    """Spans of attributed runs under the names of agent and toolbox of their recordings; operation ids stay, since they
    are those of the real trace. ``found``: op_id, agent, recorded_agent, toolbox and recorded_toolbox (``name@version`` or null);
    ``spans``: op_id, name, d."""
    path = lambda c: F.concat(F.lit("/toolboxes/"), F.replace(F.col(c), F.lit("@"), F.lit("/versions/")), F.lit("/"))
    names = found.select("op_id", F.col("agent").alias("_was"), F.col("recorded_agent").alias("_is"), path("toolbox").alias("_from"), path("recorded_toolbox").alias("_to"))
    joined = spans.join(names, "op_id")
    moved = F.coalesce(F.replace("name", F.col("_from"), F.col("_to")), F.col("name"))
    called = F.when(moved == F.concat(F.lit("invoke_agent "), "_was"), F.concat(F.lit("invoke_agent "), "_is")).otherwise(moved)
    renamed = F.transform_values("d", lambda k, v: F.when(v == F.col("_was"), F.col("_is")).otherwise(v))
    return joined.withColumns({"name": called, "d": renamed}).drop("_was", "_is", "_from", "_to")
