"""DuckDB SQL for the registered queries, written apart from the operators; only the lens is shared."""

from __future__ import annotations

from spanforge.config import AVOIDABLE
from spanforge.plans import lens

AVOID = ", ".join(f"'{k}'" for k in AVOIDABLE)
SALT = "spanforge-public-test-salt"
DAY_OP = "concat('op', user_id, '-d', day(ts))"
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _time(x: str) -> str:
    return TIME.format(x)


def _cascades(s: str) -> str:
    return f"""
casc_a{s} AS (SELECT op_id, agent, ts, ord, tool, errored OR empty AS bad, lag(errored OR empty) OVER w AS was, lag(tool) OVER w AS was_tool
  FROM steps{s} WINDOW w AS (PARTITION BY op_id, agent ORDER BY ts, ord)),
casc_b{s} AS (SELECT *, sum(CASE WHEN bad AND (was IS NULL OR NOT was OR was_tool <> tool) THEN 1 ELSE 0 END)
  OVER (PARTITION BY op_id, agent ORDER BY ts, ord) AS island FROM casc_a{s}),
casc{s} AS (SELECT op_id, agent, min(tool) AS tool, count(*) AS length, min(ord) AS first_ord FROM casc_b{s} WHERE bad
  GROUP BY op_id, agent, island HAVING count(*) >= 4)"""


def _facts(s: str = "") -> str:
    want = "CASE WHEN agent = 'agent1' THEN ['get', 'create'] WHEN intent = 'Full Triage' THEN ['load_skill', 'get', 'create'] END"
    return f"""{_cascades(s)},
f_runs{s} AS (SELECT op_id, agent, min(ts) AS started, max(duration) AS duration_ms, sum(duration) AS tool_ms, count(*) AS n_calls, count(*) FILTER (errored) AS n_errors,
  count(*) FILTER (error_kind IN ({AVOID})) AS n_wasted, count(*) FILTER (empty) AS n_empty, count(*) FILTER (truncated) AS n_truncated,
  count(*) FILTER (truncated AND bare_tool = 'load_skill') AS n_truncated_skills, bool_or(result <> '') AS has_response, bool_or(definitions <> '') AS has_definitions
  FROM steps{s} GROUP BY op_id, agent),
f_empty{s} AS (SELECT op_id, agent, string_agg(tool, ', ' ORDER BY tool) AS empty_tools FROM
  (SELECT *, row_number() OVER (PARTITION BY op_id, agent ORDER BY tool) AS r FROM (SELECT DISTINCT op_id, agent, tool FROM steps{s} WHERE empty)) WHERE r <= 3 GROUP BY op_id, agent),
f_kinds{s} AS (SELECT op_id, agent, string_agg(error_kind || 'x' || n, ', ' ORDER BY n DESC, since_at) AS wasted FROM
  (SELECT op_id, agent, error_kind, count(*) AS n, min(ts) AS since_at FROM steps{s} WHERE error_kind IN ({AVOID}) GROUP BY ALL) GROUP BY op_id, agent),
f_casc{s} AS (SELECT op_id, agent, count(*) AS n_cascades, max(length) AS longest, arg_max(tool, length * 1000000000 - first_ord) AS worst_tool FROM casc{s} GROUP BY op_id, agent),
f_want{s} AS (SELECT *, {want} AS want FROM (SELECT op_id, agent, {lens.INTENT} AS intent FROM f_runs{s})),
f_m1{s} AS (SELECT w.op_id, w.agent, want, min(ts) FILTER (bare_tool = want[1]) AS m1 FROM f_want{s} w JOIN steps{s} USING (op_id, agent) WHERE want IS NOT NULL GROUP BY ALL),
f_m2{s} AS (SELECT m.op_id, m.agent, want, m1, min(ts) FILTER (bare_tool = want[2] AND ts > m1) AS m2 FROM f_m1{s} m JOIN steps{s} USING (op_id, agent) GROUP BY ALL),
f_m3{s} AS (SELECT m.op_id, m.agent, want, m1, m2, min(ts) FILTER (len(want) > 2 AND bare_tool = want[3] AND ts > m2) AS m3 FROM f_m2{s} m JOIN steps{s} USING (op_id, agent) GROUP BY ALL),
f_match{s} AS (SELECT op_id, agent, len(want) AS n_wanted, CAST((m1 IS NOT NULL) AS INT) + CAST((m2 IS NOT NULL) AS INT) + CAST((m3 IS NOT NULL) AS INT) AS n_matched FROM f_m3{s}),
f_used{s} AS ({_usage(s)}),
f_args{s} AS ({_args(s)}),
facts{s} AS (SELECT r.*, empty_tools, wasted, n_cascades, longest, worst_tool, n_wanted, n_matched, uncached_input_tokens, output_tokens, peak_input_tokens, n_args_checked, n_args_bad
  FROM f_runs{s} r LEFT JOIN f_empty{s} USING (op_id, agent) LEFT JOIN f_kinds{s} USING (op_id, agent) LEFT JOIN f_casc{s} USING (op_id, agent)
  LEFT JOIN f_match{s} USING (op_id, agent) LEFT JOIN f_used{s} USING (op_id, agent) LEFT JOIN f_args{s} USING (op_id, agent)),
verdicts{s} AS ({_verdicts(s)})"""


def _usage(s: str) -> str:
    pick = lambda how, x: f"CAST(CASE WHEN count(*) FILTER (NOT roll) > 0 THEN {how}({x}) FILTER (NOT roll) ELSE {how}({x}) FILTER (roll) END AS BIGINT)"
    return f"""SELECT op_id, agent, count(*) FILTER (NOT roll) AS llm_calls, {pick('sum', 'i')} AS prompt_tokens_sum, {pick('sum', 'greatest(i - c, 0)')} AS uncached_input_tokens,
  {pick('sum', 'c')} AS cache_read_tokens, {pick('sum', '0')} AS cache_write_tokens, {pick('sum', 'o')} AS output_tokens, {pick('sum', 'r')} AS reasoning_tokens,
  {pick('max', 'i')} AS peak_input_tokens, CASE WHEN count(*) FILTER (NOT roll) > 0 THEN 'chat_spans' ELSE 'rollup' END AS usage_source
  FROM (SELECT op_id, agent, starts_with(name, 'invoke_agent') AS roll, CAST(input AS BIGINT) AS i, CAST(cache_read AS BIGINT) AS c, CAST(output AS BIGINT) AS o,
  CAST(reasoning AS BIGINT) AS r FROM chats{s}) GROUP BY op_id, agent"""


#: What is wrong with a call, by the forms that arguments take in the lens.
PROBLEMS = (
    ("type", "arguments = '{\"k\": \"x\"}' AND bare_tool IN ('get', 'search')"),
    ("enum", "bare_tool = 'search' AND (arguments = '{\"k\": \"x\"}' OR (arguments = props AND k >= 50))"),
    ("missing", "arguments = '{}' AND bare_tool = 'get'"),
    ("not an object", "arguments = 'nope'"),
    ("unexpected", "arguments = '{\"k\": 1, \"z\": 2}' AND bare_tool = 'create'"),
)


def _args(s: str) -> str:
    bad = " + ".join(f"CAST(({test}) AS INT)" for _, test in PROBLEMS)
    return f"""SELECT op_id, agent, count(*) AS n_args_checked, CAST(sum({bad}) AS BIGINT) AS n_args_bad FROM steps{s}
  WHERE bare_tool IN ('get', 'search', 'create') GROUP BY op_id, agent"""


def _verdicts(s: str) -> str:
    share = lambda bad, n: f"CASE WHEN {n} > 0 THEN greatest(0.0, 1 - ({bad})::DOUBLE / {n}) ELSE 1.0 END"
    tokens = "(coalesce(uncached_input_tokens, 0) + coalesce(output_tokens, 0))"
    over = lambda x, most: f"CASE WHEN {x} <= {most} THEN 1.0 ELSE greatest(0.0, 1 - ({x} - {most})::DOUBLE / {most}) END"
    told = f"""{tokens} || ' tokens, ' || printf('%.1f', duration_ms / 1000) || 's'"""
    rows = (
        ("no_wasted_calls", True, "n_wasted = 0", "CASE WHEN n_wasted > 0 THEN n_wasted || ' avoidable call(s): ' || wasted END", share("n_wasted", "n_calls")),
        ("valid_tool_args", True, "CASE WHEN n_args_checked > 0 THEN n_args_bad = 0 END",
         "CASE WHEN n_args_checked IS NULL THEN 'no schema matched' WHEN n_args_bad > 0 THEN n_args_bad || '/' || n_args_checked || ' calls with invalid arguments' END",
         f"CASE WHEN n_args_checked > 0 THEN {share('n_args_bad', 'n_args_checked')} ELSE 1.0 END"),
        ("no_tool_errors", False, "n_errors = 0", "CASE WHEN n_errors > 0 THEN n_errors || '/' || n_calls || ' tool calls errored' END", share("n_errors", "n_calls")),
        ("no_dead_ends", True, "n_empty::DOUBLE / n_calls <= 0.25",
         "CASE WHEN n_empty::DOUBLE / n_calls > 0.25 THEN n_empty || '/' || n_calls || ' calls returned nothing (' || empty_tools || ')' END", share("n_empty", "n_calls")),
        ("no_search_cascade", False, "n_cascades IS NULL",
         "n_cascades || ' cascade(s), longest ' || longest || 'x ' || string_split(worst_tool, '___')[-1]", share("coalesce(longest, 0)", "n_calls")),
        ("trajectory", True, "n_matched = n_wanted",
         "CASE WHEN n_wanted IS NULL THEN 'no expected actions' WHEN n_matched < n_wanted THEN 'missing ' || (n_wanted - n_matched) || ' step(s)' "
         "WHEN n_calls > n_matched THEN 'matched, ' || (n_calls - n_matched) || ' extra step(s)' ELSE 'exact' END", "coalesce(n_matched::DOUBLE / n_wanted, 1.0)"),
        ("no_truncation", False, "n_truncated = 0",
         "CASE WHEN n_truncated > 0 THEN n_truncated || ' tool result(s) truncated at 8192 chars' || CASE WHEN n_truncated_skills > 0 THEN ', skills: ' || n_truncated_skills ELSE '' END END",
         share("n_truncated", "n_calls")),
        ("cost_latency", False, f"{tokens} <= 4000 AND duration_ms <= 9000.0", told, f"least({over(tokens, 4000)}, {over('duration_ms', 9000.0)})"),
        ("evaluator_ready", False, "has_response AND has_definitions",
         "CASE WHEN NOT (has_response AND has_definitions) THEN 'missing ' || concat_ws(', ', CASE WHEN NOT has_response THEN 'response' END, CASE WHEN NOT has_definitions THEN 'definitions' END) END",
         "1 - (CAST(NOT has_response AS INT) + CAST(NOT has_definitions AS INT))::DOUBLE / 3"),
    )
    return " UNION ALL ".join(
        f"SELECT op_id, agent, '{name}' AS \"check\", {str(gating).lower()} AS gating, {passed} AS passed, {reason} AS reason, CAST({score} AS DOUBLE) AS score FROM facts{s}"
        for name, gating, passed, reason, score in rows
    )


def _scored(s: str = "") -> str:
    return f"scored{s} AS (SELECT op_id, agent, count(*) FILTER (gating AND NOT passed) = 0 AS passed FROM verdicts{s} GROUP BY op_id, agent)"


def _journal() -> str:
    made = lambda s: f"(SELECT *, row_number() OVER (PARTITION BY op_id ORDER BY ts, ord) - 1 AS seq, bare_tool || '|' || (k % 5) AS key FROM steps{s})"
    return f"""recd AS (SELECT *, row_number() OVER (PARTITION BY op_id, key ORDER BY seq) AS kth FROM {made('_b')}), sizes AS (SELECT op_id, key, count(*) AS n FROM recd GROUP BY ALL),
asked AS (SELECT *, row_number() OVER (PARTITION BY op_id, key ORDER BY seq) AS kth FROM {made('_a')}),
journal AS (SELECT 's' || a.op_id AS session, a.seq, a.tool, a.key, CASE WHEN n IS NULL THEN 'diverged' WHEN a.kth <= n THEN 'matched' ELSE 'repeated' END AS outcome,
  r.seq AS recorded_seq, coalesce(r.is_write, false) AS is_write
  FROM asked a LEFT JOIN sizes z ON a.op_id = z.op_id AND a.key = z.key LEFT JOIN recd r ON r.op_id = a.op_id AND r.key = a.key AND r.kth = least(a.kth, n))"""


def sql() -> dict[str, str]:
    one = lens.sql()
    daily = lens.sql(op=DAY_OP)
    halves = f"{lens.sql('_b', op=lens.USER_OP, where=f'ts < {lens.SPLIT}')}, {lens.sql('_a', op=lens.USER_OP, where=f'ts >= {lens.SPLIT}')}"
    both = f"WITH {halves}, {_facts('_b')}, {_facts('_a')}"
    hourly = f"{lens.sql('_b', op=lens.HOUR_OP, where=f'ts < {lens.SPLIT}')}, {lens.sql('_a', op=lens.HOUR_OP, where=f'ts >= {lens.SPLIT}')}"
    by_hour = f"WITH {hourly}, {_facts('_b')}, {_facts('_a')}"
    facts = f"WITH {one}, {_facts()}"
    played = f"WITH {halves}, {_journal()}"
    rate = "round(count(*) FILTER (passed)::DOUBLE / nullif(count(passed), 0), 6)"
    changes = """diff AS (SELECT a.op_id, a.agent, a."check", a.gating, CASE WHEN b.passed AND NOT a.passed THEN 'regression' WHEN NOT b.passed AND a.passed THEN 'fix'
      WHEN b.passed IS NOT NULL AND a.passed IS NULL THEN 'lost' END AS change FROM verdicts_a a JOIN verdicts_b b USING (op_id, agent, "check")),
    keys AS (SELECT coalesce(a.op_id, b.op_id) AS op_id, coalesce(a.agent, b.agent) AS agent, a.op_id IS NOT NULL AS now, b.op_id IS NOT NULL AS was
      FROM f_runs_a a FULL JOIN f_runs_b b ON a.op_id = b.op_id AND a.agent = b.agent)"""
    strict = """n AS (SELECT count(*) FILTER (now) AS scored, count(*) FILTER (NOT was) AS fresh, count(*) FILTER (NOT now) AS gone FROM keys),
      strict AS (SELECT 'no run was scored' AS reason, CAST(1 AS BIGINT) AS n FROM n WHERE scored = 0 UNION ALL SELECT 'scored without a baseline', fresh FROM n WHERE fresh > 0
      UNION ALL SELECT 'in the baseline, not scored', gone FROM n WHERE gone > 0 UNION ALL SELECT 'nothing was compared', fresh FROM n WHERE scored > 0 AND fresh = scored)"""
    found = {
        "steps_projection": f"WITH {one} SELECT op_id, agent, ord, bare_tool, error_kind, errored, empty, truncated FROM steps",
        "run_summary": f"""{facts} SELECT op_id, agent, {_time('started')} AS started, round(duration_ms, 4) AS duration_ms, round(tool_ms, 4) AS tool_ms, n_calls, n_errors, n_wasted, n_empty,
          n_truncated, n_truncated_skills, coalesce(wasted, '') AS wasted, coalesce(empty_tools, '') AS empty_tools FROM facts""",
        "run_counters": """WITH """ + one + """, r AS (SELECT op_id, agent, count(*) FILTER (errored) AS e FROM steps GROUP BY ALL), o AS (SELECT op_id, count(*) AS agents,
          count(*) FILTER (e > 0) AS bad FROM r GROUP BY ALL) SELECT count(*) AS operations, CAST(sum(agents) AS BIGINT) AS runs, count(*) FILTER (agents > 1) AS several_agents,
          CAST(sum(agents) AS BIGINT) AS runs_with_calls, CAST(sum(bad) AS BIGINT) AS runs_with_errors FROM o""",
        "trajectory_text": f"WITH {one} SELECT op_id, agent, string_agg(tool, ' -> ' ORDER BY ts, ord) AS trajectory FROM steps GROUP BY ALL",
        "gate_pass_rate": f"{facts}, {_scored()} SELECT agent, count(*) FILTER (passed) AS passed, count(*) AS total, {rate} AS rate FROM scored GROUP BY agent",
        "cascades": f"WITH {one}, {_cascades('')} SELECT op_id, agent, tool, length, first_ord FROM casc",
        "trajectory_prf": f"""{facts} SELECT op_id, agent, CAST(n_wanted AS BIGINT) AS n_wanted, CAST(n_matched AS BIGINT) AS n_matched, round(n_matched::DOUBLE / n_calls, 6) AS "precision",
          round(n_matched::DOUBLE / n_wanted, 6) AS recall, round(2 * n_matched::DOUBLE / (n_calls + n_wanted), 6) AS f1 FROM facts WHERE n_wanted IS NOT NULL""",
        "candidate_ranking": f"""WITH {one}, c AS (SELECT op_id, min(ts) AS started, string_agg(DISTINCT agent, ',' ORDER BY agent) AS agents, count(DISTINCT nullif(agent, '')) AS agent_count,
          count(*) AS spans, count(*) FILTER (name ILIKE 'execute\\_tool%' ESCAPE '\\') AS tool_calls, count(*) FILTER (definitions <> '') AS has_tool_defs FROM spans GROUP BY op_id),
          u AS (SELECT *, CASE WHEN agent_count > 1 AND tool_calls > 0 AND has_tool_defs > 0 THEN '1-full' WHEN tool_calls > 0 AND has_tool_defs > 0 THEN '2-single agent'
          WHEN tool_calls > 0 THEN '3-no tool defs' ELSE '4-thin' END AS usable FROM c WHERE tool_calls >= 3 ORDER BY usable, started DESC, op_id LIMIT 25)
          SELECT op_id, {_time('started')} AS started, agents, agent_count, spans, tool_calls, has_tool_defs, usable FROM u""",
        "clean_runs": f"""WITH {daily}, c AS (SELECT op_id, min(ts) AS started, count(DISTINCT agent) AS a, count(*) AS tool_calls, count(DISTINCT tool || '|' || arguments) AS d,
          count(*) FILTER (NOT success) AS f, count(*) FILTER (starts_with(result, '{{"error"') OR contains(result, '"isError":true')) AS e FROM spans GROUP BY op_id)
          SELECT op_id, {_time('started')} AS started, tool_calls FROM c WHERE a = 1 AND f = 0 AND e = 0 AND d = tool_calls AND tool_calls BETWEEN 1 AND 40""",
        "content_overlay_left_join": f"""WITH {one} SELECT ord, CASE WHEN ord % 3 = 0 AND k % 2 = 0 THEN 'a' || k ELSE arguments END AS arguments,
          CASE WHEN ord % 3 = 0 THEN 'r' || k ELSE result END AS result FROM spans""",
        "semi_join_ops": f"WITH {daily} SELECT op_id, count(*) AS spans FROM spans WHERE op_id IN (SELECT op_id FROM spans WHERE agent = 'agent1') GROUP BY op_id",
        "toolbox_first_seen": f"""WITH {one} SELECT op_id, agent, toolbox, version, row_number() OVER (PARTITION BY op_id, agent ORDER BY since_at) - 1 AS place FROM
          (SELECT op_id, agent, 'tb' || (k % 3) AS toolbox, CAST(k % 2 AS VARCHAR) AS version, min(ts) AS since_at FROM boxes GROUP BY ALL)""",
        "manifest_theta_join": f"""WITH {one}, b AS (SELECT op_id, agent, 'tb' || (k % 3) AS toolbox, CAST(k % 2 AS VARCHAR) AS version, min(ts) AS since_at FROM boxes GROUP BY ALL),
          m(box, v, tool) AS (VALUES ('tb0', '*', 'get'), ('tb0', '*', 'search'), ('tb1', '1', 'get'), ('tb1', '1', 'create'), ('tb2', '9', 'create')),
          j AS (SELECT op_id, agent, tool, 'manifest:' || toolbox || '@' || version AS source, row_number() OVER (PARTITION BY op_id, agent, tool ORDER BY since_at) AS r
          FROM b JOIN m ON box = toolbox AND (v = '*' OR v = version)) SELECT op_id, agent, tool, source FROM j WHERE r = 1""",
        "expectation_fallback": f"""WITH {one}, r AS (SELECT DISTINCT op_id, agent FROM spans), w AS (SELECT op_id, agent, CASE WHEN agent = 'agent1' THEN 'get,create'
          WHEN {lens.INTENT} = 'Full Triage' THEN 'load_skill,get,create' END AS want FROM r) SELECT op_id, agent, want FROM w WHERE want IS NOT NULL""",
        "inbound_intent": f"""WITH {one}, c AS (SELECT op_id, agent AS caller, min(ts) AS since FROM handoffs GROUP BY ALL),
          h AS (SELECT h.op_id, h.tool AS agent, CASE k WHEN 0 THEN 'Full Triage' WHEN 30 THEN 'Write Request' WHEN 40 THEN 'Explanation' END AS inbound,
          row_number() OVER (PARTITION BY h.op_id, h.tool ORDER BY since, ts) AS r FROM handoffs h JOIN c ON h.op_id = c.op_id AND h.agent = c.caller WHERE k IN (0, 10, 30, 40))
          SELECT op_id, agent, inbound FROM h WHERE r = 1""",
        "intent_sources": f"""WITH {one}, c AS (SELECT op_id, agent AS caller, min(ts) AS since, min(ord) AS m FROM handoffs GROUP BY ALL),
          h AS (SELECT h.op_id, h.tool AS agent, CASE k WHEN 0 THEN 'Full Triage' WHEN 30 THEN 'Write Request' WHEN 40 THEN 'Explanation' END AS inbound,
          row_number() OVER (PARTITION BY h.op_id, h.tool ORDER BY since, ts) AS r FROM handoffs h JOIN c ON h.op_id = c.op_id AND h.agent = c.caller WHERE k IN (0, 10, 30, 40)),
          d AS (SELECT op_id, agent, arg_min(CASE k WHEN 0 THEN 'Full Triage' WHEN 10 THEN 'Enrichment' WHEN 30 THEN 'Write Request' WHEN 40 THEN 'Explanation' END, (ts, ord)) AS delegated
          FROM handoffs WHERE k IN (0, 10, 30, 40) GROUP BY ALL),
          a AS (SELECT c.op_id, caller AS agent, CASE m % 5 WHEN 0 THEN 'Explanation' WHEN 1 THEN 'Full Triage' END AS declared, inbound, delegated FROM c
          LEFT JOIN h ON h.op_id = c.op_id AND h.agent = caller AND r = 1 LEFT JOIN d ON d.op_id = c.op_id AND d.agent = caller)
          SELECT op_id, agent, coalesce(declared, inbound, delegated) AS intent, concat_ws('|', agent, coalesce(declared, inbound, delegated)) AS traj_key,
          CASE WHEN declared IS NOT NULL THEN 'declared' WHEN inbound IS NOT NULL THEN 'inbound' WHEN delegated IS NOT NULL THEN 'delegated' ELSE 'unknown' END AS intent_source FROM a""",
        "run_details": f"""WITH {one}, {_cascades('')}, s AS (SELECT *, substr(arguments, 1, 200) AS cut FROM steps), g AS (SELECT b.op_id, b.agent, min(b.tool) AS tool, count(*) AS length, min(b.ord) AS first_ord,
          string_agg(cut, ';' ORDER BY b.ts, b.ord) AS args FROM casc_b b JOIN s USING (ord) WHERE bad GROUP BY b.op_id, b.agent, island HAVING count(*) >= 4),
          l AS (SELECT op_id, agent, 'tool_names' AS list, ts, ord, tool, NULL AS kind, NULL AS args FROM s UNION ALL SELECT op_id, agent, 'actions', ts, ord, tool, 'assistant', arguments FROM s
          UNION ALL SELECT op_id, agent, 'tool_errors', ts, ord, tool, error_kind, cut FROM s WHERE errored UNION ALL SELECT op_id, agent, 'empty_results', ts, ord, tool, NULL, cut FROM s WHERE empty
          UNION ALL SELECT op_id, agent, 'search_cascades', TIMESTAMP '2000-01-01', first_ord, tool, CAST(length AS VARCHAR), args FROM g)
          SELECT op_id, agent, list, row_number() OVER (PARTITION BY op_id, agent, list ORDER BY ts, ord) - 1 AS place, tool, kind, args FROM l""",
        "nested_schema": f"""WITH {one}, v AS (SELECT * FROM spans WHERE arguments <> 'nope'), a AS (SELECT 'call' AS path, 'object' AS type FROM v
          UNION ALL SELECT 'call/k', CASE WHEN arguments LIKE '%"x"%' THEN 'string' ELSE 'integer' END FROM v WHERE arguments LIKE '%"k"%' UNION ALL SELECT 'call/z', 'integer' FROM v WHERE arguments LIKE '%"z"%'
          UNION ALL SELECT 'at', CASE WHEN ord % 2 = 0 THEN 'object' ELSE 'null' END FROM v UNION ALL SELECT unnest(['more', 'more/deep']), 'object' FROM v
          UNION ALL SELECT 'more/deep/n', 'integer' FROM v UNION ALL SELECT 'more/deep/o', CASE WHEN ord % 3 = 0 THEN 'number' ELSE 'array' END FROM v)
          SELECT path, string_agg(DISTINCT type, ',' ORDER BY type) AS types, bool_and(type <> 'null') AS required, count(*) AS n FROM a GROUP BY path""",
        "usage_fallback": f"WITH {one} {_usage('')}",
        "pick_run_span": f"""WITH {one} SELECT op_id, agent, ord FROM (SELECT *, row_number() OVER (PARTITION BY op_id, agent ORDER BY starts_with(name, 'invoke_agent') DESC, k % 4 DESC, ts) AS r
          FROM chats) WHERE r = 1""",
        "longest_definitions": f"""WITH {one} SELECT op_id, agent, definitions FROM (SELECT *, row_number() OVER (PARTITION BY op_id, agent ORDER BY length(definitions) DESC, ts) AS r
          FROM spans WHERE definitions <> '') WHERE r = 1""",
        "skill_hashes": f"""WITH {one} SELECT op_id, agent, ord, CASE WHEN errored THEN '' ELSE 'skill' || (k % 5) END AS skill_name, sha256(result) AS sha256, length(result) AS chars, errored
          FROM steps WHERE bare_tool = 'load_skill'""",
        "skill_drift": f"""WITH {one}, s AS (SELECT DISTINCT 'skill' || (k % 5) AS skill_name, substr(sha256(result), 1, 12) AS h FROM steps WHERE bare_tool = 'load_skill' AND NOT errored)
          SELECT skill_name, count(*) AS versions, string_agg(h, ',' ORDER BY h) AS hashes FROM s GROUP BY skill_name HAVING count(*) > 1""",
        "arg_validation": f"WITH {one} {_args('')}",
        "arg_problems": f"WITH {one} SELECT tool, problem, count(*) AS n FROM (" + " UNION ALL ".join(
            f"SELECT bare_tool AS tool, '{name}' AS problem FROM steps WHERE bare_tool IN ('get', 'search', 'create') AND {test}" for name, test in PROBLEMS
        ) + ") GROUP BY ALL",
        "score_rates": f"""{facts} SELECT "check", gating, count(*) FILTER (passed) AS passed, count(passed) AS applied, count(*) FILTER (passed IS NULL) AS skipped, {rate} AS rate
          FROM verdicts GROUP BY ALL""",
        "thresholds": f"""{facts} SELECT "check", {rate} AS rate FROM verdicts WHERE gating GROUP BY "check" HAVING {rate} < 0.9""",
        "overall_rate": f"{facts}, {_scored()} SELECT count(*) FILTER (passed) AS passed, count(*) AS total, coalesce({rate}, 0.0) AS rate FROM scored",
        "not_scored": f"""{facts} SELECT "check", reason, count(*) AS n FROM verdicts WHERE passed IS NULL GROUP BY ALL""",
        "tracking_rollup": f"""{facts} SELECT agent, count(*) AS runs, CAST(sum(n_calls) AS BIGINT) AS calls, CAST(sum(uncached_input_tokens) AS BIGINT) AS uncached_input_tokens,
          CAST(sum(output_tokens) AS BIGINT) AS output_tokens, max(peak_input_tokens) AS peak_input_tokens, round(max(duration_ms), 4) AS longest_ms FROM facts GROUP BY ROLLUP (agent)""",
        "baseline_diff": f"""{both}, {changes} SELECT op_id, agent, "check", change FROM diff WHERE change IS NOT NULL
          UNION ALL SELECT op_id, agent, NULL, CASE WHEN now THEN 'new' ELSE 'missing' END FROM keys WHERE NOT (now AND was)""",
        "strict_failures": f"{by_hour}, {changes}, {strict} SELECT reason, n FROM strict",
        "gate_decision": f"""{by_hour}, {changes}, {strict}, h AS (SELECT count(*) AS held_back FROM diff WHERE gating AND change IN ('regression', 'lost')), s AS (SELECT count(*) AS strict FROM strict)
          SELECT held_back, strict, held_back = 0 AND strict = 0 AS passed FROM h, s""",
        "cassette_interactions": f"""WITH {one} SELECT op_id, row_number() OVER (PARTITION BY op_id ORDER BY ts, ord) - 1 AS seq, agent, tool, bare_tool || '|' || replace(arguments, ' ', '') AS key,
          error_kind, is_write, truncated FROM steps""",
        "cassette_headers": f"""WITH {one}, a AS (SELECT op_id, agent, min(ts) AS since_at, count(*) AS n, bool_or(truncated) AS lossy FROM steps GROUP BY ALL)
          SELECT op_id, string_agg(agent, ',' ORDER BY since_at) AS agents, CAST(sum(n) AS BIGINT) AS interactions, bool_or(lossy) AS lossy FROM a GROUP BY op_id""",
        "cassette_replay": f"{played} SELECT session, seq, key, outcome, recorded_seq, is_write FROM journal",
        "matched_prefix": f"{played} SELECT session, coalesce(min(seq) FILTER (outcome = 'diverged'), count(*)) AS matched_prefix FROM journal GROUP BY session",
        "journal_summary": f"""{played} SELECT session, count(*) AS calls, count(*) FILTER (outcome = 'matched') AS matched, count(*) FILTER (outcome = 'repeated') AS repeated,
          count(*) FILTER (outcome = 'diverged') AS diverged, count(*) FILTER (is_write) AS writes, coalesce(min(seq) FILTER (outcome = 'diverged'), count(*)) AS matched_prefix,
          arg_min(key, seq) FILTER (outcome = 'diverged') AS first_divergence FROM journal GROUP BY session""",
        "journal_counts": f"{played} SELECT session, string_split(tool, '___')[-1] AS tool, count(*) AS n FROM journal WHERE outcome = 'diverged' GROUP BY ALL",
        "local_tools": f"""WITH {one} SELECT DISTINCT agent, tool FROM steps WHERE NOT contains(tool, '___') AND NOT is_write
          UNION SELECT DISTINCT agent, 'tool_search' FROM steps""",
        "relabel_not_recorded": f"""WITH {one}, e AS (SELECT error_kind, row_number() OVER w AS r, count(*) OVER (PARTITION BY op_id, agent, bare_tool, error_kind) AS n FROM steps WHERE errored
          WINDOW w AS (PARTITION BY op_id, agent, bare_tool, error_kind ORDER BY ts, ord))
          SELECT CASE WHEN error_kind = 'empty_failed' AND r <= ceil(n / 2.0) THEN 'not_recorded' ELSE error_kind END AS error_kind, count(*) AS n FROM e GROUP BY 1""",
        "dataset_rows": f"""WITH {one}, s AS (SELECT *, row_number() OVER (PARTITION BY op_id, agent ORDER BY ts, ord) - 1 AS i FROM steps), n AS (SELECT *, coalesce(nullif(call_id, ''), 'call_' || i) AS id FROM s)
          SELECT op_id, agent, 2 * i AS place, 'assistant' AS role, id AS call_id, 'tool_call' AS type, tool AS name, length(arguments) AS chars FROM n
          UNION ALL SELECT op_id, agent, 2 * i + 1, 'tool', id, 'tool_result', tool, length(result) FROM n""",
        "dataset_round_trip": f"WITH {one} SELECT agent, count(*) FILTER (errored) AS errors, count(*) FILTER (empty) AS empty, count(*) FILTER (truncated) AS truncated FROM steps GROUP BY agent",
        "port_scores": f"""{facts} SELECT "check", count(*) AS n, count(*) FILTER (score >= CASE WHEN "check" = 'no_dead_ends' THEN 0.75 ELSE 1.0 END) AS reached, round(avg(score), 6) AS score
          FROM verdicts GROUP BY "check" """,
        "schema_inference": f"""WITH {one}, a AS (SELECT 'k' AS name, CASE WHEN arguments LIKE '%"x"%' THEN 'string' ELSE 'integer' END AS type FROM spans WHERE arguments LIKE '%"k"%'
          UNION ALL SELECT 'z', 'integer' FROM spans WHERE arguments LIKE '%"z"%')
          SELECT name, string_agg(DISTINCT type, ',' ORDER BY type) AS types, true AS required, count(*) AS n FROM a GROUP BY name""",
        "pseudonym_tokens": f"""SELECT key, 'EMAIL' AS kind, 'EMAIL_' || substr(sha256('{SALT}' || key), 1, 8) AS token FROM
          (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\\w.+-]+@[\\w-]+\\.[\\w.-]+'))) AS key FROM documents)""",
        "email_redaction": f"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '[\\w.+-]+@[\\w-]+\\.[\\w.-]+') AS found FROM documents)
          SELECT doc_id, array_to_string(list_transform(found, lambda x: 'EMAIL_' || substr(sha256('{SALT}' || lower(x)), 1, 8)), ',') AS tokens, false AS "left" FROM m WHERE len(found) > 0""",
        "phone_redaction": rf"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?:^|[^\pL\pN_.])((?:\+?[0-9]{{1,3}}[\s-]?)?(?:\\?\([0-9]{{3}}\\?\)|[0-9]{{3}})[\s.-]?[0-9]{{3}}[\s.-]?[0-9]{{4}})(?:$|[^\pL\pN_.]|\.(?:$|[^0-9]))', 1) AS found FROM documents)
          SELECT doc_id, array_to_string(list_transform(found, lambda x: 'PHONE_' || substr(sha256('{SALT}' || lower(x)), 1, 8)), ',') AS tokens, 0 AS "left" FROM m WHERE len(found) > 0""",
        "residual_check": r"""SELECT literal, count(*) AS n FROM conversations, (VALUES ('the and'), ('la'), ('DER'), ('nowhere-at-all')) l(literal)
          WHERE regexp_matches(text, '(?i)(^|[^\pL\pN_])' || literal || '([^\pL\pN_]|$)') GROUP BY literal""",
        "watermark_window": f"""WITH {one}, d AS (SELECT DISTINCT op_id FROM spans WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11')
          SELECT op_id, count(*) AS spans, {_time('max(ts)')} AS newest FROM spans WHERE op_id IN (SELECT op_id FROM d) AND ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-12' GROUP BY op_id""",
        "stream_sessions": f"{played} SELECT session, seq, key, outcome FROM journal",
    }
    checks = {
        "wasted_calls": "no_wasted_calls", "dead_end_rate": "no_dead_ends", "error_rate": "no_tool_errors", "cascade_check": "no_search_cascade",
        "trajectory": "trajectory", "truncation": "no_truncation", "cost_latency": "cost_latency", "valid_tool_args": "valid_tool_args", "evaluator_ready": "evaluator_ready",
    }
    found |= {n: f"""{facts} SELECT op_id, agent, passed, reason, round(score, 6) AS score FROM verdicts WHERE "check" = '{c}'""" for n, c in checks.items()}
    return found | _attribution()


def _attribution() -> dict[str, str]:
    """Written from the rules: a replay without a run fails for that; else for all that was not the recording's, then for the first thing
    that its routing can't be told from; and those that are well are taken in order, each with one baseline, a free run and a free recording."""
    wait = ("no scored run yet", "content is not ingested yet", "journalled calls are not ingested yet")
    base = f"""WITH RECURSIVE u AS (SELECT DISTINCT user_id AS u, user_id - user_id % 8 + user_id % 8 // 2 AS run, user_id - user_id % 8 + (user_id % 8 + 1) // 2 AS rec FROM events),
    called AS (SELECT DISTINCT user_id AS run, true AS called FROM events WHERE event_id % 2 = 0 AND event_type <> 'signup'),
    f AS (SELECT u, run, rec, printf('r%06d', u) AS replay,
      CASE WHEN u % 31 = 0 THEN ['the manifest lacks a field'] WHEN run % 7 = 0 THEN ['no scored run yet'] ELSE list_filter([
        CASE WHEN run % 11 = 0 THEN 'the run called other agents' END, CASE WHEN run % 15 = 0 THEN 'other agents ran in the operation' END,
        CASE WHEN run % 41 = 0 THEN 'the run used another toolbox' END,
        CASE WHEN u % 17 = 0 THEN 'the manifest has no local tools' WHEN run % 13 = 0 THEN 'content is not ingested yet' WHEN u % 19 = 0 THEN 'the server did not see the session'
          WHEN u % 23 = 0 THEN 'the manifest has no journal' WHEN called AND u % 29 = 0 AND u % 37 <> 0 THEN 'calls that the server never saw'
          WHEN called AND u % 37 = 0 THEN 'journalled calls are not ingested yet' END
        ], lambda x: x IS NOT NULL) END AS early, CASE WHEN rec % 12 = 0 THEN 0 WHEN rec % 13 = 0 THEN 2 ELSE 1 END AS hits FROM u LEFT JOIN called USING (run)),
    g AS (SELECT DISTINCT u // 8 AS b, CAST(-1 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS runs, CAST([] AS BIGINT[]) AS recs FROM u
      UNION ALL SELECT g.b, g.place + 1,
        CASE WHEN len(early) = 0 AND hits = 1 AND NOT list_contains(runs, run) AND NOT list_contains(recs, rec) THEN list_append(runs, run) ELSE runs END,
        CASE WHEN len(early) = 0 AND hits = 1 AND NOT list_contains(runs, run) AND NOT list_contains(recs, rec) THEN list_append(recs, rec) ELSE recs END
      FROM g LEFT JOIN f ON f.u // 8 = g.b AND f.u % 8 = g.place + 1 WHERE g.place < 7),
    a AS (SELECT replay, CASE WHEN len(early) > 0 THEN early WHEN list_contains(runs, run) THEN ['the run is attributed to another replay']
      WHEN list_contains(recs, rec) THEN ['the recording is replayed twice'] WHEN hits = 0 THEN ['no baseline'] WHEN hits > 1 THEN ['several baselines'] ELSE [] END AS failures
      FROM f JOIN g ON f.u // 8 = g.b AND f.u % 8 = g.place + 1),
    o AS (SELECT replay, failures, len(list_filter(failures, lambda x: list_contains({list(wait)}, x))) AS again FROM a)"""
    return {
        "attributed_replays": f"""{base} SELECT replay, failures[1] AS failure, array_to_string(failures, '; ') AS failures, CASE WHEN len(failures) > 0 THEN again = len(failures) END AS retryable,
          CASE WHEN len(failures) = 0 THEN 'b1' END AS file FROM o""",
        "attribution_exit": f"{base} SELECT CAST(CASE WHEN sum(len(failures)) = 0 THEN 0 WHEN sum(len(failures)) = sum(again) THEN 3 ELSE 1 END AS BIGINT) AS exit_code FROM o",
    }
