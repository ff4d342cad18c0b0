"""DuckDB SQL for the queries of ``plans.queries``."""

from __future__ import annotations

from ..operators.estimate import question_tokens
from ..operators.judge import CATEGORY, COMPONENT, ERROR, MODEL, NOISE, NOULS, PACK, ROOT_CAUSE, SYMPTOM, USER, WEIRD
from ..sources.questions import BUILT_IN, checked
from .queries import LOGS, RUNBOOKS, TOPOLOGY

EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
IPV4 = r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"
RANK = "CASE level WHEN 'TRACE' THEN 0 WHEN 'DEBUG' THEN 1 WHEN 'INFO' THEN 2 WHEN 'WARN' THEN 3 WHEN 'ERROR' THEN 4 ELSE 5 END"


def iso(c: str) -> str:
    us = f"(epoch_us({c}) % 1000000)"
    return f"(strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} = 0 THEN '' ELSE '.' || lpad(CAST({us} AS VARCHAR), 6, '0') END || '+00:00')"


def hits(text: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, '{w}') AS INTEGER)" for w in words) + ")" if words else "0"


_logs = LOGS.replace("{text}", "VARCHAR").replace("{events}", "events")
_lines = f"""logs AS ({_logs}),
s AS (SELECT *, regexp_replace(body, '{EMAIL}', '<EMAIL>', 'g') AS scrubbed, len(regexp_extract_all(body, '{EMAIL}')) AS n_email FROM logs),
m AS (SELECT *, regexp_replace(scrubbed, '[0-9]+', '<NUM>', 'g') AS template, {RANK} AS rnk FROM s),
lines AS (SELECT *, substr(sha1(service || chr(0) || template), 1, 16) AS template_id FROM m)"""
WITH = f"WITH {_lines} "
_name = "['TRACE','DEBUG','INFO','WARN','ERROR','FATAL'][max(rnk) + 1]"

_hour = "template_id || '-' || strftime(ts, '%Y%m%d%H')"
_first = lambda v, n: f"(SELECT tid, v, row_number() OVER (PARTITION BY tid ORDER BY sq, v) AS position FROM (SELECT tid, {v} AS v, min(seq) AS sq FROM h GROUP BY tid, {v}) QUALIFY position <= {n})"
_state = (
    """'{"service":"' || service || '","level":"' || level || '","template":"' || template || '","occurrences":' || count || ',"first_seen":"' || """
    + iso("first_seen") + """ || '","last_seen":"' || """ + iso("last_seen") + """ || '","examples":[' || ex || ']}'"""
)
_sum = lambda d, f: " + ".join(f"{f(i)}" for i in range(d))


def _scores(scores: list[tuple[str, str]]) -> str:
    return "[" + ", ".join(f"CAST({v} AS DOUBLE)" for _, v in scores) + "]"


def _raised(c: str, t: str = "1e0") -> str:
    """exp of the scores in the list column c, less their largest."""
    return f"list_transform({c}, lambda x: exp((x - list_max({c})) / {t}))"


def _shares(c: str) -> str:
    return f"list_transform({c}, lambda x: round(x / list_sum({c}), 6))"


_category = [(k, f"2e0 * {hits('low', w)}") for k, w in CATEGORY.items() if k != "none"] + [("none", "(15e-1 + 2e0 * least(noise, 2) - 1e0 * greatest(rnk - 2, 0) - 5e-1 * err)")]
_component = [(k, "1e0" if k == "application" else f"15e-1 * {hits('low', w)}") for k, w in COMPONENT.items()]
_level = lambda n, c: [(str(i), f"(-abs({i} - least(greatest({c}, 0e0), {n - 1}e0)) * 16e-1)") for i in range(n)]
_logit = "(-26e-1 + 11e-1 * greatest(rnk - 2, 0) + 7e-1 * least(err, 3) - 16e-1 * least(noise, 2) + 3e-1 * least(rc, 2))"
_sig = lambda x: f"(1e0 / (1e0 + exp(-({x}))))"
_noul = lambda p: f"round(least(greatest({p}, 1e-2), 99e-2), 4)"
_best = lambda d, names: "[" + ", ".join(f"'{k}'" for k in names) + f"][list_position({d}, list_max({d}))]"
_exp = lambda d, n: "(0e0 + " + " + ".join(f"{i} * {d}[{i + 1}]" for i in range(n)) + ")"

_judged = f"""{_lines},
h AS (SELECT *, {_hour} AS tid FROM lines),
agg AS (SELECT tid, any_value(template_id) AS base, service, template, {_name} AS level, max(rnk) AS rnk, count(*) AS count, min(ts) AS first_seen, max(ts) AS last_seen, sum(n_email) AS n_email FROM h GROUP BY tid, service, template),
exs AS (SELECT tid, string_agg('"' || v || '"', ',' ORDER BY position) AS ex FROM {_first('scrubbed', 3)} GROUP BY tid),
trs AS (SELECT tid, list(v ORDER BY position) AS traces FROM {_first('trace_id', 5)} GROUP BY tid),
st AS MATERIALIZED (SELECT *, {_state} AS state FROM agg JOIN exs USING (tid) JOIN trs USING (tid)),
f AS (SELECT *, lower(state) AS low FROM st),
feat AS MATERIALIZED (SELECT *, {hits('low', NOISE)} AS noise, {hits('low', ERROR)} AS err, {hits('low', ROOT_CAUSE)} AS rc, {hits('low', SYMPTOM)} AS sym, {hits('low', USER)} AS usr, {hits('low', WEIRD)} AS weird FROM f),
sco AS MATERIALIZED (SELECT *, {_scores(_category)} AS s1, {_scores(_component)} AS s2,
  {_scores(_level(5, "([0e0,0e0,0e0,1e0,2e0,34e-1][rnk + 1] + 4e-1 * least(rc, 2) - 8e-1 * least(noise, 2) + CASE WHEN count > 500 THEN 4e-1 ELSE 0e0 END)"))} AS s3,
  {_scores(_level(4, "(8e-1 * greatest(rnk - 2, 0) + 6e-1 * least(usr, 2) - 8e-1 * least(noise, 2))"))} AS s4 FROM feat),
rai AS MATERIALIZED (SELECT *, {_raised('s1')} AS e1, {_raised('s2')} AS e2, {_raised('s3')} AS e3, {_raised('s4')} AS e4 FROM sco),
dist AS MATERIALIZED (SELECT *, {_shares('e1')} AS d_category, {_shares('e2')} AS d_component, {_shares('e3')} AS d_severity, {_shares('e4')} AS d_impact,
  {_noul(_sig(_logit))} AS p_actionable, {_noul(_sig(f"-{_logit} - 6e-1 + 9e-1 * least(noise, 2)"))} AS p_benign,
  {_noul("CASE WHEN rnk < 3 AND err = 0 THEN 5e-2 ELSE " + _sig("-4e-1 + 12e-1 * least(rc, 2) - 13e-1 * least(sym, 2)") + " END")} AS p_root_cause,
  {_noul(_sig("-24e-1 + 13e-1 * weird + 5e-1 * greatest(rnk - 3, 0) - 8e-1 * least(noise, 2)"))} AS p_novel, 3e-2 AS p_sensitive FROM rai),
judged AS MATERIALIZED (SELECT *, tid AS template_key, {_best('d_category', [k for k, _ in _category])} AS category, {_best('d_component', [k for k, _ in _component])} AS component,
  {_exp('d_severity', 5)} AS severity, {_exp('d_impact', 4)} AS impact, d_severity[4] + d_severity[5] AS p_severe FROM dist),
routed AS MATERIALIZED (SELECT *, round(p_actionable * (1 + severity) * (1 + p_novel) * ln(1e0 + count), 4) AS priority,
  CASE WHEN p_benign >= 95e-2 AND p_actionable <= 1e-1 AND level NOT IN ('ERROR', 'FATAL') AND (regexp_matches(lower(template), 'health|heartbeat|readyz|livez|cache hit|metrics') OR count >= 20) THEN 'suppress'
    WHEN p_actionable >= 6e-1 AND (p_novel >= 5e-1 OR severity >= 25e-1) THEN 'escalate' WHEN p_actionable >= 6e-1 THEN 'triage'
    WHEN abs(p_actionable - 6e-1) <= 1e-1 OR abs(p_benign - 95e-2) <= 1e-1 THEN 'review' ELSE 'monitor' END AS decision,
  CASE WHEN n_email > 0 THEN 'scrubbed' ELSE '' END AS flags FROM judged)"""
JUDGED = f"WITH {_judged} "

_top = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TOPOLOGY) + ")"
_tok = lambda c: f"list_distinct(regexp_extract_all(lower({c}), '[a-z][a-z0-9_]+'))"
_scored = f"""{_judged},
topo AS (SELECT col0 AS x, col1 AS y FROM {_top} UNION SELECT col1, col0 FROM {_top}),
surf AS (SELECT * FROM routed WHERE decision IN ('escalate', 'triage', 'review')),
allpairs AS (SELECT a.tid AS ai, b.tid AS bi, a.priority + b.priority AS pp, (epoch_us(b.first_seen) - epoch_us(a.first_seen)) / 1e6 AS gap, a.template AS tma, b.template AS tmb, a.traces AS ax, b.traces AS bx, a.service AS sa, b.service AS sb
  FROM surf a JOIN surf b ON epoch_us(b.first_seen) - epoch_us(a.first_seen) BETWEEN 0 AND 600000000 AND a.tid <> b.tid
    AND (b.first_seen > a.first_seen OR a.priority > b.priority OR (a.priority = b.priority AND a.tid < b.tid))
  WHERE a.service = b.service OR EXISTS (SELECT 1 FROM topo WHERE x = a.service AND y = b.service)),
scored AS (SELECT *, {_noul(f"8e-2 + 55e-2 * (len(list_intersect({_tok('tma')}, {_tok('tmb')})) / CAST(len(list_distinct(list_concat({_tok('tma')}, {_tok('tmb')}))) AS DOUBLE)) + CASE WHEN len(list_intersect(ax, bx)) > 0 THEN 35e-2 ELSE 0e0 END + CASE WHEN abs(round(gap, 1)) < 120 THEN 15e-2 ELSE 0e0 END + CASE WHEN sa = sb THEN 1e-1 ELSE 0e0 END")} AS p_same FROM allpairs)"""
_edge = lambda of: f"edge AS (SELECT ai AS u, bi AS v FROM {of} WHERE p_same >= 6e-1 UNION SELECT bi, ai FROM {of} WHERE p_same >= 6e-1)"
_pairs = f"""{_scored},
top2000 AS (SELECT * FROM scored ORDER BY pp DESC, ai, bi LIMIT 2000),
{_edge('top2000')}"""
PAIRS = f"WITH {_pairs} "
_grouped = """reach AS (SELECT tid AS node, tid AS root FROM surf UNION SELECT e.v, r.root FROM reach r JOIN edge e ON e.u = r.node),
comp AS (SELECT node, min(root) AS group_id FROM reach GROUP BY node),
ids AS (SELECT group_id, 'inc-' || substr(sha1(string_agg(node, '' ORDER BY node)), 1, 10) AS incident_id FROM comp GROUP BY group_id),
mem AS (SELECT surf.*, comp.group_id, incident_id FROM surf JOIN comp ON node = tid JOIN ids USING (group_id))"""
_members = f"{_pairs},\n{_grouped}"
MEMBERS = f"WITH RECURSIVE {_members} "
_all_members = f"{_scored},\n{_edge('scored')},\n{_grouped}"  # from all candidate pairs
ALL_MEMBERS = f"WITH RECURSIVE {_all_members} "
_changes = """SELECT CAST(event_id AS VARCHAR) AS change_id, ts, CASE user_id % 5 WHEN 0 THEN 'edge' WHEN 1 THEN 'cart' WHEN 2 THEN 'billing' WHEN 3 THEN 'login' ELSE 'stock' END AS service,
  concat('deploy of release ', event_id, ' for upstream call') AS summary FROM events WHERE event_type = 'signup' AND event_id % 50 = 0"""
_linked = f"""ch AS ({_changes}),
lk AS (SELECT incident_id, change_id, tid, priority, round((epoch_us(first_seen) - epoch_us(ch.ts)) / 6e7, 1) AS minutes, ch.service = mem.service AS same, len(list_intersect({_tok('summary')}, {_tok('template')})) AS ov
  FROM mem JOIN ch ON epoch_us(first_seen) - epoch_us(ch.ts) BETWEEN 0 AND 3600000000),
sc AS (SELECT *, {_noul("8e-2 + CASE WHEN same THEN 45e-2 ELSE 0e0 END + CASE WHEN minutes BETWEEN 0 AND 30 THEN 25e-2 WHEN minutes <= 120 THEN 1e-1 ELSE -5e-2 END + least(2e-1, 7e-2 * ov)")} AS p FROM lk)"""
_links = f"{_members}, {_linked}"
LINKS = f"WITH RECURSIVE {_links} "
ALL_LINKS = f"WITH RECURSIVE {_all_members}, {_linked} "
_golden = "g AS (SELECT doc_id, quality = 1 AS y, (n_chars % 997) / 996e0 AS p, n_chars, quality FROM labels JOIN documents USING (doc_id))"
_bins = f"{_golden}, b AS (SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 4) AS mean_p, round(avg(CAST(y AS DOUBLE)), 4) AS observed FROM g GROUP BY 1)"
_choice = f"""{_golden}, c AS (SELECT doc_id AS seq, ['timeout','auth','config'][n_chars % 3 + 1] AS label, ['timeout','auth','config'][(n_chars + quality * (n_chars % 2)) % 3 + 1] AS pred, p FROM g)"""
_decided = f"{_golden}, r AS (SELECT ['suppress','escalate','triage','monitor','review'][n_chars % 5 + 1] AS decision, CASE WHEN n_chars % 7 <> 0 THEN quality = 1 END AS actionable FROM g), q AS (SELECT * FROM r WHERE actionable IS NOT NULL)"
_dec = f"""{_judged}, dec AS (SELECT *, date_trunc('hour', first_seen) AS window_start, strftime(first_seen, '%Y%m%d') AS run_id, base AS template_id FROM routed)"""
DEC = f"WITH {_dec} "
_qt = question_tokens(checked(BUILT_IN))
_docs = lambda p, name: f"SELECT doc_id, CAST(n AS BIGINT) AS {name} FROM (SELECT doc_id, len(regexp_extract_all(text, '{p}')) AS n FROM documents) WHERE n > 0"
_cache = f"{_lines}, t AS (SELECT DISTINCT template_id AS subject_id, length(template) AS n FROM lines)"
_guess = "CASE WHEN contains(u, 'FATAL') THEN 'FATAL' WHEN contains(u, 'ERROR') THEN 'ERROR' WHEN contains(u, 'WARN') THEN 'WARN' WHEN contains(u, 'DEBUG') THEN 'DEBUG' ELSE 'INFO' END"
_rb = [(k, " + ".join(f"CAST(list_contains({_tok('template')}, '{w}') AS INTEGER)" for w in sorted(set(__import__("re").findall("[a-z][a-z0-9_]+", f"{k} {v}".lower()))))) for k, v in (RUNBOOKS | {"none": "None of the listed runbooks fits."}).items()]

ORACLE: dict[str, str] = {
    "scan_jsonl": f"SELECT seq, ts, service, level, body, trace_id FROM ({_logs})",
    "scan_plaintext": f"SELECT seq, 'unknown' AS service, {_guess} AS level, line AS body, CAST(NULL AS VARCHAR) AS trace_id FROM (SELECT seq, line, upper(line) AS u FROM (SELECT seq, CASE WHEN seq % 2 = 0 THEN level || ' ' ELSE '' END || body AS line FROM ({_logs})))",
    "key_synonyms": f"SELECT seq, CASE WHEN seq % 2 = 0 THEN service ELSE 'n' END AS service, CASE WHEN seq % 2 = 0 THEN level ELSE 'INFO' END AS level FROM ({_logs})",
    "guess_level": f"SELECT {_guess} AS guessed, count(*) AS n FROM (SELECT upper(CASE WHEN seq % 3 = 0 THEN lower(level) || ' ' ELSE '' END || body) AS u FROM ({_logs})) GROUP BY 1",
    "normalize_level": """SELECT raw, level, rank, count(*) AS n FROM (SELECT event_id % 8 + 1 AS i FROM events) JOIN (VALUES (1, 'warning', 'WARN', 3), (2, 'Critical', 'FATAL', 5), (3, 'err', 'INFO', 2), (4, '', 'INFO', 2), (5, 'fatal', 'FATAL', 5), (6, 'NOTICE', 'INFO', 2), (7, ' error', 'INFO', 2), (8, 'debug', 'DEBUG', 1)) t(i, raw, level, rank) USING (i) GROUP BY 1, 2, 3""",
    "parse_ts": "SELECT event_id AS seq, date_trunc('second', ts) AS ts FROM events",
    "scrub_email": _docs(EMAIL, "n_email"),
    "scrub_ipv4": _docs(IPV4, "n_ipv4"),
    "scrub_all": WITH + "SELECT seq, scrubbed, CAST(n_email AS BIGINT) AS n_email, CASE WHEN n_email > 0 THEN 1 ELSE 0 END AS kinds FROM lines",
    "mask": WITH + "SELECT seq, template AS masked FROM lines",
    "tokenize": WITH + "SELECT seq, len(string_split(template, ' ')) AS n_tokens, replace(template, ' ', '|') AS tokens FROM lines",
    "template_hash": WITH + "SELECT DISTINCT service, template, template_id FROM lines",
    "word_tokens": WITH + f"SELECT DISTINCT template, array_to_string(list_sort({_tok('template')}), ' ') AS words FROM lines",
    "drain_bucket": WITH + ", t AS (SELECT service, string_split(template, ' ') AS t FROM lines) SELECT service, len(t) AS n_tokens, CASE WHEN regexp_matches(t[1], '[0-9]') OR t[1] LIKE '<%' THEN '<*>' ELSE t[1] END AS k1, CASE WHEN regexp_matches(t[2], '[0-9]') OR t[2] LIKE '<%' THEN '<*>' ELSE t[2] END AS k2, count(*) AS lines FROM t GROUP BY 1, 2, 3, 4",
    "token_similarity": WITH + ", t AS (SELECT DISTINCT template, string_split(template, ' ') AS t FROM lines) SELECT a.template AS a, b.template AS b, round(len(list_filter(list_zip(a.t, b.t), lambda z: z[1] = z[2] AND z[1] <> '<*>')) / CAST(len(a.t) AS DOUBLE), 6) AS similarity FROM t a JOIN t b ON len(a.t) = len(b.t) AND a.template <= b.template",
    "drain_templates": WITH + "SELECT service, template_id, template, count(*) AS lines FROM lines GROUP BY ALL",
    "cluster_agg": WITH + f"SELECT template_id, service, template, {_name} AS level, count(*) AS count, min(ts) AS first_seen, max(ts) AS last_seen, min(seq) AS first_seq FROM lines GROUP BY 1, 2, 3",
    "level_counts": WITH + "SELECT template_id, level, count(*) AS lines FROM lines GROUP BY 1, 2",
    "first_examples": WITH + "SELECT template_id, CAST(row_number() OVER (PARTITION BY template_id ORDER BY sq) AS INTEGER) AS position, scrubbed FROM (SELECT template_id, scrubbed, min(seq) AS sq FROM lines GROUP BY 1, 2) QUALIFY position <= 3",
    "first_traces": WITH + "SELECT template_id, CAST(row_number() OVER (PARTITION BY template_id ORDER BY sq) AS INTEGER) AS position, trace_id FROM (SELECT template_id, trace_id, min(seq) AS sq FROM lines GROUP BY 1, 2) QUALIFY position <= 5",
    "sensitive_hits": WITH + "SELECT template_id, 'EMAIL' AS kind, CAST(sum(n_email) AS BIGINT) AS hits FROM lines WHERE n_email > 0 GROUP BY 1",
    "reduction_ratio": WITH + "SELECT count(*) AS lines, count(DISTINCT template_id) AS clusters, count(*) FILTER (n_email > 0) AS scrubbed_lines, count(*) / CAST(count(DISTINCT template_id) AS DOUBLE) AS reduction_ratio FROM lines",
    "tumbling_window": WITH + "SELECT date_trunc('hour', ts) AS window_start, service, count(*) AS lines FROM lines GROUP BY 1, 2",
    "keyword_features": JUDGED + "SELECT tid AS template_id, rnk AS rank, noise, err, rc, sym, usr, weird FROM feat",
    "state_text": JUDGED + "SELECT tid AS template_id, state FROM st",
    "p_nouls": JUDGED + f"SELECT tid AS template_id, {', '.join('p_' + k for k in NOULS)} FROM judged",
    "category_choice": JUDGED + "SELECT tid AS template_id, category, component, round(list_max(d_category), 5) AS p FROM judged",
    "expected_severity": JUDGED + "SELECT tid AS template_id, round(severity, 4) AS severity, round(impact, 4) AS impact FROM judged",
    "judgment_long": JUDGED + " UNION ALL ".join(f"SELECT '{k}' AS question_key, '{t}' AS question_type, 'heuristic' AS source, count(*) AS n, {f'round(avg(p_{k}), 3)' if t == 'noul' else 'CAST(NULL AS DOUBLE)'} AS mean_p FROM judged" for k, t in PACK),
    "runbook_choice": WITH + f", d AS (SELECT DISTINCT template FROM lines), o AS (SELECT template, {_scores([(k, f'({v})') for k, v in _rb])} AS s FROM d), e AS (SELECT template, {_raised('s', '7e-1')} AS e FROM o), p AS (SELECT template, {_shares('e')} AS p FROM e) SELECT template, {_best('p', [k for k, _ in _rb])} AS runbook FROM p",
    "cache_hits": f"WITH {_cache} SELECT subject_id, 'a' || n AS answer, 'cache' AS source FROM t WHERE n % 2 = 0",
    "cache_misses": f"WITH {_cache} SELECT subject_id FROM t WHERE n % 2 = 1",
    "cache_upsert": f"WITH {_cache} SELECT subject_id, CASE WHEN substr(subject_id, 1, 1) < '8' THEN 'new' ELSE 'a' || n END AS answer, 'heuristic' AS source FROM t WHERE n % 2 = 0 OR substr(subject_id, 1, 1) < '8'",
    "cache_stats": f"WITH {_cache} SELECT count(*) AS asked, count(*) FILTER (n % 2 = 0) AS hits, count(*) FILTER (n % 2 = 0) / CAST(count(*) AS DOUBLE) AS hit_rate FROM t",
    "judge_stats": "SELECT 25 AS requests, CAST(sum(CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE length(CAST(n_nationkey AS VARCHAR)) END) AS BIGINT) AS input_tokens, count(*) FILTER (n_nationkey % 7 = 0) AS dead_letters, round(sum(CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE length(CAST(n_nationkey AS VARCHAR)) END) / 1e6 * 42e-3, 6) AS est_cost_usd FROM nation",
    "dead_letters": "SELECT n_name AS subject_id, 1 AS attempts FROM nation WHERE n_nationkey % 7 = 0",
    "answer_pivot": JUDGED + f"SELECT tid AS template_id, {', '.join(f'p_{k} AS {k}' for k in NOULS)} FROM judged",
    "route_flags": JUDGED + "SELECT flags, count(*) AS n FROM routed GROUP BY 1",
    "rules_check": JUDGED + "SELECT tid AS template_id, level NOT IN ('ERROR', 'FATAL') AND (regexp_matches(lower(template), 'health|heartbeat|readyz|livez|cache hit|metrics') OR count >= 20) AS allowed FROM agg",
    "priority": JUDGED + "SELECT tid AS template_id, round(priority, 3) AS priority FROM routed",
    "noisy_or": WITH + ", t AS (SELECT service, template, count(*) AS n FROM lines GROUP BY 1, 2) SELECT service, round(1 - product(1 - 1e0 / (n + 1)), 6) AS p_any FROM t GROUP BY 1",
    "window_summary": JUDGED + "SELECT count(*) AS clusters, CAST(sum(count) AS BIGINT) AS lines, " + ", ".join(f"count(*) FILTER (decision = '{k}') AS n_{k}" for k in ("escalate", "triage", "review", "monitor", "suppress", "known_issue")) + ", CAST(coalesce(sum(count) FILTER (decision = 'suppress'), 0) AS BIGINT) AS suppressed_lines, round(sum(p_actionable), 1) AS expected_actionable_clusters, round(1 - product(1 - p_severe), 3) AS p_any_severe, round(coalesce(count(*) / CAST(nullif(count(*) FILTER (decision IN ('escalate', 'triage')), 0) AS DOUBLE), count(*)), 2) AS alert_reduction_ratio FROM routed",
    "category_counts": JUDGED + "SELECT category, count(*) AS clusters FROM routed GROUP BY 1",
    "surfaced": JUDGED + "SELECT tid AS template_id, decision FROM routed WHERE decision IN ('escalate', 'triage', 'review')",
    "topology_adjacent": f"SELECT col0 AS sa, col1 AS sb FROM {_top} UNION SELECT col1, col0 FROM {_top}",
    "candidate_pairs": PAIRS + "SELECT ai AS a_template_id, bi AS b_template_id, round(gap, 1) AS gap_s FROM allpairs",
    "same_issue_score": PAIRS + "SELECT ai AS a_template_id, bi AS b_template_id, round(p_same, 3) AS p_same FROM scored",
    "same_issue_edges": PAIRS + "SELECT ai AS a_template_id, bi AS b_template_id, round(p_same, 4) AS p_same FROM top2000 WHERE p_same >= 6e-1",
    "incident_components": MEMBERS + "SELECT tid AS template_id, group_id FROM mem",
    "incident_rollup": MEMBERS + "SELECT incident_id, min(first_seen) AS start, max(last_seen) AS \"end\", string_agg(DISTINCT service, ',' ORDER BY service) AS services, CAST(count(*) AS INTEGER) AS members, CAST(sum(count) AS BIGINT) AS lines, round(round(sum(priority), 4), 2) AS priority FROM mem GROUP BY 1",
    "topk_incidents": ALL_MEMBERS + "SELECT incident_id, CAST(sum(count) AS BIGINT) AS lines FROM mem GROUP BY 1 ORDER BY round(sum(priority), 4) DESC, incident_id LIMIT 3",
    "root_cause_rank": MEMBERS + ", k AS (SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY first_seen, priority DESC, tid) - 1 AS rk FROM mem) SELECT incident_id, tid AS template_id, CAST(rk AS INTEGER) AS rank, round(round(p_root_cause * (1 + 5e-1 / (1 + rk)), 4), 3) AS score FROM k",
    "change_interval_join": ALL_LINKS + "SELECT incident_id, count(DISTINCT change_id) AS changes FROM sc GROUP BY 1",
    "change_best_link": ALL_LINKS + "SELECT incident_id, change_id, tid AS template_id, round(p, 3) AS p_related FROM sc WHERE p >= 5e-1 QUALIFY row_number() OVER (PARTITION BY incident_id, change_id ORDER BY p DESC, priority DESC, tid) = 1",
    "binary_metrics": f"WITH {_golden}, c AS (SELECT count(*) AS n, count(*) FILTER (y) AS positives, count(*) FILTER (y AND p >= 5e-1) AS tp, count(*) FILTER (NOT y AND p >= 5e-1) AS fp, count(*) FILTER (y AND p < 5e-1) AS fn, count(*) FILTER (NOT y AND p < 5e-1) AS tn FROM g) SELECT *, round(tp / CAST(tp + fp AS DOUBLE), 4) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 4) AS recall, round(2e0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM c",
    "brier": f"WITH {_golden} SELECT round(avg(pow(p - CAST(y AS DOUBLE), 2)), 4) AS brier FROM g",
    "reliability": f"WITH {_bins} SELECT * FROM b",
    "ece": f"WITH {_bins} SELECT round(sum(n * abs(observed - mean_p)) / sum(n), 4) AS ece FROM b",
    "best_threshold": f"WITH {_golden}, t AS (SELECT DISTINCT round(p, 3) AS t FROM g), m AS (SELECT t, count(*) FILTER (y) AS tp, count(*) AS n FROM t JOIN g ON p >= t GROUP BY t) SELECT min(t) AS threshold FROM m WHERE tp > 0 AND tp / CAST(n AS DOUBLE) >= 88e-2",
    "choice_accuracy": f"WITH {_choice}, b AS (SELECT least(floor(p * 10), 9) AS bin, count(*) AS n, round(avg(p), 4) AS mp, round(avg(CAST(label = pred AS DOUBLE)), 4) AS ob FROM c GROUP BY 1) SELECT (SELECT count(*) FROM c) AS n, (SELECT round(avg(CAST(label = pred AS DOUBLE)), 4) FROM c) AS accuracy, round(sum(n * abs(ob - mp)) / sum(n), 4) AS top1_ece FROM b",
    "confusions": f"WITH {_choice} SELECT label || '->' || pred AS confusion, count(*) AS n FROM c WHERE label <> pred GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 5",
    "score_metrics": f"WITH {_golden}, s AS (SELECT n_chars % 5 AS l, (n_chars + quality) % 5 AS q, p * 4 AS e FROM g) SELECT count(*) AS n, round(avg(CAST(l = q AS DOUBLE)), 4) AS exact, round(avg(CAST(abs(l - q) <= 1 AS DOUBLE)), 4) AS within_1, round(avg(abs(l - e)), 4) AS mae_expected FROM s",
    "routing_quality": f"WITH {_decided} SELECT round(count(*) FILTER (actionable AND decision = 'suppress') / CAST(count(*) FILTER (actionable) AS DOUBLE), 4) AS false_suppression_rate, round(count(*) FILTER (NOT actionable AND decision = 'suppress') / CAST(count(*) FILTER (decision = 'suppress') AS DOUBLE), 4) AS suppression_precision, round(count(*) FILTER (actionable AND decision IN ('escalate', 'triage', 'review')) / CAST(count(*) FILTER (decision IN ('escalate', 'triage', 'review')) AS DOUBLE), 4) AS surfaced_precision, round(count(*) FILTER (actionable AND decision IN ('escalate', 'triage', 'review')) / CAST(count(*) FILTER (actionable) AS DOUBLE), 4) AS surfaced_recall, count(*) FILTER (actionable AND decision = 'suppress') AS false_suppressions FROM q",
    "estimate_cost": JUDGED + f"SELECT count(*) AS clusters, 0 AS cached_clusters, count(*) AS requests, CAST(count(*) * {len(_qt)} AS BIGINT) AS questions_asked, CAST(sum(CAST(ceil(length(state) / 4e0) AS BIGINT) * {len(_qt)} + {sum(_qt.values())}) AS BIGINT) AS input_tokens, CAST(max(ceil(length(state) / 4e0)) + {max(_qt.values())} AS BIGINT) AS max_request_tokens FROM st",
    "export_golden": WITH + f"SELECT template_id AS id, service, {_name} AS level, template, count(*) AS count FROM lines GROUP BY template_id, service, template",
    "decision_rows": JUDGED + "SELECT 'run' AS run_id, (SELECT min(first_seen) FROM agg) AS window_start, tid AS template_id, service, level, count, decision, category, component FROM routed",
    "otlp_payload": f"""SELECT seq, service, '{{"timeUnixNano":"' || (epoch_us(ts) * 1000) || '","severityText":"' || level || '","severityNumber":' || CASE level WHEN 'DEBUG' THEN 5 WHEN 'WARN' THEN 13 WHEN 'ERROR' THEN 17 ELSE 9 END || ',"body":{{"stringValue":"' || body || '"}},"traceId":"' || trace_id || '"}}' AS record FROM ({_logs})""",
    "triage_console": JUDGED + "SELECT decision, service, level, count, category, template FROM routed WHERE decision <> 'suppress' ORDER BY priority DESC, tid LIMIT 20",
    "template_labels": DEC + "SELECT template_id, arg_max(service, window_start) AS service, arg_max(decision, window_start) AS decision, arg_max(category, window_start) AS category, arg_max(component, window_start) AS component, max(window_start) AS last_judged FROM dec GROUP BY 1",
    "triage_view": DEC + "SELECT decision, service, category, CAST(sum(count) AS BIGINT) AS lines, round(max(p_actionable), 3) AS p_act, template_id FROM dec WHERE window_start > TIMESTAMP '2024-01-10' AND decision IN ('escalate', 'triage', 'review') GROUP BY decision, service, category, template_id",
    "reduction_per_day": DEC + "SELECT CAST(CAST(window_start AS DATE) AS VARCHAR) AS day, round(count(*) / CAST(greatest(count(*) FILTER (decision IN ('escalate', 'triage')), 1) AS DOUBLE), 6) AS clusters_per_surfaced FROM dec GROUP BY 1",
    "fallback_share": JUDGED + f"SELECT '{MODEL}' AS model_version, round(avg(CAST(ascii(tid) % 2 = 0 AS DOUBLE)), 6) AS fallback_share, count(*) * {len(PACK)} AS answers FROM judged",
    "fallback_rate": JUDGED + "SELECT round(avg(CAST(ascii(tid) % 2 = 0 AS DOUBLE)), 6) AS rate FROM judged",
    "drillback_traces": WITH + ", k AS (SELECT trace_id FROM (SELECT trace_id, row_number() OVER (ORDER BY min(seq)) AS r FROM lines WHERE template_id = (SELECT min(template_id) FROM lines) GROUP BY 1) WHERE r <= 5) SELECT ts, service, body FROM logs WHERE trace_id IN (SELECT trace_id FROM k) ORDER BY ts, seq LIMIT 200",
    "suppressed_lines": DEC + "SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS lines FROM dec WHERE decision = 'suppress'",
    "escalated_count": DEC + "SELECT count(*) AS n FROM dec WHERE decision = 'escalate'",
    "decision_timeseries": DEC + "SELECT time_bucket(INTERVAL '6 hours', window_start, TIMESTAMP '1970-01-01') AS time, decision, CAST(sum(count) AS BIGINT) AS lines FROM dec GROUP BY 1, 2",
    "lines_by_category": DEC + "SELECT category, CAST(sum(count) AS BIGINT) AS lines FROM dec WHERE decision IN ('escalate', 'triage', 'review') GROUP BY 1",
    "triage_board": DEC + "SELECT decision, service, level, CAST(sum(count) AS BIGINT) AS lines, min(category) AS category, min(template) AS template, min(flags) AS flags FROM dec WHERE decision <> 'suppress' GROUP BY decision, service, level, template_id",
    "incident_list": ALL_MEMBERS + "SELECT incident_id, string_agg(DISTINCT service, ',' ORDER BY service) AS services, CAST(sum(count) AS BIGINT) AS lines FROM mem GROUP BY 1 ORDER BY round(sum(priority), 4) DESC, incident_id LIMIT 50",
    "incident_count": MEMBERS + "SELECT count(DISTINCT incident_id) AS n FROM mem",
    "stream_once": WITH + ", c AS (SELECT date_trunc('hour', ts) AS window_start, service, template, count(*) AS lines FROM lines GROUP BY 1, 2, 3) SELECT * FROM c WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 15 SECOND FROM lines)",
}
