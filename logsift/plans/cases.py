"""More operators as queries, each with its DuckDB SQL beside it: forms of secrets, branches of the router, sources, calls.

Texts and rows are made from the driver's tables by the same SQL on both sides; what the operator makes of them is
written out in the second.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scrub as sc
from ..operators import correlate, evaluate, judge, miner, reduce, remote, route
from ..operators.graph import shared_folder
from ..sources import logs as src
from ..sources.questions import BUILT_IN, checked, pack_frame
from ..streaming import worker
from . import oracle as o
from . import queries as q
from . import sinks

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def case(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# secrets: kind, the text with a secret, the text without; {id} is the event's id, {4}, {8} and {16} its last digits
FORMS = [
    ("PRIVATE_KEY", "-----BEGIN RSA PRIVATE KEY-----\nMII{id}\n-----END RSA PRIVATE KEY----- end", "<PRIVATE_KEY> end"), ("JWT", "t eyJhbGci{8}.eyJzdWIi{8}.c2lnbmF0{8} x", "t <JWT> x"), ("AWS_KEY", "key AKIAABCDEFGH{8} ok", "key <AWS_KEY> ok"),
    ("API_KEY", "use sk-live{16} now", "use <API_KEY> now"), ("BEARER", "Authorization: Bearer abcdefgh{8}", "Authorization: <BEARER>"), ("SECRET", "user password: hunter{id}, next", "user password: <SECRET>, next"),
    ("SSN", "ssn 123-45-{4} filed", "ssn <SSN> filed"), ("PHONE", "call +1 (555) 123-{4} now", "call <PHONE> now"),
]


def _filled(form: str, text: str) -> str:
    out = "'" + form.replace("\n", "' || chr(10) || '") + "'"
    for n in (4, 8, 16):
        out = out.replace(f"{{{n}}}", f"' || lpad(right(CAST(event_id AS {text}), {n}), {n}, '0') || '")
    return out.replace("{id}", f"' || CAST(event_id AS {text}) || '")


def _secret(kind: str, form: str, clean: str):
    def f(spark: SparkSession, d: str) -> DataFrame:
        x = spark.sql(f"SELECT event_id AS seq, {_filled(form, 'STRING')} AS body FROM {{e}}", e=q.table(spark, d, "events"))
        return sc.scrub(x).select("seq", "scrubbed", F.element_at("hits", F.lit(kind)).alias("n"), F.size("hits").alias("kinds"))

    f.__name__ = f"scrub_{kind.lower()}"
    case(f"SELECT event_id AS seq, '{clean}' AS scrubbed, CAST(1 AS BIGINT) AS n, 1 AS kinds FROM events")(f)


for _form in FORMS:
    _secret(*_form)

_number = "'4' || lpad(CAST(event_id % 100000 AS {t}), 14, '0') || CAST(event_id % 10 AS {t})"
_luhn = "list_sum(list_transform(range(1, length({c}) + 1), lambda i: CASE WHEN (length({c}) - i) % 2 = 0 THEN CAST(substr({c}, i, 1) AS INT) ELSE (2 * CAST(substr({c}, i, 1) AS INT)) % 10 + CAST(CAST(substr({c}, i, 1) AS INT) >= 5 AS INT) END)) % 10 = 0"


@case(f"WITH t AS (SELECT event_id AS seq, {_number.format(t='VARCHAR')} AS c FROM events) SELECT seq, CASE WHEN {_luhn.format(c='c')} THEN 'paid by <CARD> today' ELSE 'paid by ' || c || ' today' END AS scrubbed FROM t")
def scrub_luhn(spark, d):
    x = spark.sql(f"SELECT event_id AS seq, 'paid by ' || {_number.format(t='STRING')} || ' today' AS body FROM {{e}}", e=q.table(spark, d, "events"))
    return sc.scrub(x).select("seq", "scrubbed")


_cards = r"regexp_extract_all(text, '(?:^|[^\w-])(\d(?:[ -]?\d){12,18})\b', 1)"
_valid = f"len(list_filter(list_transform({_cards}, lambda c: regexp_replace(c, '[ -]', '', 'g')), lambda c: {_luhn.format(c='c')}))"
ORACLE["scrub_card"] = f"SELECT doc_id, CAST(n AS BIGINT) AS n_card FROM (SELECT doc_id, {_valid} AS n FROM documents) WHERE n > 0"


def _before_ips() -> str:
    """SQL of documents (doc_id, t): texts as the chain leaves them to IPV4, alike in all that it looks at.

    RE2 knows ASCII words only and looks neither ahead nor behind. So z and Z become q and Q, which no kind names, and z then
    stands for a letter, mark or digit outside ASCII; a value that may not follow a secret's name begins with chr(1); a digit
    before a hyphen gets a z behind it; and what stands before a number is taken along and put back.
    """
    sub = lambda t, p, to: "regexp_replace(" + t + ", '" + p.replace("'", "''") + "', " + (to if to.startswith("chr") else f"'{to}'") + ", 'g')"
    t = sub("translate(text, 'zZ', 'qQ')", r"[\x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]", "\t")
    t = sub(sub(t, r"[^\x00-\x7F\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}]", "!"), r"[^\x00-\x7F]", "z")
    for kind, p in (
        ("PRIVATE_KEY", r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----"), ("JWT", r"\beyJ[A-Za-y0-9_-]{8,}\.[A-Za-y0-9_-]{8,}\.[A-Za-y0-9_-]{8,}\b"),
        ("AWS_KEY", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"), ("API_KEY", r"\b(?:sk|pk|rk|ghp|gho|xox[abp])[-_][A-Za-y0-9_-]{16,}\b"), ("BEARER", r"\b[Bb][Ee][Aa][Rr][Ee][Rr]\s+[A-Za-y0-9._~+/=-]{12,}"),
    ):
        t = sub(t, p, f"<{kind}>")
    t = sub(t, "<([A-Za-y_]+>)", r"chr(1) || '\1'")
    t = sub(t, r"""(?i)\b(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b(\s*[=:]\s*)("[^"]*"|'[^']*'|[^\s,;"\x01][^\s,;"]*)""", r"\1\2<SECRET>")
    t = sub(t, r"\b[A-Za-y0-9._%+-]+@[A-Za-y0-9.-]+\.[A-Za-y]{2,}\b", "<EMAIL>")
    first = sub(f"replace({t}, 'z', 'x')", "([0-9])-", r"\1z-")
    card = r"'(^|[^\w-])(\d(?:(?: |z-)?\d){12,18})\b'"
    whole = f"list_zip(string_split_regex(t, {card}), regexp_extract_all(t, {card}, 1), regexp_extract_all(t, {card}, 2))"
    digits = "regexp_replace(m[3], '[^0-9]', '', 'g')"
    put = f"array_to_string(list_transform({whole}, lambda m: m[1] || CASE WHEN m[3] IS NULL THEN '' WHEN {_luhn.format(c=digits)} THEN m[2] || '<CARD>' ELSE m[2] || m[3] END), '')"
    t = sub(sub(f"replace({put}, 'z', '')", r"\b\d{3}-\d{2}-\d{4}\b", "<SSN>"), r"(^|[^\w.])\+?\d{1,2}[ .-]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b", r"\1<PHONE>")
    return f"SELECT doc_id, {t} AS t FROM (SELECT doc_id, {first} AS t FROM documents)"


# The addresses that are left when the kinds before them are taken out: a card number may take an address's first octet along.
ORACLE["scrub_ipv4"] = f"SELECT doc_id, CAST(n AS BIGINT) AS n_ipv4 FROM (SELECT doc_id, len(regexp_extract_all(t, '{o.IPV4}')) AS n FROM ({_before_ips()})) WHERE n > 0"
_secrets = r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b\s*[=:]\s*(?:\"[^\"]*\"|''[^'']*''|[^\s,;\"]+)"
_phones = r"(?:^|[^\w.])\+?\d{1,2}[ .-]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b"
ORACLE["scrub_stats"] = (
    f"SELECT kind, CAST(sum(n) AS BIGINT) AS hits FROM (SELECT 'EMAIL' AS kind, len(regexp_extract_all(text, '{o.EMAIL}')) AS n FROM documents UNION ALL SELECT 'CARD', {_valid} FROM documents "
    f"UNION ALL SELECT 'SECRET', len(regexp_extract_all(text, '{_secrets}')) FROM documents UNION ALL SELECT 'PHONE', len(regexp_extract_all(text, '{_phones}')) FROM documents) GROUP BY kind HAVING sum(n) > 0"
)


# sources -------------------------------------------------------------------------------------------------------------


@case(f"SELECT seq, '{{\"text\":\"' || body || '\",\"n\":' || seq % 7 || '}}' AS body FROM ({o._logs})")
def scan_body_json(spark, d):
    x = q.logs(spark, d)
    raw = x.select("seq", F.to_json(F.struct("service", F.struct(F.col("body").alias("text"), (F.col("seq") % 7).alias("n")).alias("body"))).alias("value"))
    return src.parse_lines(raw).select("seq", "body")


@case(o._changes)
def scan_changes(spark, d):
    x = q.changes(spark, d)
    lines = x.select(F.to_json(F.struct(F.col("change_id").alias("id"), q.text.iso(F.col("ts")).alias("ts"), "service", "summary")).alias("value"))
    return src.parse_changes(lines).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@case("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-09'")
def window_scan(spark, d):
    import datetime as dt

    found = src.window_scan(q.table(spark, d, "events"), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 9), order=("event_id",))
    return found.select("event_id", "ts", "event_type")


ORACLE["cluster_order"] = o.WITH + f"SELECT template_id, {o._name} AS level, count(*) AS count, min(seq) AS first_seq, row_number() OVER (ORDER BY max(rnk) DESC, count(*) DESC, min(seq), template_id) AS rank FROM lines GROUP BY template_id"


@case(o.WITH + "SELECT 'g' || seq AS id, service, level, template, scrubbed AS example, CAST(seq % 5 AS BIGINT) AS count, CASE WHEN seq % 2 = 0 THEN 'true' ELSE 'false' END AS actionable FROM lines")
def golden_load(spark, d):
    labels = F.struct((F.col("seq") % 2 == 0).alias("actionable"))
    x = q.logs(spark, d).select("seq", F.to_json(F.struct(F.concat(F.lit("g"), F.col("seq")).alias("id"), "service", "level", "body", (F.col("seq") % 5).alias("count"), labels.alias("labels"))).alias("v"))
    out = src.parse_golden(x.withColumnRenamed("seq", "i"))
    return out.select("id", "service", "level", "template", F.element_at("examples", 1).alias("example"), "count", F.col("labels")["actionable"].alias("actionable"))


@case("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{t}', {len(c) if c else 2})" for k, (t, _, c) in BUILT_IN.items()) + ") t(question_key, question_type, options)")
def question_pack(spark, d):
    return pack_frame(spark, checked(BUILT_IN)).select("question_key", "question_type", F.size("options").alias("options"))


# mining --------------------------------------------------------------------------------------------------------------

_word = "translate(CAST(user_id AS {t}), '0123456789', 'abcdefghij')"
_opened = "SELECT event_id AS seq, CASE user_id % 2 WHEN 0 THEN 'edge' ELSE 'cart' END AS service, 'session opened by ' || {w} || ' for page' AS body FROM {e}"


@case("WITH t AS (" + _opened.format(w=_word.format(t="VARCHAR"), e="events") + "), g AS (SELECT service, CASE WHEN count(DISTINCT body) > 1 THEN 'session opened by <*> for page' ELSE min(body) END AS template, count(*) AS lines FROM t GROUP BY 1) SELECT service, template, substr(sha1(service || chr(0) || template), 1, 16) AS template_id, lines FROM g")
def drain_generalised(spark, d):
    x = spark.sql(_opened.format(w=_word.format(t="STRING"), e="{e}"), e=q.table(spark, d, "events")).withColumns({"level": F.lit("INFO"), "trace_id": F.lit(None).cast("string"), "ts": F.lit(None).cast("timestamp")})
    return miner.mine(reduce.prepare(x)).groupBy("service", "template", "template_id").agg(F.count(F.lit(1)).alias("lines"))


@case(ORACLE["drain_generalised"].replace("lines FROM g", "lines FROM g ").replace("SELECT service, template, substr", "SELECT service, template, substr"))
def drain_batches(spark, d):
    """Two batches, the second with the groups of the first."""
    x = spark.sql(_opened.format(w=_word.format(t="STRING"), e="{e}"), e=q.table(spark, d, "events")).withColumns({"level": F.lit("INFO"), "trace_id": F.lit(None).cast("string"), "ts": F.lit(None).cast("timestamp")})
    x = reduce.prepare(x)
    early = F.col("seq") % 2 == 0
    first, known = miner.grown(x.where(early))
    second, _ = miner.grown(x.where(~early), known)
    both = first.select("service", "template", "template_id").unionByName(second.select("service", "template", "template_id"))
    return both.groupBy("service", "template", "template_id").agg(F.count(F.lit(1)).alias("lines"))


@case(ORACLE["drain_generalised"])
def drain_sliced(spark, d):
    """The leaves dealt to many slices, which are mined and replayed in parallel."""
    x = spark.sql(_opened.format(w=_word.format(t="STRING"), e="{e}"), e=q.table(spark, d, "events")).withColumns({"level": F.lit("INFO"), "trace_id": F.lit(None).cast("string"), "ts": F.lit(None).cast("timestamp")})
    return miner.mine(reduce.prepare(x), rows_a_slice=100).groupBy("service", "template", "template_id").agg(F.count(F.lit(1)).alias("lines"))


# streams -------------------------------------------------------------------------------------------------------------


@case(f"WITH l AS ({o._logs}), m AS (SELECT max(ts) - INTERVAL 15 SECOND AS mark FROM l WHERE seq % 3 <> 0) SELECT date_trunc('hour', ts) AS window_start, service, count(*) AS lines, count(*) FILTER (WHERE seq % 3 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark) AS late_lines FROM l, m GROUP BY ALL")
def late_rows(spark, d):
    """Two thirds of the lines come in a first batch, the others in a second one, most of them behind the watermark."""
    base = f"{shared_folder(spark)}/late-{uuid.uuid4().hex}"
    x = q.logs(spark, d)
    for part in (F.col("seq") % 3 != 0, F.col("seq") % 3 == 0):
        x.where(part).write.mode("append").parquet(f"{base}/in")
        logs = worker.log_stream(spark, f"{base}/in", x.schema, files_per_trigger=1_000_000)
        worker.audit(logs, f"{base}/out", f"{base}/state", "1 hour", once=True).awaitTermination()
    found = worker.window_counts(spark, f"{base}/out").groupBy("window_start", "service").agg(F.sum("lines").alias("lines"), F.sum("late_lines").alias("late_lines"))
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_shared = "len(list_intersect(list_distinct(regexp_extract_all(lower(summary), '[a-z][a-z0-9_]+')), list_distinct(regexp_extract_all(lower(template), '[a-z][a-z0-9_]+'))))"


@case(o.WITH + f", c AS ({o._changes}), j AS (SELECT c.change_id, l.seq, c.service = l.service AS same, round((epoch_us(l.ts) - epoch_us(c.ts)) / 6e7, 1) AS minutes, {_shared} AS shared FROM c JOIN lines l ON l.ts >= c.ts AND l.ts <= c.ts + INTERVAL 1 HOUR WHERE l.level = 'ERROR'), p AS (SELECT change_id, seq, round(least(greatest(8e-2 + CASE WHEN same THEN 45e-2 ELSE 0 END + CASE WHEN minutes <= 30 THEN 25e-2 WHEN minutes <= 120 THEN 1e-1 ELSE -5e-2 END + least(2e-1, 7e-2 * shared), 1e-2), 99e-2), 4) AS p FROM j) SELECT change_id, seq, round(p, 3) AS p_related FROM p WHERE p >= 5e-1")
def stream_changes(spark, d):
    """Error lines and changes as two streams over ``events``, joined by time with watermarks on both."""
    events = lambda: worker.log_stream(spark, f"{d}/events.parquet*", q.table(spark, d, "events").schema)
    lines = reduce.with_templates(reduce.prepare(spark.sql(q.LOGS.replace("{text}", "STRING"), events=events()).where("level = 'ERROR'")))
    base = f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}"
    x = worker.changes_near(lines, q.changes_of(events()), lag="400 days")
    x.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return spark.read.schema(x.schema).parquet(f"{base}/out").select("change_id", "seq", F.round("p_related", 3).alias("p_related"))


# judge and calls -----------------------------------------------------------------------------------------------------


@case(o.JUDGED + "SELECT tid AS template_id, p_actionable FROM judged")
def p_actionable(spark, d):
    return q.judged(spark, d).select("template_id", "p_actionable")


@case(o.JUDGED + " UNION ALL ".join(f"SELECT tid AS template_id, '{k}' AS question_key, round(round(({n} * list_max(d_{c}) - 1) / {n - 1}, 4), 3) AS confidence FROM judged" for k, c, n in (("category", "category", len(judge.CATEGORY)), ("component", "component", len(judge.COMPONENT)), ("severity", "severity", 5), ("user_impact", "impact", 4))))
def answer_confidence(spark, d):
    x = judge.judgments(q.judged(spark, d)).where("confidence IS NOT NULL")
    return x.select("template_id", "question_key", F.round("confidence", 3).alias("confidence"))


_KINDS = [{"key": k, "payload": {"type": t}} for k, t in (("benign", "noul"), ("category", "choice"), ("severity", "score"))]


def _service():
    """A judge's service: busy at first for some subjects, in error for others; answers in the shapes that judges send."""
    seen: dict = {}

    def transport(request):
        n = request["state"]["n"]
        seen[n] = seen.get(n, 0) + 1
        if n % 5 == 4:
            return 400, "no"
        if seen[n] <= n % 3:
            return 503, "busy"
        first = {"probabilities": {"yes": n / 32, "no": 1 - n / 32}} if n % 2 else {"value": n / 32}
        names = ("timeout", "auth") if n % 2 else ("auth", "timeout")
        return 200, json.dumps({"answers": {"benign": first, "category": {"probabilities": dict(zip(names, (0.7, 0.3)))}, "severity": {"value": n % 5}}, "usage": {"input_tokens": 10 + n}})

    return remote.http_judge(transport, "m", _KINDS)


def _asked(spark, d):
    x = q.table(spark, d, "nation").select(F.col("n_name").alias("subject_id"), F.to_json(F.struct(F.col("n_nationkey").alias("n"))).alias("state"))
    return remote.ask_all(x, _service, concurrency=4, rpm=1e9, base_s=0.0)


@case("WITH n AS (SELECT n_name AS subject_id, n_nationkey AS n FROM nation WHERE n_nationkey % 5 <> 4) SELECT subject_id, 'benign' AS key, 'noul' AS type, CAST(n / 32e0 AS VARCHAR) AS value FROM n UNION ALL SELECT subject_id, 'category', 'choice', CASE WHEN n % 2 = 1 THEN 'timeout' ELSE 'auth' END FROM n UNION ALL SELECT subject_id, 'severity', 'score', CAST(n % 5 AS VARCHAR) FROM n")
def parse_answers(spark, d):
    return remote.long_answers(_asked(spark, d), "remote").select("subject_id", "key", "type", "value")


@case("SELECT n_name AS subject_id, CASE WHEN n_nationkey % 5 = 4 THEN 1 ELSE n_nationkey % 3 + 1 END AS attempts, n_nationkey % 5 <> 4 AS answered, CAST(CASE WHEN n_nationkey % 5 = 4 THEN 0 ELSE 10 + n_nationkey END AS BIGINT) AS input_tokens FROM nation")
def judge_calls(spark, d):
    return _asked(spark, d).select("subject_id", "attempts", F.col("answers").isNotNull().alias("answered"), "input_tokens")


# route ---------------------------------------------------------------------------------------------------------------

_f2 = lambda c: f"printf('%.2f', round({c}, 2))"
_both = f"'P(actionable)=' || {_f2('p_actionable')} || ', P(benign)=' || {_f2('p_benign')}"
_last = f"""CASE decision WHEN 'suppress' THEN 'P(benign)=' || {_f2('p_benign')} || ', P(actionable)=' || {_f2('p_actionable')} || ', rules check passed'
  WHEN 'escalate' THEN 'P(actionable)=' || {_f2('p_actionable')} || CASE WHEN p_novel >= 5e-1 THEN ', P(novel)=' || {_f2('p_novel')} ELSE '' END || CASE WHEN severity >= 25e-1 THEN ', E[severity]=' || printf('%.1f', round(severity, 1)) ELSE '' END
  WHEN 'triage' THEN 'P(actionable)=' || {_f2('p_actionable')} WHEN 'review' THEN 'near threshold: ' || {_both} ELSE {_both} END"""
_guard = "CASE WHEN p_benign >= 95e-2 AND p_actionable <= 1e-1 AND decision <> 'suppress' THEN 'would suppress, but the rules check did not pass; ' ELSE '' END"
ORACLE["route_decision"] = o.JUDGED + f"SELECT tid AS template_id, decision, {_guard} || {_last} AS reasons, flags FROM routed"


@case(o.JUDGED + "SELECT tid AS template_id, round(priority, 3) AS priority, row_number() OVER (ORDER BY round(priority, 9) DESC, rnk DESC, count DESC, tid) AS rank FROM routed")
def priority_order(spark, d):
    x = q.routed(spark, d).withColumn("priority", F.round("priority", 9))
    return reduce.ranked(x, route.priority_order).select("template_id", F.round("priority", 3).alias("priority"), "rank")


@case(o.JUDGED + f"SELECT tid AS template_id, CASE WHEN service = 'edge' THEN 'known_issue' ELSE decision END AS decision, CASE WHEN service = 'edge' THEN 'known issue: TICKET-' || substr(tid, 1, 4) ELSE {_guard} || {_last} END AS reasons FROM routed")
def known_issue_join(spark, d):
    x = q.judged(spark, d)
    known = x.where("service = 'edge'").select("template_id", F.concat(F.lit("TICKET-"), F.substring("template_id", 1, 4)).alias("ticket"))
    return route.route(x, known=known).select("template_id", "decision", F.array_join("reasons", "; ").alias("reasons"))


_books = f"d AS (SELECT DISTINCT template FROM lines), rs AS (SELECT template, {o._scores([(k, f'({v})') for k, v in o._rb])} AS s FROM d), re AS (SELECT template, {o._raised('s', '7e-1')} AS e FROM rs), rp AS (SELECT template, {o._shares('e')} AS p FROM re), book AS (SELECT template, {o._best('p', [k for k, _ in o._rb])} AS runbook, list_max(p) AS runbook_p FROM rp)"


@case(f"WITH {o._judged}, {_books} SELECT tid AS template_id, CASE WHEN runbook <> 'none' AND runbook_p >= 7e-1 THEN 'known_issue' ELSE decision END AS decision, CASE WHEN runbook <> 'none' AND runbook_p >= 7e-1 THEN runbook END AS runbook FROM routed JOIN book USING (template)")
def runbook_route(spark, d):
    x = judge.with_runbooks(q.judged(spark, d), q.RUNBOOKS, F.col("template"))
    return route.route(x).select("template_id", "decision", F.when(F.col("decision") == "known_issue", F.col("runbook")).alias("runbook"))


_k = "ascii({c}) % 4"


@case(
    o.JUDGED + f"""SELECT tid AS template_id, CASE {_k.format(c='tid')} WHEN 0 THEN 'review' WHEN 1 THEN CASE WHEN decision = 'escalate' THEN 'escalate' ELSE 'triage' END ELSE 'review' END AS decision,
  CASE {_k.format(c='tid')} WHEN 0 THEN 'missing core answers (actionable/benign)' WHEN 1 THEN CASE WHEN decision = 'escalate' THEN {_last} ELSE 'scrubber caught CARD, JWT: fix the logging call at the source' END
    WHEN 2 THEN 'would suppress, but answers came from the fallback judge; near threshold: P(actionable)=0.05, P(benign)=0.97'
    ELSE 'P(sensitive)=0.90: keep examples out of L4 and fix the scrubber; would suppress, but the cluster may contain sensitive data; near threshold: P(actionable)=0.05, P(benign)=0.97' END AS reasons FROM routed"""
)
def route_branches(spark, d):
    """Every fourth cluster without a core answer, with leaks, from the fallback judge, and with sensitive data."""
    x, k = q.judged(spark, d), F.ascii("template_id") % 4
    quiet = k >= 2
    leaks = F.create_map(F.lit("JWT"), F.lit(1), F.lit("CARD"), F.lit(2), F.lit("EMAIL"), F.lit(3)).cast("map<string,bigint>")
    x = x.withColumns({
        "p_benign": F.when(k == 0, F.lit(None)).when(quiet, F.lit(0.97)).otherwise(F.col("p_benign")), "p_actionable": F.when(quiet, F.lit(0.05)).otherwise(F.col("p_actionable")),
        "sensitive_hits": F.when(k == 1, leaks).otherwise(F.col("sensitive_hits")), "fallback": k == 2, "p_sensitive": F.when(k == 3, F.lit(0.9)).otherwise(F.col("p_sensitive")),
    })
    return route.route(x).select("template_id", "decision", F.array_join("reasons", "; ").alias("reasons"))


@case(o.JUDGED + "SELECT round(coalesce(count(*) / CAST(nullif(count(*) FILTER (decision IN ('escalate', 'triage')), 0) AS DOUBLE), count(*)), 2) AS alert_reduction_ratio FROM routed")
def alert_reduction(spark, d):
    return route.window_summary(q.routed(spark, d)).select("alert_reduction_ratio")


# correlate -----------------------------------------------------------------------------------------------------------

LOW_SEVERITY = 1.9


@case(o.MEMBERS + f"SELECT incident_id FROM mem GROUP BY 1 HAVING bool_or(p_actionable >= 6e-1 AND (p_novel >= 5e-1 OR severity >= {LOW_SEVERITY}e0))")
def escalated_incidents(spark, d):
    """With a lower bar of severity, as these tables hold no severe cluster."""
    found = q.cut(correlate.surfaced(route.route(q.judged(spark, d), route.RouterConfig(escalate_severity_min=LOW_SEVERITY))))
    members = correlate.incident_members(found, correlate.scored_pairs(correlate.candidate_pairs(found, q.topology(spark))))
    return correlate.escalated(correlate.incidents(members)).select("incident_id")


@case(o.MEMBERS + "SELECT DISTINCT incident_id, group_id FROM mem")
def incident_ids(spark, d):
    return q.members(spark, d, correlate.MAX_PAIRS).select("incident_id", "group_id").distinct()


@case(o.MEMBERS.replace("FROM top2000 WHERE p_same >= 6e-1", "FROM scored WHERE p_same >= 6e-1") + "SELECT incident_id, CAST(count(*) AS INTEGER) AS members, CAST(sum(count) AS BIGINT) AS lines FROM mem GROUP BY 1")
def incident_rollup_exact(spark, d):
    """Incidents from all candidate pairs, without a limit on them."""
    found = q.cut(correlate.surfaced(q.routed(spark, d)))
    members = correlate.incident_members(found, correlate.scored_pairs(correlate.candidate_pairs(found, q.topology(spark), limit=None)))
    return correlate.incidents(members).select("incident_id", F.size("template_ids").alias("members"), "lines")


@case(o.LINKS + "SELECT incident_id, change_id, max(round(p, 3)) AS p_related FROM sc GROUP BY 1, 2")
def change_score(spark, d):
    return correlate.change_links(q.members(spark, d, correlate.MAX_PAIRS), q.changes(spark, d), threshold=0.0).select("incident_id", "change_id", F.round("p_related", 3).alias("p_related"))


# evaluation and sinks ------------------------------------------------------------------------------------------------

_rate = "round(count(*) FILTER (actionable AND decision = 'suppress') / CAST(count(*) FILTER (actionable) AS DOUBLE), 4)"


@case(f"WITH {o._decided} SELECT bound, (SELECT {_rate} FROM q) <= bound AS passes FROM (VALUES (0e0), (1e0)) t(bound)")
def ci_gate(spark, d):
    quality = q.cut(evaluate.routing_quality(q._decided(spark, d)))
    return spark.createDataFrame([(b, evaluate.gate(quality, b)) for b in (0.0, 1.0)], "bound double, passes boolean")


ORACLE["nearest_rank_percentile"] = "SELECT p AS percent, (SELECT value FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i FROM events) WHERE i = CAST(round_even(p / 100 * ((SELECT count(*) FROM events) - 1), 0) AS BIGINT)) AS value FROM (VALUES (50e0), (95e0)) t(p)"
_span = "(SELECT min(first_seen) FROM agg) AS window_start, (SELECT max(last_seen) FROM agg) AS window_end"


@case(o.JUDGED + f"SELECT 'run' AS run_id, {_span}, tid AS template_id, service, template, level, count, first_seen, last_seen FROM agg")
def cluster_rows(spark, d):
    x = sinks.cluster_rows(q.clusters_h(spark, d), "run")
    return x.select("run_id", "window_start", "window_end", "template_id", "service", "template", "level", "count", "first_seen", "last_seen")


@case(o.JUDGED + " UNION ALL ".join(f"SELECT 'run' AS run_id, tid AS template_id, '{judge.MODEL}' AS model_version, '{k}' AS question_key, {v} AS value FROM judged" for k, v in (("category", "category"), ("component", "component"))))
def judgment_rows(spark, d):
    x = sinks.judgment_rows(q.judged(spark, d), "run").where("question_key IN ('category', 'component')")
    return x.select("run_id", "template_id", "model_version", "question_key", "value")


# stories -------------------------------------------------------------------------------------------------------------

_best_links = o._links + ", best AS (SELECT incident_id, change_id, tid, priority, round(p, 4) AS p FROM sc WHERE p >= 5e-1 QUALIFY row_number() OVER (PARTITION BY incident_id, change_id ORDER BY p DESC, priority DESC, tid) = 1), lk2 AS (SELECT best.*, ch.ts AS change_ts, ch.service AS change_service, ch.summary FROM best JOIN ch USING (change_id))"
_event = "[" + ", ".join(f"15e-1 * {o.hits('low', w)}" for w in judge.EVENT.values()) + ", 5e-1]"
_names = "[" + ", ".join(f"'{k}'" for k in [*judge.EVENT, "other"]) + "]"


@case(
    f"""WITH RECURSIVE {_best_links}, evs AS (SELECT incident_id, first_seen AS ts, '[' || service || '] ' || level || ': ' || template AS label, 'log' AS kind FROM mem
  UNION ALL SELECT incident_id, change_ts, '[' || change_service || '] change: ' || summary, 'change' FROM lk2),
txt AS (SELECT *, lower('{{"kind":"' || kind || '","at":"' || {o.iso('ts')} || '","event":"' || label || '"}}') AS low FROM evs), scd AS (SELECT *, {_event} AS v, {o._noul(o._sig(f"(-1e0 + 8e-1 * {o.hits('low', judge.MILESTONE)})"))} AS p_milestone FROM txt)
SELECT incident_id, ts, label, kind, {_names}[list_position(v, list_max(v))] AS event_type, p_milestone FROM scd WHERE p_milestone >= 4e-1"""
)
def timeline_scored(spark, d):
    """All incidents' events, with a lower bar, as these tables hold no event of two milestone words."""
    m = q.cut(q.members(spark, d, correlate.MAX_PAIRS))
    x = correlate.timeline(m, correlate.change_links(m, q.changes(spark, d)), least=0.4)
    return x.select("incident_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "label", "kind", "event_type", "p_milestone")


_share = f"CAST(len(list_intersect({o._tok('h')}, {o._tok('evidence')})) AS DOUBLE) / greatest(len({o._tok('h')}), 1)"


@case(
    f"""WITH RECURSIVE {_best_links}, kk AS (SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY first_seen, priority DESC, tid) - 1 AS rk FROM mem), rc AS (SELECT *, round(p_root_cause * (1 + 5e-1 / (1 + rk)), 4) AS score FROM kk),
ha AS (SELECT incident_id, row_number() OVER (PARTITION BY incident_id ORDER BY p DESC, change_id) AS pos, 'The change to ' || change_service || ' (' || summary || ') introduced the failure.' AS h FROM lk2),
hb AS (SELECT incident_id, 3 + row_number() OVER (PARTITION BY incident_id ORDER BY score DESC, rk) AS pos, 'A ' || replace(coalesce(category, 'unknown'), '_', ' ') || ' problem in ' || service || ' is the origin: ' || template AS h FROM rc),
hg AS (SELECT DISTINCT incident_id, pos, h FROM mem, (VALUES (7, 'A shared downstream dependency degraded and the errors are symptoms of it.'), (8, 'A traffic spike exhausted capacity across the affected services.')) v(pos, h)),
hu AS (SELECT incident_id, h, min(pos) AS pos FROM (SELECT * FROM ha WHERE pos <= 3 UNION ALL SELECT * FROM hb WHERE pos <= 6 UNION ALL SELECT * FROM hg) GROUP BY 1, 2),
fin AS (SELECT incident_id, CAST(row_number() OVER (PARTITION BY incident_id ORDER BY pos) AS INTEGER) AS position, h FROM hu QUALIFY position <= 6), ev AS (SELECT incident_id, string_agg(DISTINCT template, ' ') AS evidence FROM mem GROUP BY 1)
SELECT incident_id, position, h AS hypothesis, {o._noul(o._sig(f'(-22e-1 + 6e0 * ({_share}))'))} AS p_supported FROM fin JOIN ev USING (incident_id)"""
)
def hypothesis_scores(spark, d):
    """All incidents' hypotheses, scored against their members' templates."""
    m = q.cut(q.members(spark, d, correlate.MAX_PAIRS))
    proposed = correlate.hypotheses(correlate.root_causes(m), correlate.change_links(m, q.changes(spark, d)))
    texts = m.select("incident_id", "template").distinct().groupBy("incident_id").agg(F.array_join(F.array_sort(F.collect_list("template")), " ").alias("evidence"))
    return correlate.hypothesis_scores(proposed, texts)


_side = lambda s: f"""'{{"service":"' || s{s} || '","template":"' || tm{s} || '","first_seen":"' || {o.iso(f'f{s}')} || '"}}'"""


@case(
    o.PAIRS + f""", w AS (SELECT p.*, a.first_seen AS fa, b.first_seen AS fb FROM scored p JOIN surf a ON a.tid = ai JOIN surf b ON b.tid = bi)
SELECT ai || '|' || bi AS subject_id, '{{"a":' || {_side('a')} || ',"b":' || {_side('b')} || ',"gap_s":' || CAST(round(gap, 1) AS VARCHAR) || ',"shared_trace":' || CASE WHEN len(list_intersect(ax, bx)) > 0 THEN 'true' ELSE 'false' END || '}}' AS state FROM w"""
)
def pair_states(spark, d):
    found = q.cut(correlate.surfaced(q.routed(spark, d)))
    return correlate.pair_state(correlate.candidate_pairs(found, q.topology(spark), limit=None))


@case(
    o.WITH + f", d AS (SELECT DISTINCT template FROM lines), rs AS (SELECT template, {o._scores([(k, f'({v})') for k, v in o._rb[:-1]])} AS s FROM d), re AS (SELECT template, {o._raised('s', '7e-1')} AS e FROM rs), rp AS (SELECT template, {o._shares('e')} AS p FROM re) "
    f"SELECT template, {o._best('p', [k for k, _ in o._rb[:-1]])} AS choice, 5e-1 AS noul, 25e-2 AS level_p FROM rp"
)
def generic_answers(spark, d):
    x = q.lines(spark, d).select("template").distinct()
    level = F.element_at(judge.generic("score", F.col("template"), [0, 1, 2, 3]), 1).p
    return x.select("template", q.text.best_option(judge.generic("choice", F.col("template"), q.RUNBOOKS)).alias("choice"), judge.generic("noul", F.col("template")).alias("noul"), level.alias("level_p"))
