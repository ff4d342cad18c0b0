"""The whole run: logs to clusters, answers, decisions, incidents and narratives, as lazily evaluated frames."""

from __future__ import annotations

import importlib
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cache as ch
from ..operators import correlate as co
from ..operators import judge as ju
from ..operators import miner, narrate, reduce, remote, route
from ..operators.graph import cut
from ..sources.questions import BUILT_IN, checked, load_pack, pack_frame


@dataclass
class Config:
    redact_ips: bool = False
    extra_patterns: dict[str, str] = field(default_factory=dict)
    mining: str = "distinct"  # or "exact", or "none" for masks alone
    sim_threshold: float = 0.5
    backend: str = "heuristic"  # or "remote": the judge that ``run`` is given
    model: str = ju.MODEL
    factory: str | None = None  # of judges, as module:function
    fallback: str | None = "heuristic"
    concurrency: int = 32
    max_retries: int = 3
    rpm: float = 1200
    cache: str | None = None  # a folder of Parquet
    ttl_days: float = 30
    pack: str | None = None
    router: route.RouterConfig = field(default_factory=route.RouterConfig)
    runbooks: dict[str, str] = field(default_factory=dict)
    correlate: bool = True
    same_issue_threshold: float = 0.6
    max_gap_s: int = 600
    max_pairs: int | None = co.MAX_PAIRS  # None: all candidate pairs
    change_lookback_s: int = 3600
    change_threshold: float = 0.5
    topology: dict[str, list[str]] | None = None
    top_k: int = 3
    usd_per_m: float = 0.042
    billing: str = "per_question"
    sink: str | None = None  # of SINKS
    out: str = "out"
    database: str = "triage"

    @staticmethod
    def merged(*layers: dict) -> dict:
        """Later layers over earlier ones, dictionaries key by key."""
        out: dict = {}
        for layer in layers:
            for k, v in (layer or {}).items():
                out[k] = Config.merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
        return out

    @staticmethod
    def of(*layers: dict) -> Config:
        """From dictionaries (of YAML files): sections as in SECTIONS, or fields by their own names. Keys of a section
        that name endpoints, paths of other tools or a language model are left out; others that are unknown are errors."""
        flat: dict = {}
        for name, value in Config.merged(*layers).items():
            if name == "router":
                flat["router"] = {**value, **flat.get("router", {})}
            elif name == "known_issues":
                flat.setdefault("router", {})["known_issues"] = value or {}
            elif name in SECTIONS:
                for k, v in (value or {}).items() if isinstance(value, dict) else [(None, value)]:
                    if k not in SECTIONS[name]:
                        raise ValueError(f"unknown setting {name}.{k}")
                    if SECTIONS[name][k]:
                        flat[SECTIONS[name][k]] = v
            elif name in Config.__dataclass_fields__:
                flat[name] = value
            else:
                raise ValueError(f"unknown setting {name}")
        if isinstance(flat.get("router"), dict):
            lists = {k: tuple(v) if isinstance(v, list) else v for k, v in flat["router"].items()}
            if odd := lists.keys() - route.RouterConfig.__dataclass_fields__.keys():
                raise ValueError(f"unknown setting router.{min(odd)}")
            flat["router"] = route.RouterConfig(**lists)
        if flat.get("backend", "heuristic") not in BACKENDS:
            flat["backend"] = "remote"
        for name, f in Config.__dataclass_fields__.items():  # YAML reads 1e9 as text
            if isinstance(flat.get(name), str) and isinstance(f.default, (int, float)):
                flat[name] = type(f.default)(float(flat[name]))
        for name, known in (("sink", (None, *SINKS)), ("billing", BILLING), ("mining", MINING)):
            if flat.get(name, known[0]) not in known:
                raise ValueError(f"{name} is one of {', '.join(map(str, known))}, not {flat[name]}")
        return Config(**flat)


BACKENDS = ("heuristic", "remote")
#: Where the command line puts a run: a folder of JSON or Parquet files, one commit (``commits.py``), or tables of a database.
SINKS = ("jsonl", "parquet", "commits", "tables")
BILLING, MINING = ("per_question", "per_request"), ("distinct", "exact", "none")
#: Settings of each section: their fields, or None for those that have no part here.
SECTIONS: dict[str, dict] = {
    "judge": {"backend": "backend", "model": "model", "factory": "factory", "fallback": "fallback", "concurrency": "concurrency", "max_retries": "max_retries", "rpm": "rpm", "endpoint": None, "timeout_s": None},
    "cache": {"path": "cache", "ttl_days": "ttl_days"}, "pack": {None: "pack"}, "runbooks": {}, "reduce": {"sim_threshold": "sim_threshold", "redact_ips": "redact_ips", "extra_patterns": "extra_patterns", "mining": "mining"},
    "correlate": {"enabled": "correlate", "same_issue_threshold": "same_issue_threshold", "max_gap_s": "max_gap_s", "max_pairs": "max_pairs", "change_lookback_s": "change_lookback_s", "change_threshold": "change_threshold", "topology": "topology"},
    "narrate": {"top_k": "top_k", "kind": None, "model": None, "effort": None}, "pricing": {"usd_per_m_input": "usd_per_m", "billing": "billing"}, "sink": {"kind": "sink", "out_dir": "out", "clickhouse_database": "database"},
}
del SECTIONS["runbooks"]  # a dictionary of the user's own keys


@dataclass
class Run:
    run_id: str
    model_version: str
    lines: DataFrame
    clusters: DataFrame
    judged: DataFrame
    routed: DataFrame
    summary: DataFrame
    members: DataFrame
    incidents: DataFrame
    root_causes: DataFrame
    links: DataFrame
    hypotheses: DataFrame
    timeline: DataFrame
    narratives: DataFrame
    cache: DataFrame | None = None  # to be kept for the next run
    new_answers: DataFrame | None = None  # those that weren't in the cache
    dead_letters: DataFrame | None = None
    judge_stats: DataFrame | None = None
    groups: DataFrame | None = None  # the miner's, for the next batch
    known: DataFrame | None = None  # those that it began with


def topology_frame(spark: SparkSession, topology: dict[str, list[str]] | None) -> DataFrame | None:
    return None if topology is None else spark.createDataFrame([(a, b) for a, bs in topology.items() for b in bs], "src string, dst string")


def factory(name: str | None):
    """The function that ``module:function`` names."""
    if not name or ":" not in name:
        raise ValueError("the backend remote needs judge.factory, as module:function")
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def judged_by(found: DataFrame, cfg: Config, ask=None, cache: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """(clusters with answers; cache, dead_letters and judge_stats of the run).

    ask: a factory of judges (``remote.ask_all``) for the backend ``remote``; by default the one that ``judge.factory`` names
    (``module:function``). Questions that the cache has fresh answers to aren't asked again; clusters that fail get the
    native answers, marked as fallback, or none if there is no fallback.
    """
    spark, native = found.sparkSession, ju.judge(found)
    if cfg.backend == "heuristic":
        return ju.answers(native), {}
    ask = ask or factory(cfg.factory)
    fps = pack_frame(spark, load_pack(cfg.pack) if cfg.pack else checked(BUILT_IN))
    subjects = native.select(F.col("template_id").alias("subject_id"), "state")
    old = None if cache is None else ch.fresh(cache, F.current_timestamp(), cfg.ttl_days)
    kept = None if old is None else cut(ch.answered(subjects, old, fps, cfg.model))
    asked = subjects if kept is None else ch.missing(subjects, kept, fps)
    calls = cut(remote.ask_all(asked, ask, cfg.concurrency, cfg.rpm, cfg.max_retries))
    new = remote.long_answers(calls, "remote")
    rows = ch.stored(new, fps, cfg.model)
    given = new if kept is None else new.unionByName(kept)
    extra = {"cache": rows if old is None else ch.upsert(cache, rows), "new_answers": rows, "dead_letters": remote.dead_letters(calls), "judge_stats": remote.run_stats(calls, subjects, cfg.fallback is not None, cfg.usd_per_m)}
    return ju.answers(ju.overlaid(native, given, cfg.fallback is not None, extra["dead_letters"])), extra


def run(logs: DataFrame, changes: DataFrame | None = None, config: Config | None = None, run_id: str | None = None, narrator: narrate.Narrator | None = None, ask=None, cache: DataFrame | None = None, known: miner.Known = None) -> Run:
    """logs: seq, ts, service, level, body, trace_id. Clusters are materialised once, as all later layers read them.

    ask, cache: see ``judged_by``. known: the miner's groups of earlier batches (``miner.grown``).
    """
    cfg, spark = config or Config(), logs.sparkSession
    lines = reduce.prepare(logs, cfg.redact_ips, cfg.extra_patterns)
    groups = before = None
    if cfg.mining == "none":
        lines = reduce.with_templates(lines)
    else:
        lines, groups, before = miner.kept(lines, known, cfg.mining == "exact", cfg.sim_threshold)
    found = cut(reduce.clusters(lines))
    judged, extra = judged_by(found, cfg, ask, cache)
    if cfg.runbooks:
        judged = ju.with_runbooks(judged, cfg.runbooks)
    routed = cut(route.route(judged, cfg.router))
    surfaced = co.surfaced(routed) if cfg.correlate else routed.limit(0)
    pairs = co.scored_pairs(co.candidate_pairs(surfaced, topology_frame(spark, cfg.topology), cfg.max_gap_s, cfg.max_pairs))
    members = cut(co.incident_members(surfaced, pairs, cfg.same_issue_threshold))
    all_incidents = co.incidents(members)
    kept = co.escalated(all_incidents)
    inside = members.join(kept.select("incident_id"), "incident_id", "left_semi")
    ranked = co.root_causes(inside)
    if changes is None:
        changes = spark.createDataFrame([], "change_id string, ts timestamp, service string, summary string")
    links = cut(co.change_links(inside, changes, cfg.change_lookback_s, cfg.change_threshold))
    top = co.top_incidents(kept, cfg.top_k)
    of_top = lambda df: df.join(top.select("incident_id"), "incident_id", "left_semi")
    scored = co.hypothesis_scores(co.hypotheses(of_top(ranked), of_top(links)), co.evidence(of_top(inside), top, of_top(links)))
    events = co.timeline(of_top(inside), of_top(links))
    bundle = narrate.bundles(top, of_top(ranked), of_top(links), scored, events)
    out = Run(
        run_id or f"run-{int(time.time())}", cfg.model, lines, found, judged, routed, route.window_summary(routed), inside, kept, ranked, links, scored, events,
        (narrator or narrate.TemplateNarrator()).narrate(bundle), **extra,
    )
    out.groups, out.known = groups, before
    return out
