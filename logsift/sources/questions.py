"""Question packs: loading, checks and the built-in pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cache import fingerprint
from ..operators.judge import CATEGORY, COMPONENT, IMPACTS, SEVERITIES

KINDS = ("choice", "score", "noul")
#: The built-in pack: key, type, instructions, criteria. The wording is free; keys, types and numbers of options count.
BUILT_IN = {
    "category": ("choice", "Which kind of failure does this pattern of log lines point to?", {k: f"Failures of the kind {k.replace('_', ' ')}." for k in CATEGORY}),
    "component": ("choice", "Which layer of the system is this pattern about?", {k: f"The layer {k.replace('_', ' ')}." for k in COMPONENT}),
    "severity": ("score", "How severe is the condition for the service?", [f"Level {i} of {SEVERITIES - 1}" for i in range(SEVERITIES)]),
    "user_impact": ("score", "How much would users notice it?", [f"Level {i} of {IMPACTS - 1}" for i in range(IMPACTS)]),
    "actionable": ("noul", "Should an engineer on call look into this pattern?", None),
    "benign": ("noul", "Is this pattern routine noise that can be hidden?", None),
    "root_cause": ("noul", "Does the pattern describe the fault itself and not a symptom of another?", None),
    "novel": ("noul", "Does it look like a failure that wasn't seen before?", None),
    "sensitive": ("noul", "Are there personal data or secrets left in it?", None),
}


def payload(kind: str, instructions: str, criteria) -> dict:
    out = {"type": kind, "instructions": " ".join(instructions.split())}
    return out if criteria is None else out | {"criteria": criteria}


def checked(questions: dict) -> dict[str, dict]:
    """Payloads by key. ValueError for an empty pack, unknown types, under 2 or over 255 options, under 2 levels."""
    if not questions:
        raise ValueError("a pack needs a question")
    out = {}
    for key, q in questions.items():
        kind, instructions, criteria = q if isinstance(q, tuple) else (q.get("type"), q.get("instructions", ""), q.get("criteria"))
        if kind not in KINDS:
            raise ValueError(f"{key}: type {kind}")
        if kind == "choice" and not 2 <= len(criteria or {}) <= 255:
            raise ValueError(f"{key}: a choice has 2 to 255 options")
        if kind == "score" and len(criteria or []) < 2:
            raise ValueError(f"{key}: a score has 2 levels at least")
        out[key] = payload(kind, instructions, criteria)
    return out


def load_pack(path: str) -> dict[str, dict]:
    import yaml

    with open(path) as f:
        return checked((yaml.safe_load(f) or {}).get("questions") or {})


def pack_frame(spark: SparkSession, pack: dict[str, dict]) -> DataFrame:
    """question_key, question_type, instructions, options, fp."""
    rows = []
    for key, p in pack.items():
        c = p.get("criteria")
        options = ["yes", "no"] if p["type"] == "noul" else list(c) if isinstance(c, dict) else [str(i) for i in range(len(c))]
        rows.append((key, p["type"], p["instructions"], options, fingerprint(key, p)))
    return spark.createDataFrame(rows, "question_key string, question_type string, instructions string, options array<string>, fp string")
