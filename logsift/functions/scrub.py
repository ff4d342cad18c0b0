"""Redaction of personal data and secrets: an ordered chain of regular expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import once

# Kind and pattern, in the order of application. Java flags: i ignore case, s dot matches all, U Unicode classes.
PATTERNS = [
    ("PRIVATE_KEY", r"(?s)-----BEGIN [A-Z ]*PRIVATE KEY-----.*?-----END [A-Z ]*PRIVATE KEY-----"),
    ("JWT", r"(?U)\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b"),
    ("AWS_KEY", r"(?U)\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("API_KEY", r"(?U)\b(?:sk|pk|rk|ghp|gho|xox[abp])[-_][A-Za-z0-9_-]{16,}\b"),
    ("BEARER", r"(?iU)\bbearer\s+[A-Za-z0-9._~+/=-]{12,}"),
    ("SECRET", r"(?iU)\b(password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b(\s*[=:]\s*)(?!<[A-Z_]+>)(\"[^\"]*\"|'[^']*'|[^\s,;\"]+)"),
    ("EMAIL", r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"),
    ("CARD", r"(?U)(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("SSN", r"(?U)\b\d{3}-\d{2}-\d{4}\b"),
    ("PHONE", r"(?U)(?<![\w.])\+?\d{1,2}[ .-]?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b"),
    ("IPV4", r"(?U)\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b"),
]
#: Kinds that point to a leak at the source.
HIGH_RISK = ["API_KEY", "AWS_KEY", "BEARER", "CARD", "JWT", "PRIVATE_KEY", "SECRET", "SSN"]


def patterns(redact_ips: bool = False, extra: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """The chain; IPV4 only if asked for, extra patterns last."""
    return [(k, p) for k, p in PATTERNS if redact_ips or k != "IPV4"] + list((extra or {}).items())


#: What a text must hold for a pattern to match at all: any of these strings, or a simpler expression. A test costs a
#: fraction of its pattern, and most texts pass few. Long s and the Kelvin sign count as s and k where case is ignored.
ANCHORS = {
    "PRIVATE_KEY": ["-----BEGIN "], "JWT": ["eyJ"], "AWS_KEY": ["AKIA", "ASIA"], "API_KEY": r"[kopab][-_]", "BEARER": r"(?iu)bearer",
    "SECRET": r"(?iu)(?=[pstk])(?:passw|pwd|secret|token|key)", "EMAIL": ["@"], "CARD": r"(?U)\d(?:[ -]?\d){12}", "SSN": r"(?U)\d{3}-\d{2}-", "PHONE": r"(?U)\d{3}[ .-]\d{4}", "IPV4": r"(?U)\d\.\d",
}


def may_match(kind: str, text: Column) -> Column:
    anchor = ANCHORS.get(kind)
    if isinstance(anchor, str):
        return F.regexp_like(text, F.lit(anchor))
    out = None if anchor else F.lit(True)
    for a in anchor or []:
        out = F.contains(text, F.lit(a)) if out is None else out | F.contains(text, F.lit(a))
    return out


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[ -]", "")


def _card(text: Column, pattern: str) -> tuple[Column, Column]:
    """(text with the card numbers that pass the Luhn check replaced, their count)."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    put = F.zip_with(parts, found, lambda a, m: F.concat(a, F.when(m.isNull(), F.lit("")).when(F.call_function("luhn_check", _digits(m)), F.lit("<CARD>")).otherwise(m)))
    n = F.size(F.filter(found, lambda m: F.call_function("luhn_check", _digits(m))))
    return F.array_join(put, ""), n


def scrub(df: DataFrame, text: str = "body", out: str = "scrubbed", hits: str = "hits", redact_ips: bool = False, extra: dict[str, str] | None = None) -> DataFrame:
    """df with ``out``, the redacted text, and ``hits``, a map of the kinds found to their counts.

    A null text gives null and an empty map.
    """
    chain = patterns(redact_ips, extra)
    names = [F.col(f"`{c}`") for c in df.columns if c not in (out, hits)]
    cur = df.select(*names, F.col(text).alias("_s"))
    for i, (kind, p) in enumerate(chain):
        if kind == "CARD":
            new, n = _card(F.col("_s"), p)
        else:
            new = F.regexp_replace("_s", p, f"$1$2<{kind}>" if kind == "SECRET" else f"<{kind}>")
            n = F.regexp_count("_s", F.lit(p))
        done, near = [F.col(f"_h{j}") for j in range(i)], may_match(kind, F.col("_s"))
        cur = cur.select(*names, *done, F.when(near, n).otherwise(F.lit(0)).cast("long").alias(f"_h{i}"), F.when(near, new).otherwise(F.col("_s")).alias("_s"))
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"_h{i}").alias("value")) for i, (k, _) in enumerate(chain)])
    none = F.lit(True)
    for i in range(len(chain)):
        none = none & (F.col(f"_h{i}") == 0)
    found = F.when(none, F.map_from_entries(F.array().cast("array<struct<key:string,value:bigint>>"))).otherwise(F.map_from_entries(F.filter(entries, lambda e: e.value > 0)))
    # guarded: a filter on the text or the hits (an explode infers one) would be pushed down the chain, copying it at every
    # step; filters on other columns belong before the scrub
    return cur.select(*names, once(F.col("_s")).alias(out), once(found).alias(hits))


def is_dirty(text: Column) -> Column:
    """Whether the chain would find anything; a text without any hit never changes on the way."""
    found = F.lit(False)
    for kind, p in patterns():
        if kind == "CARD":
            hit = F.exists(F.regexp_extract_all(text, F.lit(p), F.lit(0)), lambda m: F.call_function("luhn_check", _digits(m)))
        else:
            hit = F.regexp_like(text, F.lit(p))
        found = found | (may_match(kind, text) & hit)
    return F.coalesce(found, F.lit(False))


def scrub_stats(scrubbed: DataFrame, hits: str = "hits") -> DataFrame:
    """kind, hits: totals over the rows, long form."""
    return scrubbed.select(F.explode(hits).alias("kind", "n")).groupBy("kind").agg(F.sum("n").alias("hits"))
