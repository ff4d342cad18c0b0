"""Masks, tokens, keyword hits and small probability helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Masks in the order of application, with what a line must hold for them to match at all. A look ahead for the
# first character comes before tests of what stands around it, which cost more.
MASKS = [
    (r"(?iU)(?=[0-9a-f])\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", "<UUID>", lambda v: F.contains(v, F.lit("-"))),
    (r"(?U)(?=\d)\b(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?\b", "<IP>", lambda v: F.contains(v, F.lit("."))),
    (r"(?iU)\b0x[0-9a-f]+\b|\b[0-9a-f]{16,}\b", "<HEX>", lambda v: F.regexp_like(v, F.lit("0[xX]|[0-9a-fA-F]{16}"))),
    (r"(?iU)(?=\d)\b\d+(?:\.\d+)?(?:ms|s|us|µs|ns|m|h|kb|mb|gb|b)\b", "<DUR>", lambda v: F.regexp_like(v, F.lit(r"(?U)\d\p{L}"))),
    (r"(?U)(?=[-+\d])(?<![A-Za-z<])[-+]?\d+(?:\.\d+)?(?![A-Za-z>])", "<NUM>", None),
]
WILDCARD = "<*>"


def mask(line: Column) -> Column:
    for m in MASKS:
        line = _masked(line, *m)
    return line


def _masked(line: Column, pattern: str, token: str, may) -> Column:
    put = lambda v: F.regexp_replace(v, pattern, token)
    return _let(line, lambda v: F.when(may(v), put(v)).otherwise(v)) if may else put(line)


def tokens(line: Column) -> Column:
    """Tokens of the masked line; ``<EMPTY>`` alone if there are none."""
    parts = F.filter(F.split(mask(F.coalesce(line, F.lit(""))), r"(?U)\s+"), lambda t: t != "")
    return _let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit("<EMPTY>"))))  # masked once


def template_hash(service: Column, template: Column) -> Column:
    """First 16 hex digits of the sha1 of service, NUL, template."""
    return F.substring(F.sha1(F.concat(service, F.lit("\0"), template)), 1, 16)


def route_key(token: Column) -> Column:
    """The token itself, or the wildcard if it holds a digit or begins with ``<``."""
    return F.when(F.regexp_like(token, F.lit(r"(?U)\d")) | token.startswith("<"), F.lit(WILDCARD)).otherwise(token)


def hits(text: Column, words) -> Column:
    """How many of the words the text contains; a fold over a constant list keeps the generated code small."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))) if words else F.lit(0)


def word_tokens(text: Column) -> Column:
    """Distinct words of a letter and at least one letter, digit or underscore, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z][a-z0-9_]+"), F.lit(0)))


def similarity(a: Column, b: Column) -> Column:
    """Share of positions with equal tokens that are no wildcard; token arrays of one length."""
    same = F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != WILDCARD)), lambda v: v)
    return F.size(same) / F.greatest(F.size(a), F.lit(1))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def once(c: Column) -> Column:
    """c, as a column that Catalyst neither copies into what uses it nor pushes filters through.

    Wide chains of derived columns grow exponentially otherwise. It holds for columns of a projection, of streams too.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def noul(p: Column) -> Column:
    """p held within 0.01 and 0.99."""
    return F.least(F.greatest(p, F.lit(0.01)), F.lit(0.99))


def softmax(scores: list[tuple[str, Column]], temperature: float = 1.0) -> Column:
    """array<struct<name, p>>, p rounded to 6 digits, in the order of the scores."""
    names = F.array(*[F.lit(k) for k, _ in scores])
    values = F.array(*[v.cast("double") for _, v in scores])
    raised = _let(values, lambda v: _let(F.array_max(v), lambda m: F.transform(v, lambda x: F.exp((x - m) / temperature))))

    def shares(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
        return _let(total, lambda z: F.zip_with(names, e, lambda k, x: F.struct(k.alias("name"), F.round(x / z, 6).alias("p"))))

    return _let(raised, shares)


def _let(value: Column, body) -> Column:
    """body(v) with v computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def best_option(dist: Column) -> Column:
    """Name of the largest p, the first of equals."""
    top = F.array_max(F.transform(dist, lambda e: e.p))
    return F.get(F.filter(dist, lambda e: e.p == top), F.lit(0)).getField("name")


def expected_level(dist: Column) -> Column:
    """Sum of level times p over a distribution of levels "0", "1", ..."""
    return F.aggregate(dist, F.lit(0.0), lambda s, e: s + e["name"].cast("int") * e.p)


def confidence(dist: Column) -> Column:
    n = F.size(dist)
    return F.when(n > 1, F.round((n * F.array_max(F.transform(dist, lambda e: e.p)) - 1) / (n - 1), 4)).otherwise(F.lit(1.0))


def iso(ts: Column) -> Column:
    """ISO 8601 with the offset +00:00; microseconds only where there are any. The session's zone is UTC."""
    t = ts.cast("timestamp")
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    return F.concat(whole, F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))), F.lit("+00:00"))
