"""The queries opN_<name> over the driver's tables, the pipeline, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import ann_search
from .common import table
from .divergence import source_divergence
from .html_extraction import html_extraction
from .license_scans import license_scan
from .mixing import taken
from .ngram_join import ngram_join
from .packing import best_fit_packing
from .quality_classifier import quality_classifier
from .quality_rules import quality_rules
from .sentencepieces import by_rank, decode, encode, piece_rows
from .spelling import spelling_variants
from .toxicity import toxicity
from .url_filters import url_filter


def tokenizer_path() -> str:
    """The public tokenizer's file; it is read where it stands."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def model_path() -> str:
    """The public SentencePiece model's file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public table's pieces with scores by rank: ids, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pieces = by_rank(piece_rows(model_path()))
    both = decode(encode(docs.withColumn("h", F.xxhash64("text")), pieces), pieces)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.array_join("ids", " ").alias("ids"), (F.xxhash64("decoded") == F.col("h")).alias("round_trip"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan(docs)
    return found.select("doc_id", F.array_join("licenses", ";").alias("licenses"), F.array_join("sentence_ids", ";").alias("sentence_ids"), "n_licenses")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return quality_classifier(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_url_filters, op3_nearest_neighbours, op4_ngram_jaccard_join, op5_sentencepiece, op6_toxicity, op7_license_scans, op8_quality_classifier, op9_html_extraction, op10_best_fit_packing, op11_spelling_variants, op12_source_mix, op13_source_divergence)}

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
_COUNT = lambda p: f"len(regexp_extract_all(t, '{p}'))"

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 7) AS k FROM w, unnest(range(1, len(ws) - 6)) u(i)),
dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM dup, range(8) r(j) GROUP BY rid),
b AS (SELECT doc_id, t, len(ws) AS n_words, CAST(length(t) - {_COUNT(r'[\x20\x09-\x0D]')} AS BIGINT) AS word_chars, CAST({_COUNT('[#*$%&|<>]')} AS BIGINT) AS n_symbols,
  len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 2 * {_COUNT(r'\p{Lu}')} > {_COUNT(r'\p{L}')} OR 5 * {_COUNT('!')} > n_words OR 3 * {_COUNT(r'\p{L}')} < word_chars
    OR 10 * {_COUNT(r'(?:\.\.\.|…)[ \t]*(?:\n|\z)')} > 3 * n_lines OR 10 * {_COUNT(r'(?:\A|\n)[ \t]*[•*-][ \t]')} > 9 * n_lines) AS kept FROM f""",
    "op4_ngram_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace('(t,', "(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS k FROM d, unnest(range(1, greatest(len(ws) - 3, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) u(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS v, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.v),
c AS (SELECT v, min(root) AS component_id FROM r GROUP BY v)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents JOIN c ON v = doc_id LEFT JOIN n USING (doc_id)""",
    "op11_spelling_variants": r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) r(i)),
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+') AS rs FROM documents),
r AS (SELECT k, run, count(*) AS c FROM (SELECT k, unnest(rs) AS run FROM d) GROUP BY ALL),
b AS (SELECT run, c, flatten(list_transform(string_split(k || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END)) AS bytes FROM r),
h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM b, tab),
n AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM n WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM w, unnest(range(1, length(word) + 1)) u(i)),
p AS (SELECT a.word, b.word AS near, b.n AS m FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT w.word, x.word, x.n FROM w JOIN x ON x.cut = w.word UNION SELECT x.word, w.word, w.n FROM w JOIN x ON x.cut = w.word),
f AS (SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM p GROUP BY word),
s AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN near END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n FROM w LEFT JOIN f USING (word)),
g AS (SELECT word, word AS root FROM s UNION SELECT g.word, s.form FROM g JOIN s ON s.word = g.root WHERE s.form IS NOT NULL)
SELECT s.word, s.form, g.root, s.n, s.n_near, s.form_n FROM s JOIN g ON g.word = s.word JOIN s e ON e.word = g.root AND e.form IS NULL""",
    "op13_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
o AS (SELECT lang, source, sum(n) AS total FROM m GROUP BY ALL),
p AS (SELECT m.*, CAST(1 + CAST(1000000000 AS HUGEINT) * (m.n + 1) // (o.total + l.v) AS BIGINT) AS p, CAST(1 + CAST(1000000000 AS HUGEINT) * (all_n + 1) // (l.total + l.v) AS BIGINT) AS q
  FROM m JOIN o ON o.lang = m.lang AND o.source = m.source JOIN l ON l.lang = m.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r QUALIFY part = 'pair' OR rank <= 200""",
    # in these tables the article stands in an element of that name, which the operator itself does not look for
    "op9_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g') AS t FROM a),
c AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c""",
}
