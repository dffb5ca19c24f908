"""The numbered queries: each operator over its whole table, with the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.session import fresh_dir
from tidemark.llm import (decontam, lines, packing, periods, pii, ranking, repeats, secrets, simhash, syncmers, token_files, toxicity,
                          url_filter)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
#: Tokens of a packed sequence, and the id that ends a document.
SEQUENCE_TOKENS = 4096
END_ID = 1


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public vocabulary file that the packing and token-file queries name."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), SEQUENCE_TOKENS, END_ID)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to byte-plane files and read back."""
    path = fresh_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID)
    return token_files.read_documents(spark, path)


#: The rules that op1 judges by.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict", "reason")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CHECKS["op1_url_filter"] = f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
raw AS (SELECT row_number() OVER () AS n, page_id, url, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
page AS (SELECT n, page_id, html, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*([^#]*)', 1) AS query FROM raw),
tags AS (SELECT host, path, query, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM page),
goals AS (SELECT host, path, query, replace(CASE
    WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical')
        THEN regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh')
        THEN regexp_extract(tag, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>;]+)', 1) END, '&amp;', '&') AS t FROM tags),
full_goals AS (SELECT host || path || query AS a, CASE
    WHEN regexp_matches(t, '^(#|$)') THEN NULL WHEN strpos(t, '://') > 0 THEN substr(t, strpos(t, '://') + 3)
    WHEN starts_with(t, '//') THEN substr(t, 3) WHEN starts_with(t, '/') THEN host || t WHEN starts_with(t, '?') THEN host || path || t
    ELSE host || regexp_extract(path, '^(.*/)?') || t END AS rest FROM goals WHERE t IS NOT NULL AND host <> ''),
links AS (SELECT DISTINCT a, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)
    || regexp_extract(rest, '^[^?#]*([^#]*)', 1) AS b FROM full_goals WHERE regexp_extract(rest, '^[^/?#]*') <> ''),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
spots AS (SELECT DISTINCT a AS node, regexp_extract(a, '^[^/?#]*') AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM edges),
places AS (SELECT host, path FROM page UNION SELECT host, path FROM spots),
fits AS (SELECT host, path, arg_max(struct_pack(rule := rhost || rpath, verdict := verdict), length(rhost || rpath)) AS best
    FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
aliases AS (SELECT r.a AS node, min(f.best.verdict) AS verdict FROM (SELECT a, b FROM reach UNION SELECT a, a FROM reach) r
    JOIN spots s ON s.node = r.b JOIN fits f ON f.host = s.host AND f.path = s.path GROUP BY r.a)
SELECT page_id, p.host, p.path, f.best.rule AS rule, coalesce(f.best.verdict, a.verdict, 'allow') AS verdict,
    CASE WHEN f.best IS NOT NULL THEN 'rule' WHEN a.verdict IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM page p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path
LEFT JOIN aliases a ON p.host <> '' AND a.node = p.host || p.path || p.query
"""

_WORDS = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
CHECKS["op2_decontamination"] = f"""
WITH doc AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) <= 13 THEN [w] ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS t
    FROM item WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(t) AS size FROM win),
place AS (SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS head FROM doc, sizes),
hit AS (SELECT p.n, p.head, p.size, x.item_id FROM place p JOIN win x ON x.t = p.w[p.head:p.head + p.size - 1]),
covered AS (SELECT n, count(DISTINCT pos) AS n_hit FROM (SELECT n, unnest(range(head, head + size)) AS pos FROM hit) GROUP BY n),
named AS (SELECT n, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY n),
-- Proximity: the rarest word fixes the start, every other is within two places of its own.
terms AS (SELECT DISTINCT t, generate_subscripts(t, 1) AS k, unnest(t) AS term FROM win),
tok AS (SELECT n, generate_subscripts(w, 1) AS pos, unnest(w) AS term FROM doc),
freq AS (SELECT term, count(*) AS f FROM tok GROUP BY term),
first_term AS (SELECT t, arg_min(struct_pack(k := k, term := term), f * 1000 + k) AS r FROM terms JOIN freq USING (term) GROUP BY t),
cand AS (SELECT a.t, b.n, b.pos - a.r.k AS start FROM first_term a JOIN tok b ON b.term = a.r.term),
near AS (SELECT c.t, c.n, c.start FROM cand c JOIN terms m ON m.t = c.t
    JOIN tok b ON b.n = c.n AND b.term = m.term AND b.pos BETWEEN c.start + m.k - 2 AND c.start + m.k + 2
    GROUP BY c.t, c.n, c.start HAVING count(DISTINCT m.k) = len(c.t)),
close AS (SELECT n, item_id FROM near JOIN win USING (t) GROUP BY n, item_id EXCEPT SELECT n, item_id FROM hit),
closes AS (SELECT n, count(*) AS n_near FROM close GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN covered USING (n) LEFT JOIN named USING (n) LEFT JOIN closes USING (n)
"""


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syncmer fingerprint of every document and of its edited text."""
    return syncmers.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of passages that also start earlier."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


#: Score from which a document counts as toxic.
TOXIC_FROM = 0.7


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learnt from the labels that are not held out."""
    return toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find(docs, secrets.learn(docs)))


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that also stand in a later document, and in a third one."""
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


CHECKS["op11_line_dedup"] = f"""
WITH doc AS (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT n, doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS t FROM doc),
keyed AS (SELECT *, {_LOWER.format("trim(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM line),
often AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT n) >= 3),
judged AS (SELECT l.*, o.k IS NOT NULL AND l.doc_id IS DISTINCT FROM o.top AS gone FROM keyed l LEFT JOIN often o ON l.k = o.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(t, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY n
"""


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of periodic words in every document, a tenth of them with a planted run."""
    found = periods.find_runs(table(spark, sf_dir, "documents"), periods.plant)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    top = found.select("doc_id", "runs", listed.alias("listed"), "collapsed", longest.alias("top"))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.l")).alias("length"),
        F.col("top.period").alias("period"), F.floor(F.lit(-1000) * F.col("top.l") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
CHECKS["op13_ranked_search"] = f"""
WITH doc AS (SELECT row_number() OVER () AS n, doc_id, {_TERMS} AS w FROM documents),
item AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM doc WHERE len(w) > 0),
tf AS (SELECT n, term, count(*) AS tf FROM (SELECT n, unnest(w) AS term FROM doc) GROUP BY n, term),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, n_docs),
sized AS (SELECT n, doc_id, 25 + (75 * len(w)::BIGINT * n_docs) // n_terms AS m FROM doc, totals),
asked AS (SELECT i, item_id, unnest(w) AS term FROM item),
scored AS (SELECT i, any_value(item_id) AS item_id, n, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN sized USING (n) GROUP BY i, n),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
