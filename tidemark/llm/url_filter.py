"""URL block and allow rules, carried over to aliases by redirect equivalence.

Rules match by host (with subdomains) and path prefix through equi-joins. Pages
and the targets of their redirects and canonical links form a graph; a block
reaches every page of its component, unless a rule allows a member.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.session import stored
from tidemark.llm.graph import components
from tidemark.llm.text import free_name

ALLOW, BLOCK = "allow", "block"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a table for ``judge``."""
    return spark.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), rule, strict=True))) for rule in rules))))


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A to Z lowered), path, and query with its question mark. No ``://``: all empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, "^[^?#]*([^#]*)", 1)


def html_links(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and meta refresh redirects in ``html``.

    A target may be absolute, start with ``//``, ``/`` or ``?``, or stand beside the page's path; dots
    in it are not resolved. Null html, null urls, empty and fragment targets give no row.
    """
    host, path, _ = url_parts(F.col("url"))
    html = F.col("html").cast("string")

    def targets(tag: str, kind: str, value: str) -> Column:
        tags = F.filter(F.regexp_extract_all(html, F.lit(f"(?i)<{tag}\\b[^>]*>"), 0), lambda t: t.rlike(kind))
        return F.transform(tags, lambda t: F.regexp_extract(t, value, 1))

    wanted = pages.where(F.col("url").isNotNull() & html.rlike("(?i)canonical|refresh")).select(
        "url", host.alias("_host"), path.alias("_path"), F.explode(F.concat(
            targets("link", "(?i)\\brel\\s*=\\s*[\"']?canonical", "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"),
            targets("meta", "(?i)\\bhttp-equiv\\s*=\\s*[\"']?refresh", "(?i)\\burl\\s*=\\s*[\"']?([^\"'\\s>;]+)"),
        )).alias("target"))
    t = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    base = F.concat(F.lit("x://"), F.col("_host"))
    full = (F.when(t.rlike("^(#|$)"), F.lit(None)).when(F.instr(t, "://") > 0, t)
            .when(t.startswith("//"), F.concat(F.lit("x:"), t)).when(t.startswith("/"), F.concat(base, t))
            .when(t.startswith("?"), F.concat(base, F.col("_path"), t))
            .otherwise(F.concat(base, F.regexp_extract("_path", "^(.*/)?", 0), t)))
    return wanted.select("url", full.alias("target")).where("target is not null")


def node(url: Column) -> Column:
    """What two spellings of an address share: host, path and query. Null if there is no host."""
    host, path, query = url_parts(url)
    return F.when(host != "", F.concat(host, path, query))


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct places that a rule fits; the longest rule wins.

    A rule fits its host and all subdomains if the path starts with the rule's path. Rules with a null
    are ignored; of equal rules with both verdicts, allow counts. Each place meets only rules that its
    own suffixes and prefixes name, so the work follows the number of places, not of pairs.
    """
    known = rules.dropna(subset=["verdict", "host", "path"]).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    lengths = known.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.length("path")).alias("lengths"))
    deepest = known.agg(F.max(F.size(F.split("host", "\\.")))).first()[0] or 0
    labels = F.split("host", "\\.")
    depth = F.least(F.size(labels), F.lit(deepest))
    suffixes = F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    near = (places.select("host", "path").where("host <> ''").where(F.lit(deepest > 0)).distinct()
            .withColumn("suffix", F.explode(suffixes)).join(lengths, "suffix")
            .withColumn("length", F.explode("lengths")).where(F.col("length") <= F.length("path"))
            .withColumn("prefix", F.substring("path", F.lit(1), F.col("length"))))
    fits = near.join(known.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict"), ["suffix", "prefix"])
    rule = F.concat("suffix", "prefix")
    return fits.groupBy("host", "path").agg(F.max_by(
        F.struct(rule.alias("rule"), "verdict"), F.struct(F.length(rule), F.length("suffix"))).alias("best")).select("host", "path", "best.*")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``url`` of every row of ``pages`` with host, path, rule, verdict and ``reason``.

    A page that a rule fits has the rule's verdict. Any other page takes the decision of its component
    of ``links`` (url, target; by default those of ``html``): allow if a rule allows a member, else
    block if a rule blocks one, else allow. Null urls and urls without ``://`` are allowed, with
    empty host and path. Rows and extra columns of ``pages`` are kept, except that columns named like
    the results are replaced; no rows give none.
    """
    host, path, _ = url_parts(F.col("url"))
    spot, alias = free_name("node", pages), free_name("alias", pages)
    placed = pages.drop("host", "path", "rule", "verdict", "reason").withColumns({"host": host, "path": path, spot: node(F.col("url"))})
    ends = stored((html_links(pages) if links is None else links).select("url", "target").dropna().distinct())
    spots = ends.select("url").unionByName(ends.select(F.col("target").alias("url"))).distinct()
    host, path, _ = url_parts(F.col("url"))
    spots = stored(spots.select(node(F.col("url")).alias("node"), host.alias("host"), path.alias("path")).where("node is not null").distinct())
    matched = stored(match_rules(placed.select("host", "path").unionByName(spots.select("host", "path")), rules))

    roots = components(ends.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b")))
    ruled = roots.join(spots.join(matched, ["host", "path"]), "node")
    decided = ruled.groupBy("root").agg(F.min("verdict").alias(alias))  # allow sorts before block
    aliases = roots.join(decided, "root").select(F.col("node").alias(spot), alias)
    return placed.join(matched, ["host", "path"], "left").join(aliases, spot, "left").withColumns({
        "reason": F.when(F.col("rule").isNotNull(), "rule").when(F.col(alias).isNotNull(), "alias").otherwise("default"),
        "verdict": F.coalesce("verdict", alias, F.lit(ALLOW))}).drop(spot, alias)
