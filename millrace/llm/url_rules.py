"""URL filter: pattern rules indexed by their rarest literal token (DataFrame operations only).

A rule's pattern is an ad-block style text: ``||`` at the start anchors it at a host or any of its parent domains, ``|``
at the start or end anchors it there, ``*`` stands for any text and ``^`` for a separator or the end. It is matched with
the URL's host and path. Each rule is filed under one literal token: the one that the fewest URLs have. A URL looks up
its own tokens, and only the rules found that way run their regular expression. A rule without a whole literal token is
filed under the empty token, which every URL looks up.

Nothing is grouped by host or token: look-ups are equi-joins from distinct URLs to the index, so a common token or host
is split by Spark's skew handling, and the verdicts return to all rows by an equi-join on the URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, free_name, table

#: The rules of the registered query, as action and host with path.
QUERY_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

TOKEN = "[0-9a-z]+"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_path_rules(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules (action, "host/path") as a table for judge_urls: the host and its subdomains, paths that start so."""
    rows = [F.struct(F.lit(a).alias("action"), F.lit(r).alias("rule"), F.lit(f"||{r}").alias("pattern")) for a, r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _compiled(rules: DataFrame) -> DataFrame:
    """Each rule with its regular expression and its whole literal tokens."""
    p = F.col("pattern")
    at_host, at_start = p.startswith("||"), p.startswith("|")
    at_end = p.endswith("|") & (F.length(p) > F.when(at_host, 2).when(at_start, 1).otherwise(0))
    body = F.regexp_replace(F.regexp_replace(p, r"^\|\|?", ""), r"\|$", "")
    regex = F.regexp_replace(body, r"([\\.+?$|(){}\[\]])", r"\\$1")
    regex = F.regexp_replace(regex, r"\^", r"(?:[^0-9A-Za-z_.%-]|\\z)")
    regex = F.regexp_replace(regex, r"\*", ".*")
    start = F.when(at_host, r"^(?:[^/?#]*\.)?").when(at_start, "^").otherwise("")
    edges = F.concat(F.when(at_start, "|").otherwise("*"), ascii_lower(body), F.when(at_end, "|").otherwise("*"))
    return rules.select(
        "rule",
        "action",
        F.concat(F.lit("(?s)"), start, regex, F.when(at_end, r"\z").otherwise("")).alias("regex"),
        F.regexp_extract_all(edges, F.lit(f"(?<![0-9a-z*]){TOKEN}(?![0-9a-z*])"), F.lit(0)).alias("tokens"),
    ).distinct()


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``urls`` plus host, path, rule (null if none fits) and verdict.

    ``rules`` has columns rule, action and pattern. Of the rules that fit, the longest rule text wins; of equally long
    ones an ``allow`` rule, then the last in text order. Without a rule the verdict is ``default``. A null, empty or
    relative URL has an empty host and path, and only a pattern that fits the empty text fits it. Repeated rows stay
    repeated, an empty table gives an empty result, and a column already called like an output keeps its name while the
    output's name gets underscores in front.
    """
    out = {}
    for name in ("host", "path", "rule", "verdict"):
        out[name] = free_name(urls, name)
    key = free_name(urls, "target")
    target = F.concat(url_host(F.col(url_col)), url_path(F.col(url_col)))
    targets = urls.select(target.alias("target")).distinct()
    looked_up = targets.select(
        "target",
        F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(ascii_lower(F.col("target")), F.lit(TOKEN), F.lit(0))))).alias("token"),
    )
    compiled = _compiled(rules)
    options = compiled.select("rule", "action", "regex", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    how_often = looked_up.join(options.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    index = (
        options.join(how_often, "token", "left")
        .groupBy("rule", "action", "regex")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest"))
        .select(F.col("rarest.token").alias("token"), "rule", "action", "regex")
    )
    hits = (
        looked_up.join(index, "token")
        .where(F.expr("target rlike regex"))
        .groupBy("target")
        .agg(F.max(F.struct(F.length("rule"), (F.col("action") == "allow").alias("allows"), F.col("rule"), F.col("action"))).alias("best"))
        .select(F.col("target").alias(key), F.col("best.rule").alias(out["rule"]), F.col("best.action").alias(out["verdict"]))
    )
    judged = urls.withColumns({key: target, out["host"]: url_host(F.col(url_col)), out["path"]: url_path(F.col(url_col))})
    judged = judged.join(hits, key, "left").drop(key)
    return judged.withColumn(out["verdict"], F.coalesce(out["verdict"], F.lit(default)))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, host_path_rules(spark, QUERY_RULES)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH rules(rule, action) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT n, rule, action, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC) AS place
  FROM parts JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""
