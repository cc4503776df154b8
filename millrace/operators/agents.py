"""User agents by a table of ordered rules.

Rules are data: a kind (browser, os or device), an order, a pattern and what it tells. Each rule is filed under one run of
four characters that every text it matches must hold, of all its runs the one that the fewest agents have. Distinct agents
fetch the rules of their runs by equi-join, and only those run their pattern; the first of each kind counts. Patterns
without such a run (alternatives, classes, short literals) are tried on every agent. What is found goes back to the payloads
by the set of agents they name, so a frequent agent is looked at once, and the plan is the same for any number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import PipelineConfig
from millrace.operators.lookup import lookup_join
from millrace.operators.staging import staged

#: Length of the literal runs under which rules are filed.
RUN = 4
KINDS = ("browser", "os", "device")
OTHER = "Other"
AGENTS = "MAP<STRING, MAP<STRING, STRING>>"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CUT = "\u0001"
# Parts of a pattern that stand for no certain text, in the order in which they are cut out.
_ESCAPE = r"\\(?:[pP]\{[^}]*\}|[pP].|x\{[^}]*\}|x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|k<[^>]*>|0[0-7]{1,3}|c.|N\{[^}]*\}|.)"
_CLASS, _GROUP = r"\[[^\[\]]*\]", r"\([^()]*\)"
_REPEATED = r"(?s).(?:[?*+]|\{[0-9,]*\})[?+]?"
#: Patterns that are not looked into: quoting, and flags that change what a literal stands for.
_OPAQUE = r"\\Q|\(\?[a-zA-Z-]*[xu]"
_NESTED = 8


def _small(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _runs_of(text: Column) -> Column:
    return F.when(F.length(text) >= RUN, F.transform(F.sequence(F.lit(1), F.length(text) - (RUN - 1)), lambda i: F.substring(text, i, RUN))).otherwise(F.array().cast("array<string>"))


def literal_runs(pattern: Column) -> Column:
    """Runs of RUN characters (A-Z as a-z) that every text the pattern matches holds; empty where none is certain."""
    left = F.regexp_replace(pattern, _ESCAPE, _CUT)
    for cut in [_CLASS] * 3 + [_GROUP] * _NESTED:
        left = F.regexp_replace(left, cut, _CUT)
    unclear = pattern.rlike(_OPAQUE) | left.rlike(r"[\[\]()|]")
    sure = F.split(F.regexp_replace(F.regexp_replace(left, _REPEATED, _CUT), r"[.^$]", _CUT), _CUT)
    return F.when(unclear, F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(F.transform(_small_all(sure), _runs_of))))


def _small_all(texts: Column) -> Column:
    return F.transform(texts, _small)


def agent_runs(agent: Column) -> Column:
    """The distinct runs of an agent, and the empty text, under which the rules without a run are filed."""
    return F.array_union(F.array(F.lit("")), _runs_of(_small(agent)))


def _filled(template: Column, agent: Column, pattern: Column) -> Column:
    """The template with $1 to $9 replaced by the pattern's groups; an empty result is null."""
    def fill(text: Column, group: Column) -> Column:
        mark = F.concat(F.lit("$"), group)
        return F.when(F.contains(text, mark), F.replace(text, mark, F.call_function("regexp_extract", agent, pattern, group.cast("int")))).otherwise(text)

    filled = F.aggregate(F.array(*[F.lit(str(g)) for g in range(1, 10)]), template, fill)
    return F.nullif(F.trim(filled), F.lit(""))


def read_agents(agents: DataFrame, rules: DataFrame, config: PipelineConfig) -> DataFrame:
    """``(ua, info)`` of distinct, non-null agents (``ua``) of which some rule tells a family other than ``Other``.

    ``rules`` has ``kind, ord, pattern, family, major``: a Java pattern that is searched for, and templates in which $1 to
    $9 stand for its groups. Of each kind the matching rule with the smallest ``ord`` counts, of equal ones the smaller
    pattern. A kind without a match, or a rule without family, is ``Other`` without a major version. Rows without kind or
    pattern are left out; a pattern that does not compile, or a template that names a group it lacks, ends the job.
    """
    agents = staged(agents.select("ua"), "agents")
    rules = rules.where(F.col("kind").isin(*KINDS) & F.col("pattern").isNotNull()).select("kind", "ord", "pattern", "family", "major").distinct()
    rules = rules.withColumn("runs", literal_runs(F.col("pattern")))
    named = rules.select(F.explode(F.array_union("runs", F.array(F.lit("")))).alias("run")).distinct()
    runs = agents.select("ua", F.explode(agent_runs(F.col("ua"))).alias("run")).join(_sized(staged(named, "named"), config), "run", "left_semi")
    runs = staged(runs, "runs")
    frequency = staged(runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")), "frequency")
    # a run that no agent has leaves its rule without any; rules without runs are filed under the empty text
    filed = rules.select("kind", F.struct("ord", "pattern", "family", "major").alias("rule"), F.explode_outer("runs").alias("run")).join(_sized(frequency, config), "run", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("run", F.lit("")).alias("run"))).alias("rarest")
    filed = staged(filed.groupBy("kind", "rule").agg(rarest).select("kind", "rule", F.col("rarest.run").alias("run")), "rules")
    tried = runs.join(_sized(filed, config), "run").where(F.rlike("ua", F.col("rule.pattern")))
    first = tried.groupBy("ua", "kind").agg(F.min("rule").alias("rule"))
    told = first.select("ua", "kind", _filled(F.col("rule.family"), F.col("ua"), F.col("rule.pattern")).alias("family"), _filled(F.col("rule.major"), F.col("ua"), F.col("rule.pattern")).alias("major"))
    by_kind = told.groupBy("ua").agg(*[F.max(F.when(F.col("kind") == k, F.struct("family", "major"))).alias(k) for k in KINDS])  # three rows an agent at most
    family = {k: F.coalesce(F.col(f"{k}.family"), F.lit(OTHER)) for k in KINDS}
    major = {k: F.when(F.col(f"{k}.family").isNotNull(), F.col(f"{k}.major")) for k in KINDS}
    info = F.create_map(
        F.lit("browser_family"), family["browser"], F.lit("browser_version"), major["browser"], F.lit("os_family"), family["os"], F.lit("os_version"), major["os"], F.lit("device_family"), family["device"]
    )
    return by_kind.where((family["browser"] != OTHER) | (family["os"] != OTHER) | (family["device"] != OTHER)).select("ua", info.alias("info"))


def _sized(table: DataFrame, config: PipelineConfig) -> DataFrame:
    """A table for a join, broadcast where it has few rows, counted."""
    return F.broadcast(table) if table.limit(config.broadcast_limit_rows + 1).count() <= config.broadcast_limit_rows else table


def with_agents(df: DataFrame, rules: DataFrame, config: PipelineConfig) -> DataFrame:
    """Add ``agents`` to payloads with ``items``: what the rules tell of each agent that an event of the payload names."""
    df = df.withColumn("_agents", F.expr("array_sort(array_distinct(filter(transform(coalesce(items, array()), it -> it.params['ua']), u -> u IS NOT NULL)))"))
    sets = staged(df.select("_agents").where("size(_agents) > 0").distinct(), "agent_sets")
    wanted = sets.select("_agents", F.explode("_agents").alias("ua"))
    found = staged(read_agents(wanted.select("ua").distinct(), rules, config), "agents_found")
    entries = wanted.join(found, "ua").groupBy("_agents").agg(F.map_from_entries(F.collect_list(F.struct("ua", "info"))).cast(AGENTS).alias("agents"))  # as many as a payload names
    held = "aggregate(map_keys(agents), 0L, (n, k) -> n + 3 * octet_length(k) + 200)"
    return lookup_join(df, staged(entries, "agent_maps"), ["_agents"], config, held).drop("_agents")
