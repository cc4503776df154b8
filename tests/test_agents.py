"""User agents by a table of rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace import PipelineConfig
from millrace.operators.agents import literal_runs, read_agents, with_agents

RULES = "kind string, ord int, pattern string, family string, major string"


def plain(agents, rules):
    """Each agent's first matching rule of each kind, all rules tried."""
    out = {}
    for ua in agents:
        found = {}
        for kind, _, pattern, family, major in sorted(rules, key=lambda r: (r[1], r[2] or "")):
            match = re.search(pattern, ua) if pattern and kind in ("browser", "os", "device") else None
            if match and kind not in found:
                fill = lambda t: (re.sub(r"\$(\d)", lambda g: match[int(g[1])] or "", t).strip() or None) if t is not None else None  # noqa: B023, E731
                found[kind] = (fill(family), fill(major))
        named = {k: v for k, v in found.items() if v[0]}
        browser, os, device = (named.get(k, ("Other", None)) for k in ("browser", "os", "device"))
        if {browser[0], os[0], device[0]} != {"Other"}:
            out[ua] = {"browser_family": browser[0], "browser_version": browser[1], "os_family": os[0], "os_version": os[1], "device_family": device[0]}
    return out


def rules_and_agents(seed=1):
    rng = random.Random(seed)
    rules = [("browser", i, rf"Prod{i}/(\d+)\.(\d+)", f"Prod {i}", "$1") for i in range(1200)]
    rules += [("browser", 3, r"Prod3/9", "Nine", "$0x"), ("browser", 5000, r"(Prod\d+)(?:/(\d+))?", "$1!", "$2"), ("browser", 5001, "(?i)^MOZILLA", "Mozilla", None), ("browser", 5002, "^$", "Empty", None)]
    rules += [("os", 1, r"Win(?:dows)? NT (\d+)", "Windows", "$1"), ("os", 2, "Linux|BSD", "Unix", ""), ("os", 3, r"[Mm]ac\b", None, "1"), ("os", 9, "Ωmega", "Greek", None)]
    rules += [("device", 1, r"\(([a-z]+) phone\)", "$1", None), ("device", 2, r"colou?r\.x{2,3}yz+q", "Quantified", None), ("device", 2, r"a.c[.]d", "Dotted", None), ("tv", 1, "Prod", "no kind", None), ("os", 0, None, "no pattern", None)]
    agents = [f"Prod{rng.randrange(1300)}/{rng.randrange(30)}.{rng.randrange(9)} ({rng.choice(['Windows NT 10', 'Win NT 6', 'FreeBSD', 'Linux', 'mac x', 'macx', 'Ωmega'])})" for _ in range(400)]
    agents += ["", "a", "mozilla/5", "Prod3/9.1", "Prod77", "x (blue phone) y", "x ( phone)", "color.xxyzq", "colour.xxxyzzzq", "colour.xyzq", "abc.d", "a\nc.d", "PROD5/1.1", "Prod5/x", "z" * 5000]
    return rules, sorted(set(agents))


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_first_match_of_each_kind(spark, limit):
    rules, agents = rules_and_agents()
    table = spark.createDataFrame(rules + rules[:50], RULES).repartition(3)
    rows = spark.createDataFrame([(a,) for a in agents], "ua string")
    got = {r["ua"]: r["info"] for r in read_agents(rows, table, PipelineConfig(broadcast_limit_rows=limit)).collect()}
    assert got == plain(agents, rules)
    assert sum(v["browser_family"].startswith("Prod ") for v in got.values()) > 200


@pytest.mark.parametrize(
    "pattern,texts",
    [
        ("Chrome/", {"chro", "hrom", "rome", "ome/"}),
        (r"Abcd\.efgh", {"abcd", "efgh"}),
        ("abcde?", {"abcd"}),
        ("abcd+e", {}),
        ("abc", {}),
        ("abcd|efgh", {}),
        ("(abcd)efgh", {"efgh"}),
        ("(?:a(b(c)d))efgh", {"efgh"}),
        ("(?x)ab cd", {}),
        (r"\Qabcd\E", {}),
        ("[abcd]efgh", {"efgh"}),
        ("[[a-d]&&[^b]]efgh", {"efgh"}),
        (r"[\]]efgh", {"efgh"}),
        (r"\x41bcd\p{Lu}efgh\wijkl", {"efgh", "ijkl"}),
        ("abcd{0}efgh", {"efgh"}),
        ("^abcd.efgh$", {"abcd", "efgh"}),
    ],
)
def test_literal_runs(spark, pattern, texts):
    found = spark.createDataFrame([(pattern,)], "p string").select(literal_runs(F.col("p")).alias("r")).first()["r"]
    if pattern == "abcde?":
        assert set(found) == {"abcd"}
    else:
        assert set(found) == set(texts)


def test_runs_are_in_every_match(spark):
    """What is called certain is in each text that the pattern is found in."""
    rules, agents = rules_and_agents(3)
    patterns = sorted({r[2] for r in rules if r[2]})
    rows = spark.createDataFrame([(p,) for p in patterns], "p string").select("p", literal_runs(F.col("p")).alias("r")).collect()
    assert sum(bool(r["r"]) for r in rows) > 1000
    for r in rows:
        for ua in agents[:120]:
            if re.search(r["p"], ua):
                assert all(x in ua.encode().lower().decode() for x in r["r"])  # A-Z only


def test_plan_does_not_grow_with_the_rules(spark):
    rules, agents = rules_and_agents()
    rows = spark.createDataFrame([(a,) for a in agents[:20]], "ua string")
    sizes = set()
    for n in (10, 1200):
        found = read_agents(rows, spark.createDataFrame(rules[:n], RULES), PipelineConfig())
        sizes.add(len(found._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert len(sizes) == 1


def test_payloads_with_several_agents(spark):
    table = spark.createDataFrame([("browser", 1, r"abcd/(\d)", "A", "$1")], RULES)
    items = "array<struct<params: map<string, string>>>"
    rows = [(1, [({"ua": "abcd/1"},), ({"ua": "abcd/2"},), ({"x": "y"},)]), (2, [({"ua": "none"},)]), (3, []), (4, None), (5, [({"ua": "abcd/2"},), ({"ua": "abcd/1"},)])]
    for limit in (0, 1000):
        got = {r["id"]: r["agents"] for r in with_agents(spark.createDataFrame(rows, f"id int, items {items}"), table, PipelineConfig(broadcast_limit_rows=limit)).collect()}
        assert set(got) == {1, 2, 3, 4, 5} and got[2] is got[3] is got[4] is None
        assert {k: v["browser_version"] for k, v in got[1].items()} == {"abcd/1": "1", "abcd/2": "2"} == {k: v["browser_version"] for k, v in got[5].items()}


def test_no_rules_and_no_agents(spark):
    rows = spark.createDataFrame([("abcd",)], "ua string")
    rules = spark.createDataFrame([("os", 1, "abcd", "A", None)], RULES)
    assert read_agents(rows, rules.limit(0), PipelineConfig()).collect() == []
    assert read_agents(rows.limit(0), rules, PipelineConfig()).collect() == []
