import re

from pyspark.sql import functions as F

from millrace.llm.url_rules import QUERY_RULES, host_path_rules, judge_urls

URLS = [
    "http://a.example.net/en/5?x=1", "HTTP://EXAMPLE.NET/en/", "https://example.net/de/1", "http://www.example.com/de/", "http://example.com/de", "http://b.org/fr/#x",
    "http://notnet/", "http://x.net", "http://x.net?a=/", "http://x.net/", "net/", "", None, "://net/", "http://example.net/EN/", "a://b.net/en/://c.org/fr/", "http://examplenet/en/", "http://x.net:80/", None,
]


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(r), a, r) for a, r in QUERY_RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_contract_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = judge_urls(pages, host_path_rules(spark, QUERY_RULES))
    assert got.columns == ["page_id", "url", "verdict", "host", "path", "rule", "_verdict"]
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["_verdict"]) for r in got.collect()} == {i: brute(u) for i, u in enumerate(URLS)}


def test_repeated_rows_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")] * 5, "page_id long, url string")
    rules = host_path_rules(spark, QUERY_RULES)
    assert [r["verdict"] for r in judge_urls(pages, rules).collect()] == ["block"] * 5
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert [r["verdict"] for r in judge_urls(pages, rules.limit(0), default="block").collect()] == ["block"] * 5


def test_patterns_fetch_by_token_what_their_expression_fits(spark):
    patterns = ["||ads^", "*/banner/*", "|x.org/a", "/pop.js|", "*", "track*er", "||b.com/p?q^", "||caf.net/É*"]
    urls = [f"http://{h}{p}" for h in ("ads", "my.ads", "loads", "x.org", "y.x.org", "b.com", "caf.net") for p in ("", "/", "/a/banner/1", "/pop.js", "/pop.jsx", "/a", "/tracker", "/track-1-er", "/É1")]
    rules = spark.createDataFrame([(p, "block", p) for p in patterns], "rule string, action string, pattern string")
    one_by_one = {}
    for p in patterns:
        regex = re.sub(r"[\\.+?$|(){}\[\]]", r"\\\g<0>", p.removeprefix("||") if p.startswith("||") else p.removeprefix("|")).removesuffix("\\|")
        regex = regex.replace("^", r"(?:[^0-9A-Za-z_.%-]|\Z)").replace("*", ".*") + (r"\Z" if p.endswith("|") else "")
        start = r"\A(?:[^/?#]*\.)?" if p.startswith("||") else r"\A" if p.startswith("|") else ""
        one_by_one[p] = {u for u in urls if re.search(start + regex, u.split("://", 1)[1], re.S)}
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    for p in patterns:
        got = judge_urls(pages, rules.where(F.col("rule") == p)).where("rule is not null")
        assert {r["url"] for r in got.collect()} == one_by_one[p], p
