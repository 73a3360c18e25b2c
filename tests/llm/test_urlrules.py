import random

from snapflow.llm import urlrules
from snapflow.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    host, path = cut(url)
    best = None
    for h, p, v in rules:
        if h is None:
            continue
        p = p or ""
        if (host == h or host.endswith("." + h) or h == "") and path.startswith(p):
            score = (len(h + p), len(h), v == "block")
            if best is None or score > best[0]:
                best = (score, h + p, v)
    return host, path, best and best[1], best[2] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "url as host", "1 as key")
    got = {r["page_id"]: tuple(r)[1:] for r in urlrules.judge(pages, spark.createDataFrame(rules, RULES)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_fixed_rules_and_awkward_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://org/", "http://ORG", "https://a.example.org/es/x", "https://example.org/en/1",
            "https://x.example.org/en/123?q=/es/", "http://notexample.org/es/", "http://com/fr/", "http://a.com/fr/#x", "http://a.com/de/?",
            "http://a.com?/de/", "x://a.b://c.com/de/", "http://a.org\n/es/", "http://É.org/", "http://example.org./es/", "http://.org/",
            "http://a..org/", "https://user@m.example.org/es/" + "p" * 5000] * 3
    check(spark, urls, URL_RULES)


def test_nested_rules_in_groups(spark, monkeypatch):
    rng = random.Random(5)
    labels, paths = ["a", "b", "ab", "c"], ["", "/", "/a", "/a/", "/a/b", "/b"]
    rules = [(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40)]
    rules += [(None, "/", "block"), ("c", None, "block"), rules[0][:2] + ("allow",), rules[0][:2] + ("block",)]
    urls = ["http://" + ".".join(rng.choices(labels, k=rng.randint(1, 4))) + rng.choice(paths) + rng.choice(["", "x", "/b/c"]) for _ in range(300)]
    check(spark, urls, rules)
    monkeypatch.setattr(urlrules, "GROUP_RULES", 7)
    check(spark, urls, rules)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judge(none, spark.createDataFrame(URL_RULES, RULES)).collect() == []
    check(spark, ["http://a.org/"], [("com", "/", "block")])
    pages = spark.createDataFrame([(None, "http://a.com/")], "page_id long, url string")
    assert tuple(urlrules.judge(pages, spark.createDataFrame([], RULES)).first()) == (None, "a.com", "/", None, "allow")
