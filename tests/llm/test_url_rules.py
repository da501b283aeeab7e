import random
import re

from linkledger.llm.queries import URL_RULES
from linkledger.llm.url_rules import judge_urls

PAGES = "page_id long, url string, html string, rule string, verdict string, path string"
RULES = "host string, path string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def judge(url, rules, default="allow"):
    host, path = split(url)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, default)


def check(spark, urls, rules, parts):
    rows = [(k, u, "x", "y", "z", "w") for k, u in enumerate(urls)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(tuple(r) for r in got) == sorted((k, *judge(u, rules)) for k, u in enumerate(urls))


def test_contract_rules(spark):
    urls = [f"http://{h}{p}" for h in ["net", "a.net", "example.net", "WWW.Example.NET", "network", "x.example.com",
                                       "example.com", "anexample.com", "a.org", "net:80", ""]
            for p in ["", "/", "/en", "/en/", "/en/1?q=/de/", "/de/2#x", "/fr/", "?a=/en/", "#/fr/"]]
    urls += [None, "", "no scheme", "://", "http://", "a://b://net/", "http://é.net/", "http://..net/en/"]
    check(spark, urls, URL_RULES, 8)


def test_nested_rules_and_a_hot_host_over_many_partitions(spark):
    rng = random.Random(2)
    labels = ["a", "b", "c", "net", "org"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    paths = ["/", "/x", "/x/", "/x/y", "/y/", ""]
    rules = sorted({(rng.choice(hosts), rng.choice(paths)) for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '/y'])}" for _ in range(400)]
    urls += ["http://hot.a.net/x/1"] * 300
    check(spark, urls, rules, 13)


def test_empty_tables_null_ids_and_large_ids(spark):
    rules = spark.createDataFrame(URL_RULES + [(None, "/", "block")], RULES)
    assert judge_urls(spark.createDataFrame([], PAGES), rules).count() == 0
    big = 2**62 + 1
    pages = spark.createDataFrame([(None, "http://a.net/", None, None, None, None), (big, None, None, None, None, None),
                                   (big, None, None, None, None, None)], PAGES)
    got = sorted((tuple(r) for r in judge_urls(pages, rules).collect()), key=str)
    assert got == sorted([(None, "a.net", "/", "net/", "block"), (big, "", "", None, "allow"), (big, "", "", None, "allow")], key=str)
    none = judge_urls(pages, rules.limit(0), default="block").collect()
    assert {r["verdict"] for r in none} == {"block"}
