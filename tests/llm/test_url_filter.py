import random

from panelcast.llm import url_filter
from panelcast.llm.url_filter import bloom_blocks, judge, possible


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fit, default=(0, 0, None, default))
    return host, path, rule, verdict


def cases():
    r = random.Random(5)
    names = ["a", "b", "example", "Example", "x-y", "é"]
    tops = ["net", "com", "org", "NET"]
    urls = [None, "", "no scheme", "://", "http://", "http://net", "http://net/", "x://net?q", "s://a://net/", "http://a..net/x",
            "http://net/\n", "http://net./x", "http://u@net:80/x", "http://" + "a." * 200 + "net/" + "p" * 5000]
    for _ in range(600):
        host = ".".join([r.choice(names) for _ in range(r.randint(0, 3))] + [r.choice(tops)])
        urls.append(f"https://{host}" + r.choice(["", "/", "/en/", "/en/x?q=/de/", "/e", "#/en/", "?x", "/de/a/b"]))
    return urls + urls[:50]


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("com", "/e", "allow"), ("example.com", "/de/", "block"), ("org", "", "block")]


def check(spark, rules):
    urls = cases()
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")
    listed = spark.createDataFrame([*rules, rules[0], (None, "/", "block")], "host string, path string, verdict string")
    got = {x["row"]["page_id"]: (x["host"], x["path"], x["rule"], x["verdict"]) for x in judge(pages, listed).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_judge_matches_brute_force(spark, monkeypatch):
    check(spark, RULES)
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    check(spark, RULES + [(f"h{i}.com", "/", "block") for i in range(3000)])


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert judge(pages, none).first()["verdict"] == "allow"
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge(pages.limit(0), rules).count() == 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    n = 20_000
    blocks = n // url_filter.ENTRIES_PER_BLOCK + 1
    keys = spark.range(n).selectExpr("concat('in', id) key")
    bloom = bloom_blocks(keys, blocks)
    assert possible(keys, bloom, blocks).count() == n
    assert possible(spark.range(n).selectExpr("concat('out', id) key"), bloom, blocks).count() < 0.02 * n
