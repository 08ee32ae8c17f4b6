import math
from collections import defaultdict

from pyspark.sql import functions as F

from quarrysight.llm import url_reputation as U
from quarrysight.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, n long, bad long, verdict string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", 1, 1, "v") for i, u in enumerate(urls)], PAGES)


def test_rules_hosts_and_paths(spark):
    urls = ["http://a.NET/x", "https://m.example.net/en/1?q", "https://m.example.net/en", "http://example.com/de/#f",
            "http://myexample.com/de/", "http://x.org/fr/2", "http://net", None, "no url", "http://ÄB.com?x=/y/", "://q.net/",
            "http://a.net\n/x"]
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: r for r in U.judge_urls(pages(spark, urls), none, URL_RULES).collect()}
    want = [("a.net", "/x", "net/", "block"), ("m.example.net", "/en/1", "example.net/en/", "allow"),
            ("m.example.net", "/en", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"),
            ("myexample.com", "/de/", None, "allow"), ("x.org", "/fr/2", "org/fr/", "allow"), ("net", "", None, "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("Äb.com", "", None, "allow"), ("q.net", "/", "net/", "block"),
            ("a.net\n", "/x", None, "allow")]
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == want


def brute(hosts, labels):
    """hosts: page -> (host, domain, suffix); labels: page -> bad."""
    n, b = defaultdict(int), defaultdict(int)
    for p, (h, d, s) in hosts.items():
        for k in (h, (d, s), ("suffix", s), "all"):
            n[k] += p in labels
            b[k] += labels.get(p, 0)
    prior = (b["all"] + 1) / (n["all"] + 2)

    def weight(level, mean):
        level = [k for k in level if n[k]]
        p = sum(mean[k] * (1 - mean[k]) for k in level)
        q = sum(mean[k] * (1 - mean[k]) * (n[k] - 1) for k in level)
        s = sum(n[k] * (b[k] / n[k] - mean[k]) ** 2 for k in level)
        rho = min(0.5, max(1 / 1001, (s - p) / q)) if q else 1 / 1001
        return 1 / rho - 1

    suffixes = {("suffix", s) for _, _, s in hosts.values()}
    up = {k: prior for k in suffixes}
    w = weight(suffixes, up)
    mean = {k: (b[k] + w * up[k]) / (n[k] + w) for k in suffixes}
    up = {(d, s): mean["suffix", s] for _, d, s in hosts.values()}
    w = weight(set(up), up)
    mean = {k: (b[k] + w * up[k]) / (n[k] + w) for k in up}
    up = {h: mean[d, s] for h, d, s in hosts.values()}
    w = weight(set(up), up)
    out = {}
    for h in up:
        x, y = b[h] + w * up[h], n[h] - b[h] + w * (1 - up[h])
        m = x / (x + y)
        out[h] = m - U.Z * math.sqrt(m * (1 - m) / (x + y + 1))
    return out


def test_posterior_against_brute_force(spark):
    hosts, labels, urls = {}, {}, []
    for i in range(300):
        bad = i % 3 == 0
        d, s = ("spam.co.uk", "co.uk") if bad else ("fine.com", "com") if i % 3 == 1 else ("10.0.0.1", "")
        h = d if d[0] == "1" else f"h{i % 7}.{d}"
        hosts[i] = (h, d, s)
        urls.append(f"http://{h}/{i}")
        if i % 2:
            labels[i] = int(bad or i % 11 == 0)
    out = spark.createDataFrame(list(labels.items()), "page_id long, bad int")
    parts = pages(spark, urls).select("page_id", U.host_of(F.col("url")).alias("host"))
    got = {r.host: r.bound for r in U.host_reputation(parts, out).collect()}
    want = brute(hosts, labels)
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in got)
    verdict = {r.host: r.verdict for r in U.judge_urls(pages(spark, urls), out, ()).collect()}
    assert {h for h, v in verdict.items() if v == "block"} == {h for h in want if want[h] > 0.5} != set()


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    assert U.judge_urls(pages(spark, []), none, URL_RULES).count() == 0
    twice = pages(spark, ["http://a.com/"]).union(pages(spark, ["http://a.com/"]))
    assert U.judge_urls(twice, none, URL_RULES).count() == 2
