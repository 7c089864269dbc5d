"""Operator 12: urls, rules and reputations against plain versions, planted hosts, odd inputs."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dfinsight.llm import host_reputation as hr

URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://Example.Com/de/x?y#z", "http://a.example.com/de", "http://a.example.com/de/",
        "http://xexample.com/de/1", "ftp://u@b.example.net:80/en/1", "http://example.net/en/", "http://deep.er.example.net/fr/", "http://net/", "http://net",
        "http://x.org/fr/1#/de/", "http://x.org?/fr/", "http://org/fr/", "http://ÄÖ.net/", "a://b://c.net/d", "http://x.net/" + "p" * 40_000, "http://h.com/a\nb?c",
        "http://1.2.3.4:8080/", "http://shop.a.co.uk/", "http://co.uk/", "://x.com/"]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in hr.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain_split(host):
    parts = host.split(".")
    if all(x.isdigit() for x in parts) and len(parts) == 4:
        return host, "ip"
    w = 2 if len(parts) > 1 and len(parts[-1]) == 2 and parts[-2] in hr.SECOND_LEVEL else 1
    return ".".join(parts[-w - 1:]), ".".join(parts[-w:])


def plain_tail(x, a, b):
    log = lambda i: math.lgamma(a + b + i) - math.lgamma(b) - math.lgamma(a + 1 + i) + (a + i) * math.log(x) + b * math.log1p(-x)
    return math.fsum(math.exp(log(i)) for i in range(int((a + b) / (1 - x)) + 2000))


def plain_strength(nodes):
    extra = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in nodes if n > 1)
    room = sum(n * (n - 1) * m * (1 - m) for n, k, m in nodes if n > 1)
    if room <= 0:
        return hr.UNFITTED
    return hr.STRONGEST if extra <= 0 else min(hr.STRONGEST, max(hr.WEAKEST, room / extra - 1))


def plain_posteriors(counts):
    """{host: (a, b)} from {host: (n, k)}."""
    domain, suffix = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    parent = {}
    for h, (n, k) in counts.items():
        d, s = plain_split(h)
        parent[d] = s
        for t in (domain[d], suffix[s]):
            t[0] += n
            t[1] += k
    n, k = map(sum, zip(*counts.values()))
    m = (k + 0.5) / (n + 1)
    s = plain_strength([(n, k, m) for n, k in suffix.values()])
    suffix_m = {x: (s * m + k) / (s + n) for x, (n, k) in suffix.items()}
    s = plain_strength([(n, k, suffix_m[parent[d]]) for d, (n, k) in domain.items()])
    domain_m = {d: (s * suffix_m[parent[d]] + k) / (s + n) for d, (n, k) in domain.items()}
    rows = {h: (n, k, domain_m[plain_split(h)[0]]) for h, (n, k) in counts.items()}
    s = plain_strength(rows.values())
    return {h: (s * m + k, s * (1 - m) + n - k) for h, (n, k, m) in rows.items()}


@pytest.fixture(scope="module")
def planted(spark):
    """Pages of good, bad, hardly labelled and unlabelled hosts; one host holds a third of them."""
    rnd = random.Random(3)
    hosts = [("big.fine.com", 900, .05), ("bad.fine.com", 60, .97), ("new.fine.com", 5, None), *((f"w{i}.farm.info", 25, .9) for i in range(8)), ("next.farm.info", 4, None),
             *((f"s{i}.co.uk", 20, .1) for i in range(20)), ("9.8.7.6", 30, .95), ("one.fine.com", 1, 1.0), ("bad.example.net", 50, .99)]
    pages, labels = [], []
    for host, n, rate in hosts:
        for _ in range(n):
            pages.append((len(pages), f"http://{host}/en/{len(pages)}", "x", "y"))
            if rate is not None:
                bad = rnd.random() < rate
                labels.append((len(pages) - 1, int(not bad), int(bad and rnd.random() < .5)))
    pages += [pages[3], (None, "http://big.fine.com/", "x", "y"), (None, None, None, None)]
    labels += [labels[3], (None, 0, 1), (10**9, 0, 1), (5, None, None)]
    return (spark.createDataFrame(pages, "page_id long, url string, host string, bad string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_urls_and_rules_equal_plain_version(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = hr.judge(df, spark.createDataFrame([], "id long, bad int")).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = plain_url(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_registered_domain_and_suffix(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.co.uk", "co.uk", "uk", "y.x.co.uk", "shop.de", "a.shop.de", "1.2.3.4", "com.de", "a.com.de"]
    domain, suffix = hr.domain_and_suffix(F.col("h"))
    for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", domain.alias("d"), suffix.alias("s")).collect():
        assert (r.d, r.s) == plain_split(r.h)
    odd = spark.createDataFrame([("u:p@a.b.com:80",), ("a.b.com.",), ("[::1]:80",)], "h string").select(domain.alias("d"), suffix.alias("s")).collect()
    assert [tuple(r) for r in odd] == [("b.com", "com"), ("b.com", "com"), ("[::1]:80", "ip")]


def test_reputations_equal_plain_version(planted):
    pages, labels = planted
    got = {r.host: r for r in hr.judge(pages, hr.page_labels(labels)).collect()}
    label = defaultdict(int)
    for r in hr.page_labels(labels).collect():
        label[r.id] |= r.bad
    seen = {(r.page_id, plain_url(r.url)[0]) for r in pages.select("page_id", "url").collect()}
    n, k = Counter(), Counter()
    for i, h in seen:
        if i in label:
            n[h] += 1
            k[h] += label[i]
    want = plain_posteriors({h: (n[h], k[h]) for _, h in seen})
    for h, (a, b) in want.items():
        assert (got[h].n_labelled, got[h].n_bad) == (n[h], k[h])
        assert got[h].bad_rate == pytest.approx(a / (a + b), rel=1e-9) and got[h].below == pytest.approx(plain_tail(.5, a, b), rel=1e-6, abs=1e-9)


def test_planted_hosts_are_caught_and_clean_ones_left(planted):
    verdict = {r.host: r.verdict for r in hr.judge(*(planted[0], hr.page_labels(planted[1]))).collect()}
    assert {h for h, v in verdict.items() if v == "block"} >= {"bad.fine.com", "9.8.7.6", *(f"w{i}.farm.info" for i in range(8))}
    assert all(verdict[h] == "allow" for h in ("big.fine.com", "new.fine.com", "one.fine.com", "", *(f"s{i}.co.uk" for i in range(20))))
    assert verdict["bad.example.net"] == "allow"  # the rule wins


def test_rows_are_whole_and_repeats_stay(planted):
    got = hr.judge(planted[0], hr.page_labels(planted[1]))
    assert got.count() == planted[0].count() and got.filter("page_id = 3").count() == 2
    assert hr.judge(planted[0].limit(0), hr.page_labels(planted[1])).collect() == []
    assert {r.verdict for r in hr.judge(planted[0], hr.page_labels(planted[1].limit(0))).filter("rule is null").collect()} == {"allow"}


def test_beta_tail_equals_its_series():
    rnd = np.random.default_rng(2)
    a, b = 10 ** rnd.uniform(-1, 3, 200), 10 ** rnd.uniform(-1, 3, 200)
    for x in (.1, .5, .8):
        assert hr.beta_tail(x, a, b) == pytest.approx([plain_tail(x, p, q) for p, q in zip(a, b)], rel=1e-8, abs=1e-12)
    assert hr.beta_tail(.5, np.array([5e5, 4e7]), np.array([5e5, 4e7])) == pytest.approx([.5, .5], abs=1e-6)
    assert len(hr.beta_tail(.5, np.zeros(0), np.zeros(0))) == 0
