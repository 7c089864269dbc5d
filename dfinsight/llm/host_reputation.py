"""Operator 12, URL filters from rules and empirical-Bayes host reputation.

A url whose host and path fit a rule gets the verdict of the longest such rule. All others are judged by
their host's reputation: labelled pages are outcomes (bad or not), counted by host, registered domain and
suffix. Each level is a beta-binomial prior for the next: a node's bad rate has the prior Beta(s * m, s * (1 - m)),
m being the posterior mean of its parent and s one strength a level, fitted by the method of moments to how far the
nodes' counts scatter around their parents' means. So a host without labels stands on its domain, a domain without
labels on its suffix, and many labels outweigh any prior. A host is blocked if its posterior gives less than
``DOUBT`` to bad rates up to ``TOLERATED``: the lower bound of its bad rate is above what is tolerated. Hosts
are allowed until shown otherwise.

Pages are reduced to (host, path, rule) in the scan. Counting is pre-aggregated. Facts go back to their rows through
distinct (key, salt) pairs, so a host with a third of all pages, a domain with a third of all hosts or a
suffix with half of all domains spreads over 64 tasks. Only one strength a level and the totals reach the driver.

Registered domain and suffix: the host without user, port and closing dot; its last label is the suffix,
or its last two where the last has two letters and the one before is a usual second level (``SECOND_LEVEL``); one label
more is the domain. A numeric address is its own domain, with the suffix ``ip``.

Defined cases: a null url, or one without ``://``, has an empty host and path, and no label counts for it; a null
id has no label; a page labelled several times is bad if any of its labels is, and counts once a host; a label whose
quality and toxic are both null is none; without labels every verdict is the rules' or allow; repeated rows repeat;
urls of any length are read whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import map_arrow, spread_join, stored, table

# Fixed values: (verdict, host, path) of the rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Labels that stand before a country's own suffix.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "net", "or", "org")
TOLERATED, DOUBT = 0.5, 0.05
#: Strength of a prior: the least and most that is believed, and the one taken where nothing can be fitted.
WEAKEST, STRONGEST, UNFITTED = 0.5, 10_000.0, 2.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.substr(url, F.instr(url, "://") + 3)
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), host).otherwise("")


def path_of(url: Column) -> Column:
    after = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(out)
    return out


def _labels_of(host: Column) -> Column:
    """The labels of a host from the last one."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""), r"\.$", "")
    return F.reverse(F.split(bare, r"\."))


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    labels = _labels_of(host)
    last, second = F.get(labels, F.lit(0)), F.get(labels, F.lit(1))
    two = F.coalesce((F.length(last) == 2) & second.isin(*SECOND_LEVEL), F.lit(False))
    part = lambda n: F.array_join(F.reverse(F.slice(labels, 1, n)), ".")
    numeric = F.regexp_like(host, F.lit(r"^(.*@)?(\d+(\.\d+){3}|\[[0-9a-f:.]*\])(:\d*)?$"))
    return (F.when(numeric, host).when(two, part(3)).otherwise(part(2)), F.when(numeric, F.lit("ip")).when(two, part(2)).otherwise(part(1)))


def strength(nodes: DataFrame) -> float:
    """Prior strength of a level from (n, k, m): how much more than binomial counts scatter around the parents' means."""
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    one = nodes.filter("n > 1").agg(F.sum(F.pow(k - n * m, 2) - n * m * (1 - m)).alias("extra"), F.sum(n * (n - 1.0) * m * (1 - m)).alias("room")).first()
    if one.room is None or one.room <= 0:
        return UNFITTED
    share = one.extra / one.room  # correlation of two outcomes of one node
    return STRONGEST if share <= 0 else min(STRONGEST, max(WEAKEST, 1 / share - 1))


def beta_tail(x: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of Beta(a, b) below ``x``: the continued fraction of the incomplete beta function, from its convergent side."""
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    c, d = np.ones(len(p)), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h, i = d.copy(), 1
    while len(p):
        step = np.ones(len(p))
        for top in (i * (q - i) * y / ((p + 2 * i - 1) * (p + 2 * i)), -(p + i) * (p + q + i) * y / ((p + 2 * i) * (p + 2 * i + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            step = d * c
            h = h * step
        i += 1
        if (np.abs(step - 1) < 1e-13).all() or i > 200_000:
            break
    front = np.exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(y) + q * np.log1p(-y)) / p if len(p) else np.zeros(0)
    return np.where(swap, 1 - front * h, front * h)


def host_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, k): labelled and bad pages of every host. ``pages``: (id, host); ``labels``: (id, bad)."""
    once = pages.filter("id is not null and host <> ''").join(labels, "id").groupBy("id", "host").agg(F.max("bad").alias("bad"))
    counts = once.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").cast("long").alias("k"))
    domain, suffix = domain_and_suffix(F.col("host"))
    return (pages.select("host").distinct().join(counts, "host", "left")
            .select("host", domain.alias("domain"), suffix.alias("suffix"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k")))


def reputations(hosts: DataFrame, tolerated: float = TOLERATED) -> DataFrame:
    """(host, n, k, a, b, below): the posterior Beta(a, b) of each host's bad rate and its share up to ``tolerated``.
    ``hosts``: (host, domain, suffix, n, k)."""
    def mean(s):
        return (s * F.col("m") + F.col("k")) / (s + F.col("n"))

    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total.k or 0) + 0.5) / ((total.n or 0) + 1)
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = stored(hosts.groupBy("suffix", "domain").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts).withColumn("m", F.lit(overall))
    suffixes = suffixes.select("suffix", mean(strength(suffixes)).alias("m"))
    domains = stored(spread_join(domains, suffixes, "suffix"), "domain-priors")
    domains = domains.select("domain", mean(strength(domains)).alias("m"))
    hosts = stored(spread_join(hosts, domains, "domain"), "host-priors")
    s = strength(hosts)
    posterior = hosts.select("host", "n", "k", (s * F.col("m") + F.col("k")).alias("a"), (s * (1 - F.col("m")) + F.col("n") - F.col("k")).alias("b"))

    def tail(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(beta_tail(tolerated, *(b.column(i).to_numpy() for i in (3, 4))), pa.float64())],
                                             names=[*b.schema.names, "below"])

    return map_arrow(posterior, tail, "host string, n long, k long, a double, b double, below double")


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str, str]] = RULES,
          tolerated: float = TOLERATED, doubt: float = DOUBT) -> DataFrame:
    """(key, host, path, rule, verdict, n_labelled, n_bad, bad_rate, below): verdict and reputation of every row.
    ``labels``: (id, bad 0 or 1), any number an id."""
    u = F.col(url)
    rows = pages.select(F.col(key).alias("id"), host_of(u).alias("host"), path_of(u).alias("path")) \
        .select("*", rule_of(F.col("host"), F.col("path"), rules).alias("fit"))
    rows = rows.select("id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                       F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule"))
    hosts = stored(host_outcomes(rows.select("id", "host"), labels.select("id", "bad")), "host-outcomes")
    found = stored(reputations(hosts, tolerated), "reputations")
    own = F.when(F.col("below") < doubt, "block").otherwise("allow")
    return spread_join(rows, found, "host").select(
        F.col("id").alias(key), "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), F.col("n").alias("n_labelled"),
        F.col("k").alias("n_bad"), (F.col("a") / (F.col("a") + F.col("b"))).alias("bad_rate"), "below")


def page_labels(labels: DataFrame) -> DataFrame:
    """(id, bad) of the label table: a page is bad if it is toxic or of low quality."""
    bad = F.greatest(F.col("toxic"), 1 - F.col("quality"))
    return labels.select(F.col("doc_id").alias("id"), bad.cast("int").alias("bad")).filter("id is not null and bad is not null")


def q_host_reputation(spark, sf_dir):
    """Outcomes: the ``labels`` row whose doc_id is the page's page_id."""
    rows = judge(table(spark, sf_dir, "pages"), page_labels(table(spark, sf_dir, "labels")))
    return rows.select("page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad")


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
     rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
     hp AS (SELECT DISTINCT host, path FROM p),
     fit AS (SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(verdict, length(rule_host || rule_path)) AS verdict
             FROM hp JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path),
     lab AS (SELECT doc_id, max(greatest(toxic, 1 - quality)) AS bad FROM labels WHERE doc_id IS NOT NULL AND greatest(toxic, 1 - quality) IS NOT NULL GROUP BY doc_id),
     once AS (SELECT DISTINCT page_id, host, bad FROM p JOIN lab ON page_id = doc_id WHERE host <> ''),
     split AS (SELECT host, list_reverse(string_split(regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', ''), '\.$', ''), '.')) AS l,
                      regexp_matches(host, '^(.*@)?(\d+(\.\d+){3}|\[[0-9a-f:.]*\])(:\d*)?$') AS num FROM (SELECT DISTINCT host FROM p)),
     two AS (SELECT *, CASE WHEN length(l[1]) = 2 AND l[2] IN ('ac', 'co', 'com', 'edu', 'gob', 'gov', 'net', 'or', 'org') THEN 2 ELSE 1 END AS w FROM split),
     h AS (SELECT t.host, CASE WHEN num THEN t.host ELSE array_to_string(list_reverse(l[1:w + 1]), '.') END AS domain,
                  CASE WHEN num THEN 'ip' ELSE array_to_string(list_reverse(l[1:w]), '.') END AS suffix, count(o.page_id) AS n, coalesce(sum(o.bad), 0) AS k
           FROM two t LEFT JOIN once o ON t.host = o.host GROUP BY ALL),
     m0 AS (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) AS m FROM h),
     s1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT m FROM m0) AS m FROM h GROUP BY suffix),
     c1 AS (SELECT sum(pow(k - n * m, 2) - n * m * (1 - m)) FILTER (n > 1) / nullif(sum(n * (n - 1.0) * m * (1 - m)) FILTER (n > 1), 0) AS r FROM s1),
     t1 AS (SELECT CASE WHEN r IS NULL THEN 2.0 WHEN r <= 0 THEN 10000.0 ELSE least(10000.0, greatest(0.5, 1 / r - 1)) END AS s FROM c1),
     s2 AS (SELECT domain, sum(h.n) AS n, sum(h.k) AS k, any_value((s * s1.m + s1.k) / (s + s1.n)) AS m FROM h JOIN s1 USING (suffix), t1 GROUP BY domain),
     c2 AS (SELECT sum(pow(k - n * m, 2) - n * m * (1 - m)) FILTER (n > 1) / nullif(sum(n * (n - 1.0) * m * (1 - m)) FILTER (n > 1), 0) AS r FROM s2),
     t2 AS (SELECT CASE WHEN r IS NULL THEN 2.0 WHEN r <= 0 THEN 10000.0 ELSE least(10000.0, greatest(0.5, 1 / r - 1)) END AS s FROM c2),
     s3 AS (SELECT h.host, h.n, h.k, (s * s2.m + s2.k) / (s + s2.n) AS m FROM h JOIN s2 USING (domain), t2),
     c3 AS (SELECT sum(pow(k - n * m, 2) - n * m * (1 - m)) FILTER (n > 1) / nullif(sum(n * (n - 1.0) * m * (1 - m)) FILTER (n > 1), 0) AS r FROM s3),
     t3 AS (SELECT CASE WHEN r IS NULL THEN 2.0 WHEN r <= 0 THEN 10000.0 ELSE least(10000.0, greatest(0.5, 1 / r - 1)) END AS s FROM c3),
     post AS (SELECT host, n, k, s * m + k AS a, s * (1 - m) + n - k AS b FROM s3, t3),
     -- the share of Beta(a, b) up to 1/2 as a sum of positive terms; their ratio falls below 3/4 within a + 4b terms
     terms AS (SELECT host, n, k, a, b, unnest(generate_series(0, CAST(ceil(a + 4 * b) AS BIGINT) + 200)) AS i FROM post),
     below AS (SELECT host, n, k, sum(exp(lgamma(a + b + i) - lgamma(b) - lgamma(a + 1 + i) + (a + b + i) * ln(0.5))) AS below FROM terms GROUP BY host, n, k)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, CASE WHEN below < 0.05 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n AS BIGINT) AS n_labelled, CAST(k AS BIGINT) AS n_bad
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path JOIN below ON p.host = below.host
"""
