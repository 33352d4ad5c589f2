"""URL filter: path rules first, else an empirical-Bayes reputation of the host.

Reputation: a labelled page is bad (quality 0 or toxic) or good. Bad counts per
host are shrunk through beta-binomial priors: a host towards its registered
domain, a domain towards its suffix, a suffix towards all pages. The strength
of each level's prior is fitted from all groups of that level by the method of
moments (intra-class correlation). A host is blocked when the lower posterior
bound of its bad share lies above a limit, so a thinly labelled host is never
blocked on a few bad pages unless its relatives are bad too.

The suffix is the last label of the host, or the longest of ``suffixes`` it ends in (``co.uk``; a parameter, as no
public-suffix list comes with the library); the registered domain is one label more. A port belongs to neither; an
address is a domain of its own under the suffix ``ip``. Host, domain and suffix
tables are aggregates, counted once and stored; a page joins the row of its host (AQE splits a hot one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import stored

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
Z, LIMIT, MAX_STRENGTH = 1.645, 0.5, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """``(host, path)`` columns; NULL or no ``://``: both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host, path, rules=RULES):
    """The longest fitting rule as text, or NULL. A rule fits its host and all
    subdomains where the path starts with the rule's path."""
    out = None
    for text, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        out = F.when(fits, F.lit(text)) if out is None else out.when(fits, F.lit(text))
    return out if out is not None else F.lit(None).cast("string")


def _levels(host, suffixes=()):
    """Registered domain and suffix of a host."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    address = bare.rlike(r"^([0-9]+([.][0-9]+){3}|\[.*\])$")
    labels, k = F.split(bare, "[.]"), F.lit(1)
    for suffix in sorted(suffixes, key=lambda x: x.count(".")):  # the longest comes last and decides
        k = F.when(bare.endswith("." + suffix), F.lit(suffix.count(".") + 1)).otherwise(k)
    n = F.size(labels)
    domain = F.array_join(F.slice(labels, F.greatest(n - k, F.lit(1)), k + 1), ".")
    return F.when(address, bare).otherwise(domain), F.when(address, F.lit("ip")).otherwise(F.array_join(F.slice(labels, n - k + 1, k), "."))


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from the (n, bad) of all its groups: the sums below
    are one row, from which the intra-class correlation follows in closed form."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    r = groups.agg(F.sum(n).alias("n"), F.sum(bad).alias("bad"), F.sum(n * n).alias("nn"),
                   F.sum(bad * bad / n).alias("within"), F.count(F.lit(1)).alias("k")).first()
    if not r["n"] or r["k"] < 2 or r["bad"] in (0, r["n"]):
        return MAX_STRENGTH
    mu = r["bad"] / r["n"]
    between = (r["within"] - r["n"] * mu * mu) / (mu * (1 - mu)) / (r["k"] - 1)  # mean square between groups over its variance
    size = (r["n"] - r["nn"] / r["n"]) / (r["k"] - 1)
    rho = (between - 1) / (between - 1 + size) if size > 0 and between > 1 else 0.0
    return min(MAX_STRENGTH, 1 / rho - 1) if rho > 1 / (1 + MAX_STRENGTH) else MAX_STRENGTH


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z, id_col: str = "page_id", host_col: str = "host",
                    suffixes=()) -> DataFrame:
    """``(host, n, bad, mean, lower)`` for every host of ``pages``.

    ``outcomes(page_id, bad)`` labels some pages; several labels of a page count
    each, NULL ones not at all. Unlabelled hosts get their domain's posterior. Without any
    label the share of bad pages is taken as 0. Extra columns are not read.
    """
    marked = outcomes.select(F.col("page_id").alias("__page"), F.col("bad").cast("int").alias("__bad")).filter("__page is not null and __bad is not null")
    seen = pages.select(F.col(id_col).alias("__id"), F.col(host_col).alias("host")).join(marked, F.col("__id") == F.col("__page"), "left")
    domain, suffix = _levels(F.col("host"), suffixes)
    hosts = (seen.groupBy("host").agg(F.count("__bad").alias("n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
             .withColumn("domain", domain).withColumn("suffix", suffix))
    hosts = stored(hosts, "url-hosts")  # read for each level below
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    strength = [_strength(level.filter("n > 0")) for level in (suffixes, domains, hosts)]
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = total["bad"] / total["n"] if total["n"] else 0.0

    def shrunk(prior, s):
        return (F.col("bad") + F.lit(s) * prior) / (F.col("n") + F.lit(s))

    suffixes = suffixes.select("suffix", shrunk(F.lit(mean), strength[0]).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(F.col("suffix_mean"), strength[1]).alias("domain_mean"))
    hosts = hosts.join(domains, "domain").withColumn("mean", shrunk(F.col("domain_mean"), strength[2]))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(strength[2] + 1)))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(z) * spread).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, limit: float = LIMIT,
               id_col: str = "page_id", url_col: str = "url", suffixes=()) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per input row.

    The rule's verdict where one fits, else "block" where the host's lower
    posterior bound of the bad share exceeds ``limit``. NULL urls and urls
    without ``://`` have the empty host, which is judged like any other. Rows that
    repeat stay; an empty table gives no rows; other columns are not read.
    """
    host, path = split_url(F.col("url"))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    base = base.select("page_id", host.alias("host"), path.alias("path"))
    blocked = host_reputation(base, outcomes, z, suffixes=suffixes).filter(F.col("lower") > limit).select(F.col("host").alias("bad_host"))
    verdicts = dict(rules)
    allow = [t for t, v in rules if v == "allow"]
    rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = base.join(blocked, F.col("host") == F.col("bad_host"), "left").withColumn("rule", rule)
    by_rule = F.when(F.col("rule").isin(allow), "allow").when(F.col("rule").isNotNull(), "block") if verdicts else F.lit(None)
    return judged.select("page_id", "host", "path", "rule", F.coalesce(by_rule, F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")).alias("verdict"))


SQL = """
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
base AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
lab AS (SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad FROM labels WHERE doc_id IS NOT NULL),
h AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
             array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1), len(string_split(host, '.'))), '.') AS domain,
             string_split(host, '.')[-1] AS suffix
      FROM base LEFT JOIN lab ON page_id = doc_id GROUP BY host),
dm AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
sf AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM dm GROUP BY suffix),
lev AS (SELECT 1 AS lev, n, bad FROM sf WHERE n > 0 UNION ALL SELECT 2, n, bad FROM dm WHERE n > 0 UNION ALL SELECT 3, n, bad FROM h WHERE n > 0),
agg AS (SELECT lev, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, CAST(sum(n * n) AS DOUBLE) AS nn,
               sum(CAST(bad AS DOUBLE) * bad / n) AS within, count(*) AS k FROM lev GROUP BY lev),
mom AS (SELECT lev, CASE WHEN k < 2 OR bad = 0 OR bad = n THEN NULL
                         ELSE (within - n * (bad / n) * (bad / n)) / ((bad / n) * (1 - bad / n)) / (k - 1) END AS f,
               CASE WHEN k < 2 THEN NULL ELSE (n - nn / n) / (k - 1) END AS size FROM agg),
rho AS (SELECT lev, CASE WHEN f > 1 AND size > 0 THEN (f - 1) / (f - 1 + size) ELSE 0 END AS rho FROM mom),
st AS (SELECT lev, CASE WHEN rho > 1.0 / 1001 THEN least(1000.0, 1 / rho - 1) ELSE 1000.0 END AS s FROM rho),
p AS (SELECT coalesce((SELECT s FROM st WHERE lev = 1), 1000.0) AS s1, coalesce((SELECT s FROM st WHERE lev = 2), 1000.0) AS s2,
             coalesce((SELECT s FROM st WHERE lev = 3), 1000.0) AS s3, (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0 END FROM sf) AS mean),
sm AS (SELECT suffix, (bad + s1 * mean) / (n + s1) AS m FROM sf, p),
dmm AS (SELECT domain, (dm.bad + s2 * sm.m) / (dm.n + s2) AS m FROM dm JOIN sm USING (suffix), p),
hm AS (SELECT host, n, s3, (h.bad + s3 * dmm.m) / (h.n + s3) AS m FROM h JOIN dmm USING (domain), p),
bad AS (SELECT host FROM hm WHERE m - 1.645 * sqrt(m * (1 - m) / (n + s3 + 1)) > 0.5),
ru AS (SELECT page_id, base.host, path, bad.host IS NOT NULL AS is_bad,
         CASE WHEN (base.host = 'example.net' OR suffix(base.host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (base.host = 'example.com' OR suffix(base.host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (base.host = 'org' OR suffix(base.host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (base.host = 'net' OR suffix(base.host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
       FROM base LEFT JOIN bad ON base.host = bad.host)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN is_bad THEN 'block' ELSE 'allow' END AS verdict
FROM ru
"""
