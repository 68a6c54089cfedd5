"""URL filters: rules on host and path, and empirical-Bayes reputations of hosts for the urls that no rule fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, join_spread, written

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct<rule, verdict>: its host or a subdomain, and a path that begins with its own."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


# fixed values: public suffixes of several labels; any other last label is a suffix by itself
SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "asn.au", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.ng",
    "com.pe", "com.ph", "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn", "go.jp", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "gr.jp", "ltd.uk", "me.uk", "ne.jp", "net.au",
    "net.br", "net.cn", "net.nz", "net.uk", "nhs.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.in", "org.nz", "org.uk", "org.za", "plc.uk", "sch.uk",
)


def suffix_and_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """The public suffix of a host, and its registered domain (the suffix and one label more); ports are left out.

    suffixes names those of several labels; the longest that fits counts, and else the last label is the suffix. A host
    that is a suffix, or a number, is its own domain.
    """
    name = F.regexp_replace(host, ":[0-9]*$", "")
    suffix, domain = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    for labels in range(2, 1 + max((s.count(".") + 1 for s in suffixes), default=1)):
        those = [s for s in suffixes if s.count(".") + 1 == labels]
        tail = F.substring_index(name, ".", -labels)
        suffix, domain = F.when(tail.isin(those), tail).otherwise(suffix), F.when(tail.isin(those), F.substring_index(name, ".", -labels - 1)).otherwise(domain)
    number = name.rlike("^[0-9.]+$")
    return F.when(number, name).otherwise(suffix), F.when(number, name).otherwise(domain)


def prior_strength(children: DataFrame, parent: str | None, n: str, bad: str, fallback: float, bounds: tuple[float, float] = (1.0, 1000.0)) -> float:
    """Weight in pages of the beta prior that children of a parent share, estimated from how far their rates are apart.

    Within parents of two or more children the variance between children is set against the one within them (the
    analysis-of-variance estimate of the correlation r of two pages of a child); a beta prior of weight w has
    r = 1 / (w + 1). Children without pages say nothing; fallback is taken where nothing can be told.
    """
    x, m = F.col(bad), F.col(n)
    by = children.where(m > 0).groupBy(*([parent] if parent else []))
    p = by.agg(F.count(F.lit(1)).alias("k"), F.sum(m).alias("n"), F.sum(x).alias("x"), F.sum(x * x / m).alias("q"), F.sum(m * m).alias("n2")).where("k >= 2")
    t = p.agg(F.sum(F.expr("q - x * x / n")).alias("b"), F.sum(F.expr("x - q")).alias("w"), F.sum(F.expr("k - 1")).alias("db"), F.sum(F.expr("n - k")).alias("dw"), F.sum(F.expr("n - n2 / n")).alias("spread")).first()
    if not t.db or not t.dw:
        return fallback
    between, within, size = t.b / t.db, t.w / t.dw, t.spread / t.db
    total = between + (size - 1) * within
    if total <= 0:
        return fallback
    r = (between - within) / total
    return min(max(1 / r - 1, bounds[0]), bounds[1]) if r > 0 else bounds[1]


def reputations(outcomes: DataFrame, strength: float = 20.0, deviations: float = 1.64, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """host and bound: a lower bound of the rate of bad pages of each host in outcomes (host, pages, bad).

    Counts are summed from host to registered domain to suffix to all. The rate of all is the mean of the suffixes'
    beta prior; a suffix's posterior mean is that of its domains' prior, and so on down to the host. Each level's
    prior has the weight that prior_strength() estimates from its children (strength where it can't). The bound is the
    host's posterior mean less `deviations` posterior standard deviations.
    """
    suffix, domain = suffix_and_domain(F.col("host"), suffixes)
    hosts = outcomes.groupBy("host").agg(F.sum("pages").alias("n"), F.sum("bad").alias("bad")).withColumns({"domain": domain, "suffix": suffix})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("domain_n"), F.sum("bad").alias("domain_bad"))
    ends = domains.groupBy("suffix").agg(F.sum("domain_n").alias("suffix_n"), F.sum("domain_bad").alias("suffix_bad"))
    every = ends.agg(F.coalesce(F.sum("suffix_n"), F.lit(0)).alias("n"), F.coalesce(F.sum("suffix_bad"), F.lit(0)).alias("bad")).first()
    of_suffix, of_domain, of_host = prior_strength(ends, None, "suffix_n", "suffix_bad", strength), prior_strength(domains, "suffix", "domain_n", "domain_bad", strength), prior_strength(hosts, "domain", "n", "bad", strength)
    mean = lambda bad, n, weight, prior: (bad + weight * prior) / (n + weight)
    ends = ends.select("suffix", mean(F.col("suffix_bad"), F.col("suffix_n"), of_suffix, (every.bad + 0.5) / (every.n + 1.0)).alias("suffix_mean"))
    domains = domains.join(ends, "suffix").select("domain", mean(F.col("domain_bad"), F.col("domain_n"), of_domain, F.col("suffix_mean")).alias("domain_mean"))
    a = F.col("bad") + of_host * F.col("domain_mean")
    b = F.col("n") - F.col("bad") + of_host * (1 - F.col("domain_mean"))
    return hosts.join(domains, "domain").select("host", (a / (a + b) - deviations * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, most_bad: float = 0.35, strength: float = 20.0, deviations: float = 1.64, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting rule decides; where none fits, a page is blocked if the lower posterior bound of its host's
    rate of bad pages is over most_bad. A page is labelled by the row of labels whose doc_id is its page_id, and bad
    if that is of low quality or toxic. Null urls, and those without ://, have an empty host and path, no rule and
    the reputation of the empty host. Hosts without labelled pages have their domain's posterior (a domain without, its
    suffix's). Repeated labels of an id count once (bad if any is). Labels are summed before hosts are shuffled, and
    pages of a large host are dealt over several tasks when they meet its verdict.
    """
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    outcomes = base.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(F.count("bad").alias("pages"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("all_pages"))
    outcomes = written(outcomes, "outcomes")
    bad_hosts = reputations(outcomes, strength, deviations, suffixes).where(F.col("bound") > most_bad).select("host", F.lit(True).alias("bad_host"))
    blocked = written(outcomes.select("host", "all_pages").join(bad_hosts, "host"), "blocked-hosts")
    ruled = base.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    judged = join_spread(ruled, blocked, "host", "all_pages", ["page_id"], "left")
    own = F.when(F.col("bad_host"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce(F.col("r.verdict"), own).alias("verdict"))


def _weight(level: str, parent: str | None, n: str, bad: str) -> str:
    """SQL for prior_strength()."""
    return f"""(SELECT CASE WHEN coalesce(db, 0) = 0 OR coalesce(dw, 0) = 0 OR b / db + (spread / db - 1) * (w / dw) <= 0 THEN 20.0::DOUBLE
   WHEN b / db - w / dw <= 0 THEN 1000.0::DOUBLE
   ELSE least(greatest((b / db + (spread / db - 1) * (w / dw)) / (b / db - w / dw) - 1, 1.0), 1000.0) END AS weight FROM (
 SELECT sum(q - x * x / n) AS b, sum(x - q) AS w, sum(k - 1)::DOUBLE AS db, sum(n - k)::DOUBLE AS dw, sum(n - n2 / n) AS spread FROM (
  SELECT count(*) AS k, sum({n})::DOUBLE AS n, sum({bad})::DOUBLE AS x, sum({bad} * {bad} / {n}::DOUBLE) AS q, sum({n} * {n})::DOUBLE AS n2 FROM {level} WHERE {n} > 0 GROUP BY {parent or "()"}) WHERE k >= 2))"""


_LIST = ", ".join(f"'{s}'" for s in SUFFIXES)
ORACLE = r"""
WITH base AS (
  SELECT page_id, CASE WHEN s IS NULL THEN '' ELSE translate(regexp_extract(s, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
         CASE WHEN s IS NULL THEN '' ELSE regexp_extract(s, '^[^/?#]*([^?#]*)', 1) END AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS s FROM pages)),
known AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
named AS (SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l, regexp_replace(host, ':[0-9]*$', '') AS name FROM (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM base LEFT JOIN known USING (page_id) GROUP BY host)),
cut AS (SELECT *, CASE WHEN array_to_string(list_slice(l, -2, NULL), '.') IN (@LIST) THEN 2 ELSE 1 END AS labels, regexp_full_match(name, '[0-9.]+') AS number FROM named),
hosts AS (SELECT host, n, bad, CASE WHEN number THEN name ELSE array_to_string(list_slice(l, -labels - 1, NULL), '.') END AS domain,
          CASE WHEN number THEN name ELSE array_to_string(list_slice(l, -labels, NULL), '.') END AS suffix FROM cut),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
every AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS p FROM suffixes),
smean AS (SELECT suffix, (bad + weight * p) / (n + weight) AS m FROM suffixes, every, @SUFFIX),
dmean AS (SELECT domain, (d.bad + weight * s.m) / (d.n + weight) AS m FROM domains d JOIN smean s USING (suffix), @DOMAIN),
ab AS (SELECT host, h.bad + weight * m AS a, h.n - h.bad + weight * (1 - m) AS b FROM hosts h JOIN dmean USING (domain), @HOST),
blocked AS (SELECT host FROM ab WHERE a / (a + b) - 1.64::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.35::DOUBLE),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM base)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
ORACLE = ORACLE.replace("@LIST", _LIST).replace("@SUFFIX", _weight("suffixes", None, "n", "bad")).replace("@DOMAIN", _weight("domains", "suffix", "n", "bad")).replace("@HOST", _weight("hosts", "domain", "n", "bad"))
