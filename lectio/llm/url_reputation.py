"""URL filters: explicit host/path rules, and an empirical-Bayes reputation of hosts for every other page.

Labelled pages are counted by host. Beta-binomial priors shrink each rate towards that of its parent: host to registered
domain to suffix to all pages; the strength of each level's prior is estimated from the counts by moments. A host is
blocked when even the upper posterior bound of its rate of good pages is below a threshold. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty for null or no "://"."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end; empty for null or no "://"."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules are a short list of settings, not a table."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _strength(counts: DataFrame, parent: str) -> Column:
    """The prior's strength by moments: how far the groups' rates scatter about their parent's, beyond chance."""
    p, mu = F.col("good") / F.col("n"), F.col(parent)
    chance = F.sum(mu * (1 - mu))
    spread = F.sum(F.col("n") * (p - mu) * (p - mu)) - chance
    scale = F.sum((F.col("n") - 1) * mu * (1 - mu))
    rho = F.when(scale > 0, spread / scale).otherwise(F.lit(0.0))
    rho = F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.5))
    return 1 / rho - 1


def with_parents(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Adds domain and suffix to host. suffixes: (suffix) such as co.uk, a list of public ones.

    The suffix is the longest listed one that a host ends with, else its last label; the registered domain has one label more.
    A host that is a suffix, or empty, is its own domain.
    """
    last, two = F.substring_index("host", ".", -1), F.substring_index("host", ".", -2)
    if suffixes is None:
        return hosts.select("host", two.alias("domain"), last.alias("suffix"), *(c for c in hosts.columns if c != "host"))
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct((F.size(labels) - i + 1).alias("labels"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("suffix")))
    listed = hosts.select("host", F.explode(ends).alias("end")).select("host", "end.*").join(suffixes.select("suffix").distinct(), "suffix")
    longest = listed.groupBy("host").agg(F.max("labels").alias("labels"))
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.size(labels)), ".")
    n = F.coalesce("labels", F.lit(1))
    return hosts.join(longest, "host", "left").select("host", tail(n + 1).alias("domain"), tail(n).alias("suffix"), *(c for c in hosts.columns if c != "host"))


def reputation(hosts: DataFrame, z: float = 1.0, suffixes: DataFrame | None = None) -> DataFrame:
    """hosts: host, n labelled pages, good ones -> host, mean and upper posterior bound of the rate of good pages.

    See with_parents() for the registered domain. Without any label the rate of all pages counts as 0.5.
    """
    hosts = with_parents(hosts.select("host", "n", "good"), suffixes)
    domains = stored(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mu = (total["good"] + 0.5) / (total["n"] + 1.0) if total["n"] else 0.5

    def shrunk(counts: DataFrame, mean: str, parent: str) -> DataFrame:
        m = counts.filter("n > 0").agg(_strength(counts, parent).alias("m")).first()["m"]
        m = 999.0 if m is None else m
        return counts.withColumn(mean, (F.col("good") + m * F.col(parent)) / (F.col("n") + m)).withColumn("m", F.lit(m))

    suffixes = shrunk(suffixes.withColumn("mu", F.lit(mu)), "suffix_mean", "mu")
    domains = shrunk(domains.join(suffixes.select("suffix", "suffix_mean"), "suffix"), "domain_mean", "suffix_mean")
    hosts = shrunk(hosts.join(domains.select("domain", "domain_mean"), "domain"), "mean", "domain_mean")
    weight = F.col("n") + F.col("m")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return hosts.select("host", "n", "good", "mean", (F.col("mean") + z * sd).alias("upper"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, z: float = 1.0, min_rate: float = 0.5, suffixes: DataFrame | None = None) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, upper.

    labels: doc_id (a page's id), quality. The verdict is that of the longest rule that fits; without one, ``block`` when the
    upper posterior bound of the host's rate of quality 1 is below min_rate, else ``allow``. Several labels of a page count
    as one, the least; null qualities do not count. Repeated pages are repeated rows; null ids stay, and have no label.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcome = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").alias("quality"))
    counts = urls.select("page_id", "host").join(outcome, "page_id", "left").groupBy("host").agg(F.count("quality").alias("n"), F.coalesce(F.sum((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"))
    known = reputation(stored(counts, "hosts"), z, suffixes).select("host", "upper")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("upper") < min_rate, "block").otherwise("allow")
    return urls.join(known, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "upper")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> page_id, host, path, rule, verdict. Null urls, repeated pages, null labels, an empty table: see judge_urls()."""
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("upper")


def _level(name: str, parent_join: str, parent: str) -> str:
    rho = f"least(greatest(coalesce((sum(n * (good / n - {parent}) * (good / n - {parent})) - sum({parent} * (1 - {parent}))) / nullif(sum((n - 1) * {parent} * (1 - {parent})), 0), 0), 0.001), 0.5)"
    return f"{name}_in AS ({parent_join}), {name}_m AS (SELECT coalesce(1 / CASE WHEN count(*) > 0 THEN {rho} END - 1, 999) AS m FROM {name}_in WHERE n > 0), {name}_out AS (SELECT *, (good + m * {parent}) / (n + m) AS {name}_mean FROM {name}_in, {name}_m)"


OP2_SQL = f"""
WITH urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
outcome AS (SELECT doc_id AS page_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1),
hosts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix,
    count(quality) AS n, count(*) FILTER (WHERE quality = 1) AS good FROM urls LEFT JOIN outcome USING (page_id) GROUP BY host),
{_level("suffix", "SELECT suffix, sum(n) AS n, sum(good) AS good, (sum(sum(good)) OVER () + 0.5) / (sum(sum(n)) OVER () + 1) AS mu FROM hosts GROUP BY suffix", "mu")},
{_level("domain", "SELECT d.*, suffix_mean FROM (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL) d JOIN suffix_out USING (suffix)", "suffix_mean")},
{_level("host", "SELECT h.host, h.n, h.good, domain_mean FROM hosts h JOIN domain_out USING (domain)", "domain_mean")},
ruled AS (
  SELECT u.*, CASE
    WHEN (u.host = 'www.example.com' OR u.host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (u.host = 'example.com' OR u.host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (u.host = 'net' OR u.host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (u.host = 'net' OR u.host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (u.host = 'com' OR u.host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM urls u)
SELECT page_id, ruled.host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host_mean + sqrt(host_mean * (1 - host_mean) / (n + m + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN host_out ON ruled.host = host_out.host
"""
