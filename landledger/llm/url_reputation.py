"""URL filter: explicit rules first, then an empirical-Bayes host reputation.

A page outcome is good (1) or bad (0). Hosts have few labelled pages, so the
share of good pages of a host is shrunk towards that of its registered domain,
the domain's towards its suffix's and the suffix's towards the whole table's.
Each level is a beta-binomial: the parent's posterior mean is the child's prior
mean, and the prior's strength is estimated once per level from how much more
the children vary than binomial counts would. A page is blocked unless the
lower posterior bound of its host reaches the threshold.

Everything is built-in column expressions. Counts are aggregated per host
before anything is joined, so only (host, document key) pairs meet the labels,
and the page table itself meets one narrow reputation row per host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import table
from landledger.session import materialize

ALLOW, BLOCK = "allow", "block"
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# One-sided 95 % bound, and the least share of good pages that it must show.
Z_BOUND = 1.645
MIN_GOOD = 0.5
# Prior strengths outside this range mean "no shrinkage" or "no variation".
WEAKEST, STRONGEST = 0.5, 1e6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_fits(host: Column, path: Column, rule: str) -> Column:
    at = rule.find("/")
    rule_host, rule_path = (rule, "") if at < 0 else (rule[:at], rule[at:])
    fits_host = (host == rule_host) | host.endswith("." + rule_host)
    return fits_host & path.startswith(rule_path)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both NULL without one.

    Rules are part of the program, so they become one CASE over the row, the
    longest first; rules of equal length are tried in code point order.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        fits = _rule_fits(host, path, text)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The label before the public suffix plus the suffix.

    The suffix is the last label, or the longest of ``suffixes`` (such as
    ``co.uk``) that the host ends with. A host that is a suffix is its own domain.
    """
    labels = F.split(host, r"\.")
    count = F.lit(2)
    for suffix in sorted(suffixes, key=len):
        count = F.when(host.endswith("." + suffix), F.lit(suffix.count(".") + 2)).otherwise(count)
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - count + 1, F.lit(1)), count), ".")


def public_suffix(domain: Column) -> Column:
    """A domain without its first label; the whole of a one-label domain."""
    return F.when(F.instr(domain, ".") > 0, F.substring_index(domain, ".", -1)).otherwise(domain)


def _suffix_of(host: Column, suffixes: Sequence[str]) -> Column:
    suffix = public_suffix(host)
    for text in sorted(suffixes, key=len):
        suffix = F.when((host == text) | host.endswith("." + text), F.lit(text)).otherwise(suffix)
    return suffix


def _shrink(level: DataFrame, key: str, parent_mean: str) -> DataFrame:
    """Posterior of every group of a level: adds ``alpha``, ``beta`` and ``mean``.

    ``level`` has ``good``, ``n`` and the parent's mean. The strength m of the
    prior follows from moments: with groups of n_i pages around their parents'
    means p_i, E sum (y_i - n_i p_i)^2 = sum n_i p_i (1 - p_i) (1 + (n_i - 1) / (m + 1)).
    Solving for 1 / (m + 1) gives one row, which joins back to all groups.
    """
    p, n, y = F.col(parent_mean), F.col("n"), F.col("good")
    spread = p * (1 - p) * n
    moments = level.agg(
        F.sum((y - n * p) * (y - n * p)).alias("seen"),
        F.sum(spread).alias("binomial"),
        F.sum(spread * (n - 1)).alias("pairs"),
    )
    overlap = (F.col("seen") - F.col("binomial")) / F.nullif(F.col("pairs"), F.lit(0.0))
    strength = F.when(F.coalesce(overlap, F.lit(0.0)) <= 1 / (STRONGEST + 1), F.lit(STRONGEST)).otherwise(
        F.greatest(1 / overlap - 1, F.lit(WEAKEST))
    )
    prior = moments.select(strength.alias("strength"))
    # one row: an aggregate without keys
    alpha, beta = y + F.col("strength") * p, n - y + F.col("strength") * (1 - p)
    return (
        level.crossJoin(F.broadcast(prior))
        .withColumn("alpha", alpha)
        .withColumn("beta", beta)
        .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
        .drop("strength")
    )


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, domain, suffix, good, n, posterior_mean, lower_bound) per host.

    ``outcomes`` has one row per host with ``good`` and ``n`` (labelled pages;
    0 for a host without any, which then gets its domain's reputation).
    """
    hosts = (
        outcomes.select("host", F.col("good").cast("double").alias("good"), F.col("n").cast("double").alias("n"))
        .withColumn("domain", registered_domain(F.col("host"), suffixes))
        .withColumn("suffix", _suffix_of(F.col("host"), suffixes))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    tops = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    # Laplace's rule for the whole table, which is one row
    root = tops.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("root_mean"))
    tops = _shrink(tops.crossJoin(F.broadcast(root)), "suffix", "root_mean")
    domains = domains.join(tops.select("suffix", F.col("mean").alias("suffix_mean")), "suffix")
    domains = _shrink(domains, "domain", "suffix_mean")
    hosts = hosts.join(domains.select("domain", "suffix", F.col("mean").alias("domain_mean")), ["domain", "suffix"])
    hosts = _shrink(hosts, "host", "domain_mean")
    a, b = F.col("alpha"), F.col("beta")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select(
        "host", "domain", "suffix", "good", "n",
        F.col("mean").alias("posterior_mean"),
        (F.col("mean") - Z_BOUND * deviation).alias("lower_bound"),
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    suffixes: Sequence[str] = (),
    min_good: float = MIN_GOOD,
) -> DataFrame:
    """Judge every page: its columns plus host, path, rule, verdict and lower_bound.

    ``labels`` has ``doc_id`` and ``quality``; a page is labelled by the
    document whose number stands in its path. A NULL or malformed URL has an
    empty host, which is judged like any other host. Repeated rows are kept and
    count as often as they occur; repeated labels of a document count once, as
    their mean rounded half up. Without any label the prior is one half good,
    and the bound lies below it, so pages without a rule are blocked at the
    default threshold. Columns of the input that clash with the new ones are
    replaced.
    """
    made = ("host", "path", "rule", "verdict", "lower_bound")
    judged = pages.drop(*made)
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    counted = (
        pages.select(host.alias("host"), F.regexp_extract(path, r"/(\d{1,18})", 1).alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("pages"))
        .withColumn("doc_id", F.expr("try_cast(nullif(key, '') AS bigint)"))
    )
    labelled = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.floor(F.avg("quality") + 0.5).alias("label"))
    )
    outcomes = (
        counted.join(labelled, "doc_id", "left")
        .groupBy("host")
        .agg(
            F.coalesce(F.sum(F.col("pages") * F.col("label")), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.when(F.col("label").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"),
        )
    )
    # one row per host, read several times: once per level and once by the pages
    reputation = host_reputation(materialize(outcomes, "outcomes"), suffixes)
    bound = materialize(reputation.select("host", "lower_bound"), "reputation")
    judged = judged.withColumn("host", host).withColumn("path", path)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("verdict", verdict)
    learned = F.when(F.col("lower_bound") >= min_good, ALLOW).otherwise(BLOCK)
    return judged.join(bound, "host", "left").withColumn("verdict", F.coalesce("verdict", learned))


def op3_url_reputation(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = filter_urls(pages, table(spark, folder, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule,
  try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})', 1), '') AS BIGINT) AS doc_id
  FROM p
), l AS (
  SELECT doc_id, floor(avg(quality) + 0.5) AS label FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), h AS (
  SELECT host, coalesce(sum(label), 0)::DOUBLE AS y, count(label)::DOUBLE AS n,
         array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM r LEFT JOIN l USING (doc_id) GROUP BY host
), d AS (SELECT domain, suffix, sum(y) AS y, sum(n) AS n FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(y) AS y, sum(n) AS n FROM d GROUP BY suffix),
s0 AS (SELECT s.*, (SELECT (sum(y) + 1) / (sum(n) + 2) FROM s) AS p FROM s),
sv AS (SELECT (sum((y - n * p) * (y - n * p)) - sum(p * (1 - p) * n)) / nullif(sum(p * (1 - p) * n * (n - 1)), 0) AS o FROM s0),
sm AS (SELECT CASE WHEN coalesce(o, 0) <= 1 / (1e6 + 1) THEN 1e6 ELSE greatest(1 / o - 1, 0.5) END AS m FROM sv),
s1 AS (SELECT suffix, (y + m * p) / (n + m) AS mean FROM s0, sm),
d0 AS (SELECT d.*, s1.mean AS p FROM d JOIN s1 USING (suffix)),
dv AS (SELECT (sum((y - n * p) * (y - n * p)) - sum(p * (1 - p) * n)) / nullif(sum(p * (1 - p) * n * (n - 1)), 0) AS o FROM d0),
dm AS (SELECT CASE WHEN coalesce(o, 0) <= 1 / (1e6 + 1) THEN 1e6 ELSE greatest(1 / o - 1, 0.5) END AS m FROM dv),
d1 AS (SELECT domain, suffix, (y + m * p) / (n + m) AS mean FROM d0, dm),
h0 AS (SELECT h.*, d1.mean AS p FROM h JOIN d1 USING (domain, suffix)),
hv AS (SELECT (sum((y - n * p) * (y - n * p)) - sum(p * (1 - p) * n)) / nullif(sum(p * (1 - p) * n * (n - 1)), 0) AS o FROM h0),
hm AS (SELECT CASE WHEN coalesce(o, 0) <= 1 / (1e6 + 1) THEN 1e6 ELSE greatest(1 / o - 1, 0.5) END AS m FROM hv),
h1 AS (SELECT host, y + m * p AS a, n - y + m * (1 - p) AS b FROM h0, hm),
h2 AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM h1)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM r JOIN h2 USING (host)
"""
