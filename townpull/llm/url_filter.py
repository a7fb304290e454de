"""URL filters (operator 8): rules, and empirical-Bayes host reputation for the rest.

Labelled page outcomes (good or bad) are counted by host, registered domain and suffix. Going
down from all pages to suffix, domain and host, each level's share of bad pages has a
beta prior with the mean of the level above and a strength estimated from how much more the
level's counts vary than binomial draws would (the intraclass correlation rho of a
beta-binomial law; strength = 1 / rho - 1, at least ``LEAST_STRENGTH``). The mean of the level
above is that of its other members: a host's own outcomes are no part of its prior, so that one
label counts once. A host is blocked where its posterior mean less ``spread(CONFIDENCE)`` posterior
standard deviations is over ``limit``; by Cantelli's inequality at least that share of the posterior lies
above the bound whatever the shape of the beta law, which a normal approximation does not give for
few labels. A host without labels is judged by its domain and suffix, with their uncertainty.

The suffix is a host's last label and the registered domain its last two (no public-suffix
list is at hand). DataFrame functions only.

Null urls and urls without ``://`` have an empty host and path and share one reputation. Rows
without page_id have no outcome but are judged. Repeated pages are judged, and counted, each.
Outcomes are summed per page before they meet the pages; outcomes that are null count for
nothing. Extra columns are ignored. An empty table gives an empty result; without any
outcome the prior mean is one half and nothing is blocked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.llm.common import stage

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
LIMIT = 0.5    # share of bad pages from which a host is unwanted
CONFIDENCE = 0.95      # of the posterior that lies above the bound, at least
LEAST_STRENGTH = 1.0   # of a prior, in labelled pages
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def spread(confidence: float = CONFIDENCE) -> float:
    """Standard deviations below the mean (Cantelli)."""
    return (confidence / (1 - confidence)) ** 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "^([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host + path) and its verdict; null where none does.

    ``rules`` is a short list; each is one comparison per row."""
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))

    def fits(h: str, p: str) -> Column:
        return ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))

    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in reversed(longest_first):
        name, verdict = F.when(fits(h, p), F.lit(h + p)).otherwise(name), F.when(fits(h, p), F.lit(v)).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame, prior: str) -> Column:
    """The strength of the level's priors, from ``groups`` (n, bad, the prior mean)."""
    v = F.col(prior) * (1 - F.col(prior))
    excess = F.sum(F.pow(F.col("bad") - F.col("n") * F.col(prior), 2) - F.col("n") * v)
    rho = F.coalesce(excess / F.nullif(F.sum(F.col("n") * (F.col("n") - 1) * v), F.lit(0.0)), F.lit(0.0))
    rho = F.least(F.greatest(rho, F.lit(1e-3)), F.lit(1 / (1 + LEAST_STRENGTH)))
    return groups.agg((1 / rho - 1).alias("s")).scalar()   # one row


def _without(groups: DataFrame, above: DataFrame, key: str, strength: Column, out: str) -> DataFrame:
    """``groups`` with the mean ``out`` of the level ``above`` (n, bad, prior), less what each row adds to it."""
    above = above.select(key, F.col("n").alias("n_"), F.col("bad").alias("bad_"), F.col("prior").alias("prior_"))
    rest = F.col("n_") - F.col("n")
    mean = (strength * F.col("prior_") + F.col("bad_") - F.col("bad")) / (strength + rest)
    return groups.join(above, key).withColumn(out, mean).drop("n_", "bad_", "prior_")


def reputations(outcomes: DataFrame) -> DataFrame:
    """Per host of ``outcomes`` (host, n labelled, bad): mean and standard deviation of its
    posterior share of bad pages. Hosts without labels have n = 0."""
    hosts = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")) \
        .withColumn("suffix", F.substring_index("host", ".", -1)) \
        .withColumn("domain", F.substring_index("host", ".", -2))
    hosts = stage(hosts, "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_n, all_bad = (suffixes.agg(F.sum(c)).scalar() for c in ("n", "bad"))
    suffixes = suffixes.withColumn("prior", (all_bad - F.col("bad") + 1) / (all_n - F.col("n") + 2))
    domains = _without(domains, suffixes, "suffix", _strength(suffixes, "prior"), "prior")
    hosts = _without(hosts, domains, "domain", _strength(domains, "prior"), "prior")
    s = _strength(hosts, "prior")
    total = s + F.col("n")
    hosts = hosts.withColumn("mean", (s * F.col("prior") + F.col("bad")) / total).withColumn("total", total)
    return hosts.select("host", "n", "bad", "mean", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1)).alias("sd"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT, confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, bad_mean and bad_low (the bound) of every
    row of ``pages`` (page_id, url). ``outcomes``: (page_id, bad: whether the page is unwanted)."""
    known = outcomes.where("bad is not null").groupBy("page_id") \
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("int")).alias("bad"))
    url = F.col("url").cast("string")
    seen = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).join(known, "page_id", "left")
    seen = stage(seen.select("page_id", "host", "path", F.coalesce("n", F.lit(0)).alias("n"),
                             F.coalesce("bad", F.lit(0)).alias("bad")), "url-pages")
    by_host = reputations(seen).select("host", F.col("n").alias("n_labelled"), F.col("mean").alias("bad_mean"),
                                       (F.col("mean") - spread(confidence) * F.col("sd")).alias("bad_low"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return seen.select("page_id", "host", "path").join(by_host, "host") \
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                "n_labelled", "bad_mean", "bad_low")


def label_outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, bad) from the table of labels: low quality or toxic; its doc_id is the page's id.

    The labels are of documents. No table has outcomes of pages, so those of the documents with the pages'
    numbers stand for them; they say nothing about hosts, and no host stands out by them."""
    bad = reduce(lambda a, b: a | b, [F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))])
    return labels.where("quality is not null or toxic is not null").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def oracle_sql(rules=RULES, limit: float = LIMIT, confidence: float = CONFIDENCE) -> str:
    """DuckDB SQL for page_id, host, path, rule, verdict."""
    fits = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    cond = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in fits]
    name = "CASE " + " ".join(f"WHEN {c} THEN '{h + p}'" for c, (h, p, _) in zip(cond, fits)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, (_, _, v) in zip(cond, fits)) + " END"

    def strength(table: str) -> str:
        v = "prior * (1 - prior)"
        return (f"(SELECT 1 / least(greatest(coalesce(sum(pow(bad - n * prior, 2) - n * {v}) / nullif(sum(n * (n - 1) * {v}), 0.0), 0.0),"
                f" 1e-3), {1 / (1 + LEAST_STRENGTH)}) - 1 FROM {table})")

    return f"""
WITH known AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
seen AS (
  SELECT cut.page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad
  FROM cut LEFT JOIN known ON cut.page_id = known.page_id),
hosts AS (
  SELECT host, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, array_to_string(string_split(host, '.')[-1:], '.') AS suffix,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM seen GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
suffixes1 AS (SELECT *, ((SELECT sum(bad) FROM suffixes) - bad + 1) / ((SELECT sum(n) FROM suffixes) - n + 2) AS prior FROM suffixes),
domains1 AS (SELECT d.*, (s * x.prior + x.bad - d.bad) / (s + x.n - d.n) AS prior
  FROM domains d JOIN (SELECT *, {strength('suffixes1')} AS s FROM suffixes1) x USING (suffix)),
hosts1 AS (SELECT h.*, (s * x.prior + x.bad - h.bad) / (s + x.n - h.n) AS prior
  FROM hosts h JOIN (SELECT *, {strength('domains1')} AS s FROM domains1) x USING (domain)),
hosts2 AS (SELECT *, {strength('hosts1')} AS s FROM hosts1),
hosts3 AS (SELECT host, s + n AS total, (s * prior + bad) / (s + n) AS mean FROM hosts2),
judged AS (SELECT host, mean - {spread(confidence)!r} * sqrt(mean * (1 - mean) / (total + 1)) AS low FROM hosts3)
SELECT page_id, seen.host AS host, path, {name.replace('host', 'seen.host')} AS rule,
  coalesce({verdict.replace('host', 'seen.host')}, CASE WHEN low > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM seen JOIN judged ON seen.host = judged.host"""
