"""URL filtering by host reputation under beta-binomial (empirical-Bayes) shrinkage, with fixed rules first.

Outcomes of labelled pages (bad or not) are counted for each host. Priors are nested: the whole web's rate is the
mean of the suffixes' prior, a suffix's posterior rate that of its registered domains, a registered domain's that of
its hosts. The strength of each level's prior (its number of pseudo-pages) is fitted to the spread that its groups
show, by the method of moments for the beta-binomial: with group sizes n_i, rates p_i and overall rate p,

    rho = (sum n_i (p_i - p)^2 - p (1 - p) (k - 1)) / (p (1 - p) (N - sum n_i^2 / N - k + 1)),   strength = (1 - rho) / rho

held between ``MIN_STRENGTH`` and ``MAX_STRENGTH``. A host is blocked if the lower bound of its posterior rate, mean
minus ``z`` standard deviations of the beta posterior, is over ``bad_rate``. A host without labelled pages has its domain's
posterior, a domain without any its suffix's, so every page is judged.

Hosts' counts are aggregated before anything is joined and written once; a host that holds a third of all pages is one row of
counts, and its pages meet their verdict where they are (see ``by_key``).

Outcomes are taken from the table of labels by page id: labels and pages are numbered alike, a page's id being that of the document
that was extracted from it. Labels of ids that are no page's say nothing here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, Workspace, by_key

#: (action, host, path); a rule fits its host and all subdomains if the url's path starts with the rule's.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_STRENGTH, MAX_STRENGTH, Z, BAD_RATE = 1.0, 1000.0, 1.0, 0.5
#: Second-level labels under which names are registered (fixed values; only with two-letter suffixes).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, with A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, else nulls; of equally long ones the first."""
    rule = action = F.lit(None).cast("string")
    for act, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, action = F.when(fits, F.lit(at + start)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def domain_of(host: Column) -> Column:
    """The registered domain: the last two labels, or three where the last two are a two-letter suffix under one of
    SECOND_LEVEL. An address in digits, or a host of one label, is its own."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    three = F.regexp_extract(name, r"([^.]+\.(?:" + "|".join(SECOND_LEVEL) + r")\.[a-z]{2})$", 1)
    two = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)
    return F.when(name.rlike(r"^[\d.]+$") | ~name.contains("."), name).when(three != "", three).otherwise(two)


def suffix_of(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[\d.]+$"), F.lit("")).otherwise(F.regexp_extract(domain, r"^[^.]*\.?(.*)$", 1))


def _strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: the prior's pseudo-pages from the spread of the rates b / n of groups that have labelled pages."""
    n, b = F.col("n").cast("double"), F.col("b").cast("double")
    m = groups.where("n > 0").agg(F.count("*").cast("double").alias("k"), F.sum(n).alias("total"), F.sum(b).alias("bad"), F.sum(n * n).alias("squares"), F.sum(b * b / n).alias("spread"))
    k, total, squares = F.col("k"), F.col("total"), F.col("squares")
    p = F.col("bad") / F.col("total")
    noise = p * (1 - p)
    rho = F.try_divide(F.col("spread") - total * p * p - noise * (k - 1), noise * (total - squares / total - k + 1))
    fitted = F.when(rho <= 0, F.lit(MAX_STRENGTH)).otherwise(F.least(F.greatest((1 - rho) / rho, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH)))
    return m.select(F.coalesce(fitted, F.lit(MAX_STRENGTH)).alias(name), F.coalesce(F.try_divide("bad", "total"), F.lit(0.0)).alias("rate"))


def reputations(hosts: DataFrame, bad_rate: float = BAD_RATE, z: float = Z) -> DataFrame:
    """From (host, n, b), a row for each host with b bad ones of n labelled pages (both may be 0): host, rate (posterior mean),
    bound (its lower bound), action, and any other columns as they are."""
    others = [c for c in hosts.columns if c not in ("host", "n", "b")]
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    s0, s1, s2 = _strength(suffixes, "s0"), _strength(domains, "s1").drop("rate"), _strength(hosts, "s2").drop("rate")
    web = F.broadcast(s0.join(F.broadcast(s1)).join(F.broadcast(s2)))  # a single row
    top = suffixes.join(web).select("suffix", ((F.col("b") + F.col("rate") * F.col("s0")) / (F.col("n") + F.col("s0"))).alias("_prior"), "s1", "s2")
    mid = domains.join(top, "suffix").select("domain", ((F.col("b") + F.col("_prior") * F.col("s1")) / (F.col("n") + F.col("s1"))).alias("_prior"), "s2")
    low = hosts.join(mid, "domain").withColumn("_size", F.col("n") + F.col("s2")).withColumn("rate", (F.col("b") + F.col("_prior") * F.col("s2")) / F.col("_size"))
    low = low.withColumn("bound", F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("_size") + 1)))
    return low.select("host", *others, "rate", "bound", F.when(F.col("bound") > bad_rate, "block").otherwise("allow").alias("action"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", bad: Column | None = None, rules: Sequence[tuple[str, str, str]] = RULES, bad_rate: float = BAD_RATE, z: float = Z) -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule (host and path of the longest fitting one, else null), verdict, and
    the host's rate and bound.

    ``labels`` says of which ids the outcome is known; ``bad`` (by default: low quality or toxic) is the condition on its
    columns; an id that is repeated there is bad if any of its rows is. Null urls and urls without :// have empty host and path, and share
    the empty host's reputation. Without any labels every host is allowed. Repeated pages count as often as they stand there.
    An empty table gives an empty result. Other columns of ``pages`` are not read.
    """
    work = Workspace(pages.sparkSession)
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1) if bad is None else bad
    url = F.col(url_col)
    rows = work.put(pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path")), "rows")
    known = labels.select(F.col(label_id).alias("_id"), F.coalesce(bad, F.lit(False)).cast("int").alias("_bad")).groupBy("_id").agg(F.max("_bad").alias("_bad"))
    counts = rows.select("_id", "host").join(known, "_id", "left").groupBy("host").agg(F.count("*").alias("pages"), F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("b"))
    counts = work.put(counts, "counts")
    hosts = work.put(reputations(counts, bad_rate, z), "hosts")
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    met = by_key(rows.withColumn("rule", rule).withColumn("_action", action), hosts, "host", "pages")
    return met.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("_action", "action", F.lit("allow")).alias("verdict"), "rate", "bound")


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    return judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, source: str) -> str:
    return f"""{name} AS (SELECT coalesce(CASE WHEN rho <= 0 THEN {MAX_STRENGTH} ELSE least(greatest((1 - rho) / rho, {MIN_STRENGTH}), {MAX_STRENGTH}) END, {MAX_STRENGTH}) AS {name}, coalesce(p, 0) AS rate
  FROM (SELECT p, (spread - total * p * p - p * (1 - p) * (k - 1)) / nullif(p * (1 - p) * (total - squares / total - k + 1), 0) AS rho
    FROM (SELECT CAST(count(*) AS DOUBLE) AS k, CAST(sum(n) AS DOUBLE) AS total, sum(CAST(n AS DOUBLE) * n) AS squares, sum(CAST(b AS DOUBLE) * b / n) AS spread, CAST(sum(b) AS DOUBLE) / sum(n) AS p FROM {source} WHERE n > 0)))"""


SQL = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
known AS (SELECT doc_id AS page_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS b FROM u LEFT JOIN known USING (page_id) GROUP BY host),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM c),
h AS (SELECT host, n, b, CASE WHEN regexp_matches(name, '^[0-9.]+$') OR NOT contains(name, '.') THEN name WHEN regexp_extract(name, '([^.]+[.](?:{'|'.join(SECOND_LEVEL)})[.][a-z][a-z])$', 1) <> '' THEN regexp_extract(name, '([^.]+[.](?:{'|'.join(SECOND_LEVEL)})[.][a-z][a-z])$', 1) ELSE regexp_extract(name, '([^.]+[.][^.]+)$', 1) END AS domain FROM named),
d AS (SELECT domain, CASE WHEN regexp_matches(domain, '^[0-9.]+$') THEN '' ELSE regexp_extract(domain, '^[^.]*[.]?(.*)$', 1) END AS suffix, sum(n) AS n, sum(b) AS b FROM h GROUP BY ALL),
x AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM d GROUP BY suffix),
{_level("s0", "x")}, {_level("s1", "d")}, {_level("s2", "h")},
xr AS (SELECT suffix, (b + s0.rate * s0) / (n + s0) AS r FROM x, s0),
dr AS (SELECT domain, (b + r * s1) / (n + s1) AS r FROM d JOIN xr USING (suffix), s1),
hr AS (SELECT host, (b + r * s2) / (n + s2) AS r, n + s2 AS m FROM h JOIN dr USING (domain), s2),
v AS (SELECT host, CASE WHEN r - {Z} * sqrt(r * (1 - r) / (m + 1)) > {BAD_RATE} THEN 'block' ELSE 'allow' END AS action FROM hr),
j AS (SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'block example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'block example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'allow com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'block com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'allow org/' END AS hit FROM u)
SELECT page_id, host, path, split_part(hit, ' ', 2) AS rule, coalesce(split_part(hit, ' ', 1), action) AS verdict FROM j JOIN v USING (host)
"""
