"""URL filter: listed rules first, else the host's reputation.

Reputation is a beta-binomial posterior of the labelled outcomes of a host's pages. Each level lends its posterior mean
to the level below as a prior: all pages -> public suffix -> registered domain -> host. The weight of a prior is
estimated from how much the groups of that level really differ (method of moments).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import attached, dealt, grouped, salted, written

#: Fixed values: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
LEAST, MOST = 2.0, 1000.0
#: Public suffixes of two labels; any other last label is a suffix of its own. A parameter of judged().
SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ac.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za", "com.ar", "gov.it", "edu.it"]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def site_of(host: Column, suffixes: list[str]) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without user name and port. An IP address is both by itself."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    ip = bare.startswith("[") | bare.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")
    two = F.substring_index(bare, ".", -2).isin(suffixes)
    suffix = F.when(ip, bare).when(two, F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(ip, bare).when(two, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    return domain, suffix


def prior_weight(groups: DataFrame, mean: float) -> float:
    """Rows that the prior of this level counts as: mean * (1 - mean) over the variance between groups, less one."""
    n = F.col("n").cast("double")
    r = groups.where(n > 0).agg(
        F.sum(n * (F.col("k") / n - mean) * (F.col("k") / n - mean)).alias("dev"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.count(F.lit(1)).alias("groups")
    ).first()
    if not r["n"] or r["groups"] < 2 or r["n"] * r["n"] <= r["nn"]:
        return MOST
    within = mean * (1 - mean)
    between = (r["dev"] / r["n"] - within * (r["groups"] - 1) / r["n"]) / (1 - r["nn"] / r["n"] ** 2)
    return min(MOST, max(LEAST, within / between - 1)) if between > 0 else MOST


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    return written(grouped(rows, key, {c: (F.sum(c), F.sum) for c in ("n", "k")}))


def reputations(rows: DataFrame, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """rows: host, n, k (labelled and good pages), salt -> one row per host: host, salts, n, k, mean, weight.

    Hosts without labelled pages take what their domain, suffix or all pages say. Without any label the mean is 0.5.
    The suffix is the last label of the host, or its last two where suffixes has them, the registered domain one more.
    """
    hosts = _grouped(rows, "host").withColumn("domain", site_of(F.col("host"), suffixes)[0])
    domains = _grouped(salted(hosts.drop("salts"), F.col("host")), "domain").withColumn("suffix", site_of(F.col("domain"), suffixes)[1])
    suffixes = _grouped(salted(domains.drop("salts"), F.col("domain")), "suffix")
    t = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = (t["k"] or 0) / t["n"] if t["n"] else 0.5
    up, levels = None, [("suffix", suffixes, None), ("domain", domains, "suffix"), ("host", hosts, "domain")]
    for key, groups, parent in levels:
        m = prior_weight(groups, mean)
        if parent is None:
            groups = groups.withColumn("prior", F.lit(float(mean)))
        else:
            groups = attached(salted(groups.withColumnRenamed("salts", "own"), F.col(key)), up.select(parent, "salts", F.col("mean").alias("prior")), parent).withColumnRenamed("own", "salts")
        up = groups.withColumn("weight", F.col("n") + m).withColumn("mean", (F.col("k") + m * F.col("prior")) / F.col("weight"))
    return up.select("host", "salts", "n", "k", "mean", "weight")


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES, least_good: float = 0.5, z: float = 1.645, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """pages (page_id, url): page_id, host, path, rule, verdict, n_labelled, n_good.

    outcomes: page_id, good (0, 1 or null). A page without a rule is blocked when the upper posterior bound (z standard
    deviations) of its host's share of good pages is under least_good: only a host that is surely bad goes. A url that
    is null or has no :// has an empty host and path and is judged as the host "". Repeated rows are judged alike. Port and
    user name stay in host but count for nothing in domain and suffix. No pages give no rows.
    """
    good = outcomes.where("good is not null").groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("k"))
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).join(good, "page_id", "left")
    rows = written(dealt(rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in "nk"})))
    hosts = reputations(rows, suffixes).select("host", "salts", F.col("n").alias("n_labelled"), F.col("k").alias("n_good"), "mean", "weight")
    mean = F.col("mean")
    bound = mean + z * F.sqrt(mean * (1 - mean) / (F.col("weight") + 1))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(bound < least_good, "block").otherwise("allow")
    return attached(rows, hosts, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "n_labelled", "n_good")


def query(spark, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The tables label documents alone; a page takes the label of the document with its number as its outcome."""
    return judged(pages, labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good")))


def _level(name: str, rows: str, key: str, parent: str | None, up: str | None) -> str:
    weight = f"""{name}_w AS (
  SELECT CASE WHEN n IS NULL OR g < 2 OR n * n <= nn THEN {MOST}
              WHEN (dev / n - p * (1 - p) * (g - 1) / n) / (1 - nn / (n * n)) > 0
              THEN least({MOST}, greatest({LEAST}, p * (1 - p) / ((dev / n - p * (1 - p) * (g - 1) / n) / (1 - nn / (n * n))) - 1))
              ELSE {MOST} END AS m
  FROM (SELECT sum(n * (k / n - p) * (k / n - p)) AS dev, sum(n) AS n, sum(n * n) AS nn, count(*) AS g, any_value(p) AS p
        FROM (SELECT CAST(n AS DOUBLE) AS n, CAST(k AS DOUBLE) AS k, p FROM {rows}, total WHERE n > 0)))"""
    prior, source = ("p", f"{rows} a, total") if up is None else ("u.mean", f"{rows} a JOIN {up} u ON u.{parent} = a.{parent}")
    prior = f"{name}_p AS (SELECT a.*, a.n + m AS weight, (a.k + m * {prior}) / (a.n + m) AS mean FROM {source}, {name}_w)"
    return f"{weight},\n{prior}"


SQL = f"""
WITH o AS (SELECT doc_id AS page_id, count(quality) AS n, sum(quality) AS k FROM labels WHERE quality IS NOT NULL GROUP BY 1),
r AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, coalesce(n, 0) AS n, coalesce(k, 0) AS k
      FROM pages LEFT JOIN o USING (page_id)),
b AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare, n, k FROM r),
e AS (SELECT host, bare, string_split(bare, '.') AS p, starts_with(bare, '[') OR regexp_matches(bare, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') AS ip,
             array_to_string(string_split(bare, '.')[-2:], '.') IN ({", ".join(map(repr, SUFFIXES))}) AS two, n, k FROM b),
h AS (SELECT host, CASE WHEN ip THEN bare WHEN two THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain,
             CASE WHEN ip THEN bare WHEN two THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix, sum(n) AS n, sum(k) AS k FROM e GROUP BY 1, 2, 3),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY 1),
total AS (SELECT CASE WHEN sum(n) > 0 THEN CAST(sum(k) AS DOUBLE) / sum(n) ELSE 0.5 END AS p FROM s),
{_level("s", "s", "suffix", None, None)},
{_level("d", "d", "domain", "suffix", "s_p")},
{_level("h", "h", "host", "domain", "d_p")}
SELECT page_id, host, path,
  CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block'
       ELSE CASE WHEN mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END END AS verdict,
  CAST(h_p.n AS BIGINT) AS n_labelled, CAST(h_p.k AS BIGINT) AS n_good
FROM r JOIN h_p USING (host)
"""
