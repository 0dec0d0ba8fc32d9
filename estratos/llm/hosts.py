"""Operator 6: URL filter by empirical-Bayes host reputation.

Pages with a known outcome are counted per host. A host's rate of bad pages gets a beta prior around the rate of its
registered domain, that one around the rate of its suffix, and that one around the rate of all pages; how strongly each
level pulls is estimated from how much its members differ (method of moments of the beta-binomial). A host is blocked
if its rate of bad pages lies above `LIMIT` even at the lower bound of the posterior. Given rules go before reputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estratos.llm.common import read, written

#: Rules of the registered query: action, host, start of the path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LIMIT = 0.5
#: Standard deviations from the posterior mean to its bound (95 % one-sided).
Z = 1.645
#: Concentration of a prior whose level has too few members to estimate it.
DEFAULT_CONCENTRATION = 10.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: str) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")


def host_of(url: str) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def domain_of(host: str) -> Column:
    """The last two labels of a host."""
    return F.substring_index(F.col(host), ".", -2)


def suffix_of(domain: str) -> Column:
    return F.substring_index(F.col(domain), ".", -1)


def rule_of(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one text) and its action; null where none fits."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = (F.col(host) == domain) | F.col(host).endswith(f".{domain}")
        fits = fits & F.col(path).startswith(start)
        rule, action = F.when(fits, domain + start).otherwise(rule), F.when(fits, verdict).otherwise(action)
    return rule, action


def _concentration(members: DataFrame) -> float:
    """How many pages the prior of a level is worth, from its members' counts `n` and `k`."""
    rate = F.col("k") / F.col("n")
    row = members.where("n > 0").agg(
        F.count("*").alias("i"), F.sum("n").alias("n"), F.sum("k").alias("k"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("k") * rate).alias("kk"),
    ).first()
    if row["i"] < 2 or row["n"] <= row["i"]:
        return DEFAULT_CONCENTRATION
    between = (row["kk"] - row["k"] * row["k"] / row["n"]) / (row["i"] - 1)
    within = (row["k"] - row["kk"]) / (row["n"] - row["i"])
    size = (row["n"] - row["nn"] / row["n"]) / (row["i"] - 1)
    spread = between + (size - 1) * within
    share = (between - within) / spread if spread > 0 else 0.0
    share = min(max(share, 0.001), 0.9)
    return (1 - share) / share


def reputations(outcomes: DataFrame) -> DataFrame:
    """`host`, `n`, `k` and the posterior `mean` and `deviation` of the rate of bad pages, for each host.

    `outcomes` has `host` and `bad` (1 bad, 0 good, null unknown), one row per page. A host without known outcomes has
    the posterior of its domain; without any known outcome at all the rate is one half.
    """
    hosts = written(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
        .withColumn("domain", domain_of("host")).withColumn("suffix", suffix_of("domain")),
        "hosts",
    )
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    weight = {name: _concentration(level) for name, level in (("s", suffixes), ("d", domains), ("h", hosts))}

    def pulled(prior: Column, strength: float) -> Column:
        return (F.col("k") + strength * prior) / (F.col("n") + strength)

    suffixes = suffixes.select("suffix", pulled(F.lit(overall), weight["s"]).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("domain", pulled(F.col("suffix_rate"), weight["d"]).alias("domain_rate"))
    mean, size = pulled(F.col("domain_rate"), weight["h"]), F.col("n") + weight["h"]
    return hosts.join(domains, "domain").select(
        "host", "n", "k", mean.alias("mean"), F.sqrt(mean * (1 - mean) / (size + 1)).alias("deviation")
    )


def judge(
    pages: DataFrame, outcome: str, rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT, url: str = "url"
) -> DataFrame:
    """The columns of `pages` with `host`, `path`, `rule` and `verdict` (allow or block).

    `outcome` names the column that is 1 for a bad page, 0 for a good one and null where nothing is known. Without a
    `://`, or a url at all, host and path are empty; such pages are judged together. Columns that have one of the four
    names already are replaced. An empty table gives an empty result.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [F.col(f"`{name}`") for name in pages.columns if name not in added]
    named = pages.withColumns({"host": host_of(url), "path": path_of(url)}) if url not in added else pages
    named = named.select(*kept, "host", "path")
    known = reputations(named.select("host", F.col(f"`{outcome}`").alias("bad")))
    verdicts = known.select(
        "host", F.when(F.col("mean") - Z * F.col("deviation") > limit, "block").otherwise("allow").alias("reputation")
    )
    rule, action = rule_of("host", "path", rules)
    return named.join(verdicts, "host").select(
        *kept, "host", "path", rule.alias("rule"), F.coalesce(action, F.col("reputation")).alias("verdict")
    )


def op6_host_reputation(spark, sf_dir: str) -> DataFrame:
    """All pages; a page shows the document whose number its path holds, and is bad if that one is labelled so."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(path_of("url"), "/([0-9]{1,18})", 1)
    pages = pages.withColumn("shown", F.when(number != "", number).cast("long"))
    labels = read(spark, sf_dir, "labels").where("doc_id is not null and quality is not null")
    labels = labels.groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    labelled = pages.join(labels, pages["shown"] == labels["doc_id"], "left").select("page_id", "url", "bad")
    return judge(labelled, "bad").select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, members: str, prior: str) -> str:
    """SQL of the concentration of a level."""
    return f"""
{name}_moments as (
  select count(*)::double as i, sum(n)::double as n, sum(k)::double as k, sum(n::double * n) as nn,
         sum(k * (k::double / n)) as kk from {members} where n > 0),
{name}_parts as (
  select i, n, (kk - k * k / n) / nullif(i - 1, 0) as between_, (k - kk) / nullif(n - i, 0) as within_,
         (n - nn / n) / nullif(i - 1, 0) as size_ from {name}_moments),
{name}_share as (
  select case when i < 2 or n <= i or i = 0 then null
              when between_ + (size_ - 1) * within_ > 0
              then least(greatest((between_ - within_) / (between_ + (size_ - 1) * within_), 0.001::double), 0.9::double)
              else 0.001::double end as share from {name}_parts),
{prior} as (select coalesce((1 - share) / share, {DEFAULT_CONCENTRATION}::double) as m from {name}_share)"""


ORACLE = f"""
with named as (
  select page_id, url,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from named),
label as (select doc_id, 1 - min(quality) as bad from labels where doc_id is not null and quality is not null group by 1),
outcome as (
  select s.*, l.bad from split s
  left join label l on l.doc_id = try_cast(nullif(regexp_extract(s.path, '/([0-9]{{1,18}})', 1), '') as bigint)),
hosts as (
  select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as k,
         array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix
  from outcome group by host),
domains as (select suffix, domain, sum(n)::bigint as n, sum(k)::bigint as k from hosts group by 1, 2),
suffixes as (select suffix, sum(n)::bigint as n, sum(k)::bigint as k from domains group by 1),
overall as (select (coalesce(sum(k), 0) + 1)::double / (coalesce(sum(n), 0) + 2) as rate from suffixes),
{_level("s", "suffixes", "ms")}, {_level("d", "domains", "md")}, {_level("h", "hosts", "mh")},
suffix_rates as (select suffix, (k + m * rate) / (n + m) as rate from suffixes, ms, overall),
domain_rates as (select domain, (k + m * r.rate) / (n + m) as rate from domains d join suffix_rates r using (suffix), md),
posterior as (
  select host, (k + m * rate) / (n + m) as mean, n + m as size_ from hosts join domain_rates using (domain), mh),
bounded as (select host, mean - {Z} * sqrt(mean * (1 - mean) / (size_ + 1)) > {LIMIT} as bad from posterior),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from split)
select page_id, host, path, rule,
  case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
       when bad then 'block' else 'allow' end as verdict
from ruled join bounded using (host)
"""
