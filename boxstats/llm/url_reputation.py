"""URL filters: path rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted by host. A host's rate of bad pages is shrunk
to its registered domain's, the domain's to its public suffix's, the suffix's to that of all
labelled pages: at each level the groups are beta-binomial around their parents' rates, with an
overdispersion estimated from all groups by moments, so that a level whose groups differ much
shrinks little. A host is blocked if the lower bound of its posterior rate exceeds a threshold.

DataFrame functions only. Counting is one aggregation by host, combined before its shuffle, so
a host with a third of all pages is no burden; the driver gets the three overdispersions and the
overall counts. Pages are joined with the blocked hosts alone.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged like any host; pages without a label count as none; a label that is null counts as
none; several labels of a page count as one, bad if any is; repeated pages are all judged and
all counted; with no labels at all every host has the prior's rate; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm import store

#: Labels under which registries of countries give names out. With a country's two
#: letters behind one of them the public suffix has two labels. A rule in place of the registries'
#: own list, which isn't here: names under other registries' suffixes count as one domain.
SECOND_LEVELS = ("ac", "co", "com", "edu", "gen", "go", "gob", "gov", "govt", "id", "mil", "ne", "net", "nom", "or", "org", "sch")
_TWO = f"^({'|'.join(SECOND_LEVELS)})[.][a-z][a-z]$"
_ADDRESS = "^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$"

#: (verdict, host, path) of the rules that the query asks for.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: Prior counts of bad and other pages for the overall rate.
PRIOR = 0.5
#: An overdispersion is kept between these.
LEAST, MOST = 0.0001, 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bare(host: Column) -> Column:
    return F.regexp_replace(host, ":[0-9]*$", "")


def _two(bare: Column) -> Column:
    return F.substring_index(bare, ".", -2).rlike(_TWO)


def suffix_of(host: Column) -> Column:
    """The last label, or the last two if they are a public suffix; without a port. All numeric
    addresses have one of their own."""
    bare = _bare(host)
    return F.when(bare.rlike(_ADDRESS), "address").when(_two(bare), F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it; a numeric address whole."""
    bare = _bare(host)
    return F.when(bare.rlike(_ADDRESS), bare).when(_two(bare), F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], what: int | None = None) -> Column:
    """The longest rule that fits, as ``host/path`` or (what=0) its verdict; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        found = F.when(fits, F.lit(rule[1] + rule[2] if what is None else rule[what])).otherwise(found)
    return found


def _spread(groups: DataFrame, parent: str) -> float:
    """The moment estimate of the groups' overdispersion around their parents' rates."""
    n, k, mu = F.col("n"), F.col("k"), F.col(parent)
    noise = mu * (1 - mu)
    excess, base = groups.agg(F.sum((k - n * mu) * (k - n * mu) - n * noise), F.sum(n * (n - 1) * noise)).first()
    return min(max(excess / base, LEAST), MOST) if base else LEAST


def _posterior(rate: str, spread: float) -> Column:
    weight = 1 / spread - 1
    return (F.lit(weight) * F.col(rate) + F.col("k")) / (F.lit(weight) + F.col("n"))


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """host, n, k, rate and bound (the posterior's lower bound) of every host in ``pages``.

    pages: page_id, host. outcomes: page_id, bad (0 or 1; null counts as none).
    """
    known = outcomes.where("bad is not null and page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counted = pages.join(known, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = store.keep(counted.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), F.col("n").cast("double"), F.col("k").cast("double")), "host-outcomes")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("k"), F.lit(0.0))).first()
    suffixes = suffixes.withColumn("above", F.lit((k + PRIOR) / (n + 2 * PRIOR)))
    suffixes = suffixes.select("suffix", _posterior("above", _spread(suffixes, "above")).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix")
    domains = domains.select("domain", _posterior("suffix_rate", _spread(domains, "suffix_rate")).alias("domain_rate"))
    hosts = hosts.join(domains, "domain")
    spread = _spread(hosts, "domain_rate")
    rate, weight = F.col("rate"), 1 / spread - 1
    hosts = hosts.withColumn("rate", _posterior("domain_rate", spread))
    return hosts.select("host", "n", "k", "rate", (rate - z * F.sqrt(rate * (1 - rate) / (F.lit(weight) + F.col("n") + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5, z: float = 1.645, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every page.

    outcomes: page_id, bad. Rules are a short list held in the plan; the longest that fits
    wins, and pages without one are blocked if their host's lower bound exceeds ``threshold``.
    """
    url = F.col(url_column).cast("string")
    seen = pages.select(F.col(id_column).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    blocked = reputation(seen.select("page_id", "host"), outcomes, z).where(F.col("bound") > threshold).select("host", F.lit("block").alias("method"))
    host, path = F.col("host"), F.col("path")
    return seen.join(blocked, "host", "left").select("page_id", "host", "path", rule_of(host, path, rules).alias("rule"), F.coalesce(rule_of(host, path, rules, 0), F.col("method"), F.lit("allow")).alias("verdict"))


def oracle(threshold: float = 0.5, z: float = 1.645) -> str:
    """The query over ``pages`` and ``labels`` in DuckDB's SQL."""
    cases = {}
    for what in (None, 0):
        cases[what] = " ".join(f"when (host = '{r[1]}' or ends_with(host, '.{r[1]}')) and starts_with(path, '{r[2]}') then '{r[1] + r[2] if what is None else r[0]}'" for r in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    spread = "greatest({0}, least({1}, coalesce(sum((k - n * m) * (k - n * m) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), {0})))".format(LEAST, MOST)
    return f"""
with seen as (
  select page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
known as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels
  where doc_id is not null and (quality = 0 or toxic = 1 or (quality is not null and toxic is not null)) group by doc_id),
counted as (select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as k
  from seen left join known on seen.page_id = known.doc_id group by host),
labels_of as (select *, regexp_replace(host, ':[0-9]*$', '') as bare, string_split(bare, '.') as l from counted),
hosts as (select *, regexp_matches(array_to_string(l[-2:], '.'), '{_TWO}') as two, regexp_matches(bare, '{_ADDRESS}') as address from labels_of),
named as (select host, n, k, case when address then bare else array_to_string(case when two then l[-3:] else l[-2:] end, '.') end as domain,
  case when address then 'address' else array_to_string(case when two then l[-2:] else l[-1:] end, '.') end as suffix from hosts),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from named group by domain, suffix),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by suffix),
overall as (select (coalesce(sum(k), 0) + {PRIOR}) / (coalesce(sum(n), 0) + {2 * PRIOR}) as m from suffixes),
s1 as (select s.*, o.m from suffixes s, overall o),
w1 as (select 1 / ({spread}) - 1 as w from s1),
p1 as (select suffix, (w * m + k) / (w + n) as m from s1, w1),
s2 as (select d.*, p1.m from domains d join p1 using (suffix)),
w2 as (select 1 / ({spread}) - 1 as w from s2),
p2 as (select domain, (w * m + k) / (w + n) as m from s2, w2),
s3 as (select h.*, p2.m from named h join p2 using (domain)),
w3 as (select 1 / ({spread}) - 1 as w from s3),
p3 as (select host, n, w, (w * m + k) / (w + n) as rate from s3, w3),
blocked as (select host from p3 where rate - {z} * sqrt(rate * (1 - rate) / (w + n + 1)) > {threshold})
select seen.page_id, seen.host, seen.path, case {cases[None].replace("host", "seen.host").replace("path", "seen.path")} end as rule,
  coalesce(case {cases[0].replace("host", "seen.host").replace("path", "seen.path")} end, case when blocked.host is not null then 'block' end, 'allow') as verdict
from seen left join blocked on seen.host = blocked.host"""
