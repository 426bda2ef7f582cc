"""URL filter: host reputation by empirical Bayes, under explicit rules.

Labelled page outcomes (1 = bad page) are counted per host, registered domain
and suffix.  Each level's bad rate is shrunk towards its parent with a
beta-binomial prior: suffix towards the whole table, registered domain towards
its suffix, host towards its registered domain.  The strength of each prior is
estimated from the counts themselves (method of moments on the intra-class
correlation of the children around their parents), so a level whose children
agree shrinks strongly and one whose children differ hardly at all.  A host is
blocked when the lower posterior bound of its bad rate exceeds ``cutoff``.

The suffix is the host's last label and the registered domain its last two,
whatever the suffix: hosts under co.uk or github.io share one registered domain, and
a port stays part of the last label.

Only per-host counts are shuffled before the final join on the host; a host
with a third of all pages is one partial row per map task, and its join
partition is split by the adaptive skew join.

Defined cases: null url or one without ``://`` has empty host and path and is
judged as the host ``''``; hosts without outcomes are judged by their parents;
a page with several outcome rows is bad if one of them is; repeated pages are
judged row by row; null outcomes count as missing; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import ascii_lower

#: (verdict, host, path): a rule holds for its host and all subdomains when the path starts with ``path``.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
CUTOFF = 0.5
Z = 1.645

#: The prior's strength from children (n, x) around their parents' rates q: rho = (S - V) / W, m = 1 / rho - 1.
_STRENGTH = (
    "SELECT 1.0 / greatest(0.001, least(0.5, coalesce((sum(n * (x * 1.0 / n - q) * (x * 1.0 / n - q)) - sum(q * (1 - q)))"
    " / nullif(sum(q * (1 - q) * (n - 1)), 0), 0.1))) - 1 FROM {child} WHERE n > 0"
)

#: Shared by Spark and the DuckDB twin; ``judged`` has (page_id, host, path, bad).
REPUTATION_CTES = f"""
host_counts AS (
  SELECT host, {{domain}} AS domain, {{suffix}} AS suffix, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS x
  FROM judged GROUP BY host),
domain_counts AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM host_counts GROUP BY domain, suffix),
suffix_counts AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domain_counts GROUP BY suffix),
suffix_prior AS (
  SELECT suffix, n, x, (SELECT (sum(x) + 0.5) / (sum(n) + 1) FROM suffix_counts) AS q FROM suffix_counts),
suffix_rate AS (
  SELECT suffix, (x + m * q) / (n + m) AS rate
  FROM (SELECT suffix, n, x, q, ({_STRENGTH.format(child="suffix_prior")}) AS m FROM suffix_prior) s),
domain_prior AS (
  SELECT d.domain, d.suffix, d.n, d.x, s.rate AS q FROM domain_counts d JOIN suffix_rate s ON d.suffix = s.suffix),
domain_rate AS (
  SELECT domain, suffix, (x + m * q) / (n + m) AS rate
  FROM (SELECT domain, suffix, n, x, q, ({_STRENGTH.format(child="domain_prior")}) AS m FROM domain_prior) d),
host_prior AS (
  SELECT h.host, h.n, h.x, d.rate AS q
  FROM host_counts h JOIN domain_rate d ON h.domain = d.domain AND h.suffix = d.suffix),
host_posterior AS (
  SELECT host, n, x, x + m * q AS a, n - x + m * (1 - q) AS b
  FROM (SELECT host, n, x, q, ({_STRENGTH.format(child="host_prior")}) AS m FROM host_prior) h),
reputation AS (
  SELECT host, n AS n_outcomes, x AS n_bad, a / (a + b) AS bad_rate,
    a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bad_bound
  FROM host_posterior)"""

_DOMAIN = r"regexp_extract(host, '([^.]*[.])?[^.]*$', 0)"
_SUFFIX = r"regexp_extract(host, '[^.]*$', 0)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, then up to ``? #``; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):  # the last applied wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_reputation(judged: DataFrame) -> DataFrame:
    """host, n_outcomes, n_bad, bad_rate, bad_bound from (host, bad) rows; ``bad`` null = no outcome."""
    ctes = REPUTATION_CTES.format(domain=_DOMAIN, suffix=_SUFFIX).replace("FROM judged", "FROM {judged}")
    return judged.sparkSession.sql(f"WITH {ctes} SELECT * FROM reputation", judged=judged.select("host", "bad"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               cutoff: float = CUTOFF) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound for every row of ``pages``.

    ``outcomes`` has (page_id, bad): 1 for a bad page, 0 for a good one.
    """
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    rep = host_reputation(split.join(known, "page_id", "left")).select("host", "bad_bound")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return split.join(rep, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bad_bound") > cutoff, "block").otherwise("allow")).alias("verdict"),
        "bad_bound")
