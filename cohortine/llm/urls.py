"""URL filter: site rules first, then an empirical-Bayes reputation of hosts.

Pages with a known outcome are counted by host. A host's rate of good pages is shrunk to
that of its registered domain, which is shrunk to that of its suffix, which is shrunk to
the overall rate, each by a beta-binomial prior whose strength is estimated from the
spread of the rates below it (method of moments). A page is blocked when the lower
posterior bound of its host's rate of bad pages is above a limit, so a host is only
blocked on evidence. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second labels under which countries register names, as in ``com.cn``.
COUNTRY_SECOND_LABELS = (
    "ac", "asn", "co", "com", "ed", "edu", "gen", "go", "gob", "gouv", "gov", "govt", "id", "ltd",
    "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "police", "sch", "school",
)
#: Suffixes of two labels that the rule above does not give, shared hosts mostly.
MORE_SUFFIXES = (
    "appspot.com", "azurewebsites.net", "blogspot.com", "cloudfront.net", "fly.dev", "github.io",
    "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "readthedocs.io", "vercel.app",
    "web.app", "wordpress.com", "workers.dev",
)


@dataclass(frozen=True)
class SiteRule:
    """A rule for a host with all its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Reputation:
    #: Block when the rate of bad pages is above this with the given certainty.
    max_bad: float = 0.5
    #: Standard deviations from the posterior mean to the bound.
    z: float = 1.645
    #: A suffix has two labels if it is a country's with one of these before it, or listed.
    country_second_labels: tuple[str, ...] = COUNTRY_SECOND_LABELS
    more_suffixes: tuple[str, ...] = MORE_SUFFIXES
    #: Limits of the prior strength, in pages.
    weakest: float = 1.0
    strongest: float = 1000.0
    #: Parts a hot host's pages are dealt into for the last join.
    salts: int = 16


def host_of(url: Column) -> Column:
    """Lower-case host between the first ``://`` and ``/``, ``?``, ``#`` or the end."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def matching_rule(host: Column, path: Column, rules: Sequence[SiteRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does.

    Rules are tried from the longest on, so the number of rules should be moderate.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host, r.path)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path)
        )
        found = F.struct(
            F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")
        )
        out = F.when(fits, found).otherwise(out)
    return out


def names_of(host: Column, settings: Reputation) -> tuple[Column, Column]:
    """Registered domain and suffix of a host.

    The suffix is found by rule: ``com.cn``, ``co.za`` or ``gov.uk`` are a usual second label
    before a country's two letters. A host that is itself a suffix is its own domain.
    """
    labels = F.split(host, r"\.", -1)
    last_two = F.substring_index(host, ".", -2)
    seconds = "|".join(settings.country_second_labels)
    double = last_two.rlike(f"^(?:{seconds})[.][a-z][a-z]$") | last_two.isin(
        list(settings.more_suffixes)
    )
    suffix = F.when(double, last_two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(double, F.substring_index(host, ".", -3)).otherwise(last_two)
    return F.when(F.size(labels) == 1, host).otherwise(domain), suffix


def _strength(level: DataFrame, limits: Reputation) -> float:
    """Prior strength from rows (n, good, parent_n, parent_good) of one level.

    The rates' spread around their parents' rates, beyond what binomial chance gives,
    is the correlation rho of pages of one group; the strength is (1 - rho) / rho.
    """
    n, parent = F.col("n"), F.try_divide("parent_good", "parent_n")
    var = parent * (1 - parent)
    own = 1 - F.try_divide(n, "parent_n")
    away = F.try_divide("good", n) - parent
    spread, chance, most = (
        level.where("n > 0")
        .agg(
            F.sum(n * away * away),
            F.sum(var * own),
            F.sum(var * (n - 1) * own),
        )
        .first()
    )
    if not most or spread is None or spread <= chance:
        return limits.strongest
    rho = min((spread - chance) / most, 1.0)
    return min(max((1 - rho) / rho, limits.weakest), limits.strongest)


def host_reputation(outcomes: DataFrame, settings: Reputation = Reputation()) -> DataFrame:
    """Posterior of every host from rows ``host``, ``good`` (1, 0 or null if unknown).

    With a column ``pages`` a row stands for so many pages.

    Returns ``host``, ``labelled`` (pages with an outcome), ``good_rate`` (posterior mean)
    and ``bad_bound`` (lower bound of the rate of bad pages). Without any outcome the rate
    is 1 and nothing is known against a host. Pages are added up per host before they are
    shuffled, so a hot host is no hot key.
    """
    times = F.col("pages") if "pages" in outcomes.columns else F.lit(1)
    known = F.when(F.col("good").isNotNull(), times).otherwise(0)
    hosts = outcomes.groupBy("host").agg(
        F.sum(known).alias("n"), F.coalesce(F.sum(F.col("good") * times), F.lit(0)).alias("good")
    )
    domain, suffix = names_of(F.col("host"), settings)
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    counts = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    n, good = suffixes.agg(F.sum("n"), F.sum("good")).first()
    overall = good / n if n else 1.0

    def under(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
        above = parent.select(
            on, F.col("n").alias("parent_n"), F.col("good").alias("parent_good")
        )
        return child.join(above, on)

    top = suffixes.withColumns({"parent_n": F.lit(n or 0), "parent_good": F.lit(good or 0)})
    strengths = [
        _strength(level, settings)
        for level in (top, under(domains, suffixes, "suffix"), under(hosts, domains, "domain"))
    ]

    def posterior(child: DataFrame, strength: float, keys: list[str]) -> DataFrame:
        """``keys``, n, and mean ``r`` and variance ``v`` of the rate; prior in pr, pv."""
        m, n = F.lit(strength), F.col("n")
        rate = child.withColumn("r", (m * F.col("pr") + F.col("good")) / (m + n))
        own = F.col("r") * (1 - F.col("r")) / (m + n + 1)
        # What is not known about the prior mean counts as far as the rate leans on it.
        lean = m / (m + n)
        return rate.select(*keys, "n", "r", (own + lean * lean * F.col("pv")).alias("v"))

    def prior(level: DataFrame, on: str) -> DataFrame:
        return level.select(on, F.col("r").alias("pr"), F.col("v").alias("pv"))

    start = suffixes.withColumns({"pr": F.lit(overall), "pv": F.lit(0.0)})
    by_suffix = posterior(start, strengths[0], ["suffix"])
    by_domain = posterior(
        domains.join(prior(by_suffix, "suffix"), "suffix"), strengths[1], ["domain"]
    )
    by_host = posterior(hosts.join(prior(by_domain, "domain"), "domain"), strengths[2], ["host"])
    bound = 1 - F.col("r") - settings.z * F.sqrt("v")
    return by_host.select(
        "host", F.col("n").alias("labelled"), F.col("r").alias("good_rate"), bound.alias("bad_bound")
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[SiteRule],
    settings: Reputation = Reputation(),
    id_col: str = "page_id",
    url_col: str = "url",
    label_key: str = r"^/[a-z]{2}/([0-9]+)",
    label_id: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``labelled``, ``bad_bound`` per page.

    A page's outcome is the label whose id stands in its path (``label_key``); an id with
    several labels counts as its least one, null and other values as unknown. A null url
    or one without ``://`` has an empty host and path and is judged like the host ``""``.
    Repeated rows and null ids give a row each; other columns are not read.
    """
    url = F.col(url_col)
    parsed = pages.select(
        F.col(id_col).alias("__id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    outcomes = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).cast("string").alias("key"))
        .agg(F.min(label_col).cast("bigint").alias("good"))
    )
    keyed = parsed.select(
        "host", F.nullif(F.regexp_extract("path", label_key, 1), F.lit("")).alias("key")
    )
    # Pages without an id, which may be nearly all, and repeated ids are added up before the
    # join, and rows without a key never meet it.
    counted = keyed.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages"))
    named = counted.where(F.col("key").isNotNull()).join(outcomes, "key", "left")
    unnamed = counted.where(F.col("key").isNull()).withColumn("good", F.lit(None).cast("bigint"))
    reputation = host_reputation(named.unionByName(unnamed), settings)
    # The pages of a hot host meet one copy of its row in each of ``salts`` parts.
    every = F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1)))
    salt = F.pmod(F.xxhash64("__id", "path"), F.lit(settings.salts)).cast("int")
    judged = parsed.withColumn("salt", salt).join(
        reputation.withColumn("salt", every), ["host", "salt"]
    )
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return judged.select(
        F.col("__id").alias(id_col),
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(
            rule["verdict"],
            F.when(F.col("bad_bound") > settings.max_bad, "block").otherwise("allow"),
        ).alias("verdict"),
        "labelled",
        F.round("bad_bound", 4).alias("bad_bound"),
    )
