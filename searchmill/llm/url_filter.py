"""URL filter: fixed host and path rules, and empirical-Bayes reputation of hosts.

Outcomes of labelled pages (1 good, 0 bad) are shrunk level by level: a suffix (`org`) towards
the rate of all pages, a registered domain (`example.org`) towards its suffix, a host towards
its domain. Each level's prior is a beta distribution whose strength is fitted by moments over
that level's groups (beta-binomial). A host's verdict is `allow` if the lower bound of its
posterior (mean less `z` standard deviations) reaches `least`.

A host without labelled pages has its domain's posterior mean as prior mean, and so on up to
the rate of all pages; without any labels that rate is 1/2. Registered domain: the last two
labels of a host. Suffix: the last label. A table of public suffixes may be given (`suffixes`):
hosts under one of them have it as suffix, and it and the label before as registered domain; the
others keep the last two labels.

Null or malformed URLs (no `://`) have an empty host and path, fit no rule, and are judged as
the host ''. Repeated pages are judged one by one; labels with null count for nothing.
Everything is DataFrame operations: the counts are summed map-side first, so a host that holds
a third of all pages costs a row per task; verdicts are joined by host, where Spark broadcasts
the small side if its size allows and splits skewed partitions otherwise. The counts per host are
written once, as each level's prior and posterior come from them. URLs of any length are one value;
extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchmill.llm.tables import small, written

RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
"""(verdict, host, start of the path): each fits its host and all subdomains; the longest wins."""

LEAST = 0.5
Z = 1.645
LEVELS = ["suffix", "domain", "host"]
SUFFIX_ROWS = 1 << 17
"""Suffixes that may be sent to all tasks (the public list has some ten thousand); more are shuffled."""
GROUP_ROWS = 1 << 16
"""Posteriors of suffixes, domains or hosts that may be sent to all tasks; more are shuffled."""


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without `://`. Only A-Z are lower-cased."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return (
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        path,
    )


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. A tie goes to the first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _last_labels(host: Column, n: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -n)


def _suffix_rules(suffixes: DataFrame) -> DataFrame:
    """(name, more): hosts that end with `name` have its labels and `more` others as suffix."""
    rule = F.lower(F.trim("suffix"))
    name = F.regexp_replace(rule, r"^(!|\*?\.)", "")
    more = F.when(rule.startswith("!"), -1).when(rule.startswith("*."), 1).otherwise(0)
    rules = suffixes.select(name.alias("name"), more.alias("more")).where("name <> ''").distinct()
    return small(rules, SUFFIX_ROWS)


def host_levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """`hosts` (host and other columns, each host once) with its registered domain and suffix.

    `suffixes` has a column `suffix` as the public suffix list writes it (`co.uk`, `*.ck`,
    `!www.ck`), its labels spelt as in hosts: an exception wins, else the longest. A port counts
    for the last label but for no comparison. A host that is a suffix is its own domain.
    """
    host, columns = F.col("host"), hosts.columns
    labels = F.lit(1)
    if suffixes is not None:
        rules = _suffix_rules(suffixes)
        longest = rules.agg(F.coalesce(F.max(F.size(F.split("name", r"\."))), F.lit(1))).scalar()
        size = F.size(F.split(host, r"\."))
        bare = F.regexp_replace(host, r":[0-9]*$", "")
        ends = hosts.select("*", F.explode(F.sequence(F.lit(1), F.least(size, longest))).alias("at"))
        ends = ends.withColumn("name", _last_labels(bare, F.col("at")))
        fits = F.col("at") + F.col("more") <= size
        hosts = (
            ends.join(rules, "name", "left")
            .groupBy(*columns)
            .agg(
                F.max(F.when(F.col("more") < 0, F.col("at") - 1)).alias("except"),
                F.max(F.when((F.col("more") >= 0) & fits, F.col("at") + F.col("more"))).alias("most"),
            )
        )
        labels = F.greatest(F.coalesce("except", "most", F.lit(1)), F.lit(1))
    return hosts.select(
        *columns,
        _last_labels(host, labels + 1).alias("domain"),
        _last_labels(host, labels).alias("suffix"),
    )


def _strength(groups: DataFrame, rate: Column, prefix: str) -> DataFrame:
    """Strength of the beta prior over `groups` (good, n, prior rate) by moments: one row.

    With p the weighted rate around its prior, E[(p - prior)^2] = prior (1 - prior)
    (1 + (n - 1) rho) / n for each group; rho pooled over groups gives strength 1 / rho - 1.
    """
    spread = rate * (1 - rate)
    off = F.pow(F.col("good") / F.col("n") - rate, F.lit(2)) * F.col("n")
    sums = groups.agg(
        F.sum(off - spread).alias("more"), F.sum(spread * (F.col("n") - 1)).alias("most")
    )
    rho = F.least(
        F.greatest(F.coalesce(F.col("more") / F.nullif(F.col("most"), F.lit(0.0)), F.lit(0.0)), F.lit(0.001)),
        F.lit(0.999),
    )
    return sums.select((1 / rho - 1).alias(f"{prefix}_strength"))


def host_reputation(
    pages: DataFrame, outcomes: DataFrame, z: float = Z, suffixes: DataFrame | None = None
) -> DataFrame:
    """(host, n_labelled, mean, bound) of each host in `pages` (page_id, url).

    `outcomes` has (page_id, good); a page labelled twice counts twice. `suffixes` as in
    `host_levels`.
    """
    host, _ = url_parts(F.col("url"))
    hosts = pages.select("page_id", host.alias("host"))
    labelled = outcomes.select("page_id", F.col("good").cast("double").alias("good")).where(
        F.col("good").isNotNull() & F.col("page_id").isNotNull()
    )
    counts = (
        hosts.join(labelled, "page_id", "left")
        .groupBy("host")
        .agg(F.sum(F.coalesce("good", F.lit(0.0))).alias("good"), F.count("good").alias("n"))
    )
    # One row a host: written, as each level's prior and its posterior come from it.
    counts = written(host_levels(counts, suffixes).select("host", "domain", "suffix", "good", "n"), "host-counts")

    totals = counts.agg(F.sum("good").alias("g"), F.sum("n").alias("m"))
    prior = totals.select(F.coalesce(F.col("g") / F.nullif(F.col("m"), F.lit(0)), F.lit(0.5)).alias("prior"))
    known = counts.withColumn("prior", prior.scalar())
    for level in LEVELS:
        above = [x for x in LEVELS[: LEVELS.index(level) + 1]]
        groups = written(
            known.groupBy(*above).agg(
                F.sum("good").alias("good"), F.sum("n").alias("n"), F.max("prior").alias("prior")
            ),
            f"{level}-counts",
        )
        strength = _strength(groups.where("n > 0"), F.col("prior"), level)
        groups = groups.withColumn(f"{level}_strength", strength.scalar())
        alpha = F.col("prior") * F.col(f"{level}_strength") + F.col("good")
        beta = (1 - F.col("prior")) * F.col(f"{level}_strength") + F.col("n") - F.col("good")
        mean = alpha / (alpha + beta)
        sd = F.sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1)))
        posterior = groups.select(
            *above, mean.alias("mean"), F.greatest(mean - z * sd, F.lit(0.0)).alias("bound")
        )
        # A third of all hosts may be under one suffix: few groups are sent to all tasks.
        known = known.drop("prior", "bound").join(small(posterior, GROUP_ROWS), above).withColumnRenamed("mean", "prior")
    return known.select("host", F.col("n").alias("n_labelled"), F.col("prior").alias("mean"), "bound")


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    least: float = LEAST,
    z: float = Z,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """Each page of (page_id, url) with host, path, rule, verdict, bound and n_labelled."""
    pages = pages.select("page_id", "url")
    host, path = url_parts(F.col("url"))
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).select(
        "page_id", "host", "path", rule.alias("rule"), said.alias("said")
    )
    known = host_reputation(pages, outcomes, z, suffixes)
    by_method = F.when(F.col("bound") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return judged.join(known, "host").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", by_method).alias("verdict"),
        "bound",
        "n_labelled",
    )
