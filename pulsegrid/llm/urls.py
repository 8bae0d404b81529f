"""URL filter: explicit host and path rules, then a reputation of the host shrunk through its parents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import ascii_lower, written

PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"
# Second-level labels under which country domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_from(text: str) -> list[Rule]:
    """Rules from `allow org/, block example.org/es/`; the host ends before the first slash."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        verdict, target = part.split()
        cut = target.index("/")
        out.append(Rule(verdict, target[:cut], target[cut:]))
    return out


def url_host(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 2)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end to `?`, `#` or the end; empty without `://` or for null."""
    return F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The part under which names are registered: the last label, or two for `co.uk` and the like."""
    two = rf"(?:^|\.)((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$"
    return F.when(host.rlike(two), F.regexp_extract(host, two, 1)).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: one label more than the suffix; the host itself if it has no more."""
    return F.when(host == suffix, host).otherwise(
        F.concat(F.substring_index(F.expr("left(__host, length(__host) - length(__suffix) - 1)"), ".", -1), F.lit("."), suffix)
    )


def with_host_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """`pages` with __host, __path, __suffix and __domain."""
    df = pages.withColumns({"__host": url_host(F.col(url)), "__path": url_path(F.col(url))})
    df = df.withColumn("__suffix", suffix_of(F.col("__host")))
    return df.withColumn("__domain", domain_of(F.col("__host"), F.col("__suffix")))


def matching_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null if none does; of equal ones, the first by text."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _strength(children: DataFrame, least: float, most: float) -> float:
    """Prior weight by moments: how little children's shares spread around their parent's, beyond chance."""
    row = children.where("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("k"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mean"), 2)).alias("spread"),
        F.sum(F.col("n") * F.col("mean") * (1 - F.col("mean"))).alias("noise"),
    ).first()
    if not row.n or row.k < 2 or not row.noise:
        return most
    unit, k = row.noise / row.n, row.k
    room = unit * (row.n - row.nn / row.n - (k - 1))
    share = (row.spread - unit * (k - 1)) / room if room > 0 else 0.0
    return min(most, max(least, 1 / share - 1)) if share > 0 else most


@dataclass(frozen=True)
class Reputation:
    """Fitted levels: hosts with their posterior, and what stands in for a host without labelled pages."""

    hosts: DataFrame  # __host, labelled, good, mean, upper
    domains: DataFrame  # __suffix, __domain, mean of the posterior
    suffixes: DataFrame  # __suffix, mean of the posterior
    total: float  # mean over all pages
    weight: float  # of a host's prior, in pages
    z: float

    def unlabelled_upper(self, mean: Column) -> Column:
        """Upper bound of a host of which only the prior around `mean` is known."""
        return _upper(self.weight * mean, self.weight * (1 - mean), self.z)


def _upper(a: Column, b: Column, z: float) -> Column:
    return a / (a + b) + z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))


def fit_reputation(outcomes: DataFrame, z: float = 1.645, least: float = 2.0, most: float = 200.0) -> Reputation:
    """Posteriors of the share of good pages at each level of `outcomes` (__host, __domain, __suffix, good 0/1).

    Beta-binomial levels: all pages, suffix, registered domain, host. A level's prior has its parent's
    posterior mean and a weight fitted by moments over that level (between `least` and `most` pages).
    Outcomes that are null count for nothing. Counts are combined on the map side, so a host with a third
    of all pages is one row per task.
    """
    keys = ["__suffix", "__domain", "__host"]
    hosts = written(
        outcomes.where("good IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good")),
        "hosts",
    )
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    mean, means, on = (total.good + 1) / (total.n + 2), [], []
    for depth in (1, 2, 3):
        level = hosts.groupBy(*keys[:depth]).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        level = level.join(means[-1], on) if means else level.withColumn("mean", F.lit(mean))
        weight = _strength(level, least, most)
        a, b = F.col("good") + weight * F.col("mean"), F.col("n") - F.col("good") + weight * (1 - F.col("mean"))
        level = level.select(*keys[:depth], "n", "good", a.alias("a"), b.alias("b")).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        if depth < 3:
            means.append(written(level.select(*keys[:depth], "mean"), "reputation"))
            on = keys[:depth]
    level = level.select("__host", F.col("n").alias("labelled"), "good", "mean", _upper(F.col("a"), F.col("b"), z).alias("upper"))
    return Reputation(written(level, "reputation"), means[1], means[0], mean, weight, z)


def host_reputation(outcomes: DataFrame, z: float = 1.645, least: float = 2.0, most: float = 200.0) -> DataFrame:
    """One row per host of `outcomes`: __host, labelled, good, mean and upper = mean + z deviations of the host's Beta posterior."""
    return fit_reputation(outcomes, z, least, most).hosts


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], *, url: str = "url", threshold: float = 0.5, z: float = 1.645
) -> DataFrame:
    """`pages` with host, path, rule, verdict, host_labelled and host_good.

    The longest fitting rule decides. Otherwise a host is blocked if even the upper bound of its share of
    good pages is below `threshold`. A host without labelled pages has the prior that hosts have around its
    registered domain's share, else its suffix's, else that of all pages, and is judged by that prior's upper bound. `outcomes` has a url column
    of the same name and good (0/1 or null). Columns of `pages` with the names added here are replaced.
    Null urls have an empty host and path. The join of pages with hosts carries no hint: Spark broadcasts the
    hosts, domains and suffixes by their measured size and splits a hot host otherwise.
    """
    judged = with_host_parts(outcomes.select(url, "good"), url)
    fitted = fit_reputation(judged.select("__host", "__domain", "__suffix", "good"), z)
    reputation = fitted.hosts.select("__host", F.col("labelled").alias("host_labelled"), F.col("good").alias("host_good"), F.col("upper").alias("__upper"))
    added = ("host", "path", "rule", "verdict", "host_labelled", "host_good")
    df = with_host_parts(pages.drop(*(c for c in added if c != url)), url).join(reputation, "__host", "left")
    df = df.join(fitted.domains.withColumnRenamed("mean", "__of_domain"), ["__suffix", "__domain"], "left")
    df = df.join(fitted.suffixes.withColumnRenamed("mean", "__of_suffix"), "__suffix", "left")
    prior = fitted.unlabelled_upper(F.coalesce("__of_domain", "__of_suffix", F.lit(fitted.total)))
    df = df.withColumn("__upper", F.coalesce("__upper", prior))
    text, verdict = matching_rule(rules, F.col("__host"), F.col("__path"))
    learned = F.when(F.col("__upper") < threshold, "block").otherwise("allow")
    return df.withColumns(
        {
            "host": F.col("__host"), "path": F.col("__path"), "rule": text, "verdict": F.coalesce(verdict, learned),
            "host_labelled": F.coalesce("host_labelled", F.lit(0).cast("long")), "host_good": F.coalesce("host_good", F.lit(0).cast("long")),
        }
    ).drop("__host", "__path", "__suffix", "__domain", "__of_domain", "__of_suffix", "__upper")
