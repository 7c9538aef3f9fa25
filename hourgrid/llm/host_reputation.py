"""URL filter: explicit rules, else an empirical-Bayes reputation of the host from labelled pages.

Page outcomes are bad or not. Counts are summed per host, registered domain and suffix. Each level's share of bad pages
is shrunk towards that of the rest of its parent by a beta-binomial prior whose strength is estimated, level by level, from
how much the groups differ beyond chance; a group's own pages never count in its prior. A host is blocked if even the lower
posterior bound of its share, a quantile of its beta distribution, is above the limit; without a limit, above the share of
all labelled pages, so that it is surely worse than the average.

Only DataFrame functions are used; every sum is partial before its shuffle, and the quantile is one expression per host.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import stage

#: (action, rule): host and path prefix.
Rules = list[tuple[str, str]]
LEVELS = ("suffix", "domain", "host")
#: Common public suffixes of several labels. A fuller table can be given as a parameter.
SUFFIXES = (
    "ac.at", "co.at", "or.at", "com.ar", "org.ar", "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au", "com.br", "edu.br",
    "gov.br", "net.br", "org.br", "ac.cn", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.co", "com.eg", "com.es", "com.hk",
    "org.hk", "ac.id", "co.id", "go.id", "or.id", "ac.il", "co.il", "org.il", "ac.in", "co.in", "gov.in", "net.in", "org.in", "ac.jp",
    "co.jp", "go.jp", "ne.jp", "or.jp", "co.ke", "ac.kr", "co.kr", "go.kr", "or.kr", "com.mx", "gob.mx", "org.mx", "com.my", "com.ng",
    "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz", "com.pe", "com.ph", "com.pk", "com.pl", "edu.pl", "org.pl", "com.pt", "com.sa",
    "com.sg", "edu.sg", "ac.th", "co.th", "com.tr", "edu.tr", "org.tr", "com.tw", "org.tw", "com.ua", "ac.uk", "co.uk", "gov.uk",
    "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk", "com.ve", "com.vn", "ac.za", "co.za", "gov.za", "org.za",
)
#: Cells of the grid on which a beta distribution is summed, and its half width in deviations.
CELLS, REACH = 256, 8
STRENGTH_RANGE = (1.0, 1000.0)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest known suffix of several labels, else the last label; of an address, nothing."""
    name = _name(host)
    found = F.substring_index(name, ".", -1)
    for labels in sorted({x.count(".") + 1 for x in suffixes}):
        last = F.substring_index(name, ".", -labels)
        found = F.when(last.isin(*(x for x in suffixes if x.count(".") + 1 == labels)), last).otherwise(found)
    return F.when(_address(name), F.lit("")).otherwise(found)


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The label before the suffix and the suffix; an address stands for itself."""
    name, suffix = _name(host), suffix_of(host, suffixes)
    labels = F.size(F.split(suffix, r"\.")) + 1
    parts = F.split(name, r"\.")
    last = F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels, F.lit(0)) + 1, labels), ".")
    return F.when(_address(name), name).otherwise(last)


def _name(host: Column) -> Column:
    """Without user, port and final dot."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$|\.$", "")


def _address(name: Column) -> Column:
    return name.rlike(r"^[0-9.]+$|^\[")


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits, else nulls. A rule fits its host and all hosts below it."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(action)
    return rule, action


def _strength(groups: DataFrame, total: Column) -> DataFrame:
    """Prior strength of a level from (bad, n, prior): how the groups' shares scatter around their prior means."""
    middle, spread = F.col("prior"), F.col("prior") * (1 - F.col("prior"))
    share = F.col("bad") / F.col("n")
    sums = groups.agg(
        F.sum(F.col("n") * (share - middle) ** 2).alias("scatter"),
        F.sum(spread).alias("chance"),
        F.sum(F.col("n") * spread).alias("weight"),
        F.sum(spread).alias("single"),
    )
    # E[n (share - prior)^2] = spread * (1 + (n - 1) * rho), where rho = 1 / (strength + 1).
    rho = (F.col("scatter") - F.col("chance")) / (F.col("weight") - F.col("single"))
    low, high = STRENGTH_RANGE
    strength = F.when(F.col("weight") > F.col("single"), F.when(rho <= 0, F.lit(high)).otherwise(1 / rho - 1))
    return sums.select(F.least(F.greatest(F.coalesce(strength, total), F.lit(low)), F.lit(high)).alias("strength"))


def beta_quantile(rows: DataFrame, a: str, b: str, tail: float, name: str) -> DataFrame:
    """`rows` with the `tail` quantile of beta(a, b) as `name`.

    The distribution is summed over the angle asin(sqrt(x)), where its width depends on a + b alone: `CELLS` cells over
    `REACH` deviations to both sides of the mean, as far as they are there.
    """
    size = F.col(a) + F.col(b)
    middle, reach = F.asin(F.sqrt(F.col(a) / size)), F.lit(REACH / 2) / F.sqrt(size + 1)
    low = F.greatest(middle - reach, F.lit(0.0))
    grid = rows.withColumns({"low_": low, "step_": (F.least(middle + reach, F.lit(math.pi / 2)) - low) / CELLS})

    def logarithm(k: Column) -> Column:
        angle = F.col("low_") + (k + 0.5) * F.col("step_")
        return (2 * F.col(a) - 1) * F.log(F.sin(angle)) + (2 * F.col(b) - 1) * F.log(F.cos(angle))

    grid = grid.withColumn("logs_", F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), logarithm))
    grid = grid.withColumn("peak_", F.array_max("logs_"))
    grid = grid.withColumn("cells_", F.transform("logs_", lambda x: F.exp(x - F.col("peak_"))))
    grid = grid.withColumn("goal_", tail * F.aggregate("cells_", F.lit(0.0), lambda s, x: s + x))

    def step(s: Column, x: Column) -> Column:
        run = s["run"] + x
        place = F.when(s["place"] >= 0, s["place"]).when(run >= F.col("goal_"), s["at"] + (F.col("goal_") - s["run"]) / x)
        return F.struct(run.alias("run"), (s["at"] + 1).alias("at"), place.otherwise(-1.0).alias("place"))

    start = F.struct(F.lit(0.0).alias("run"), F.lit(0.0).alias("at"), F.lit(-1.0).alias("place"))
    place = F.aggregate("cells_", start, step, lambda s: s["place"])
    return grid.withColumn(name, F.pow(F.sin(F.col("low_") + place * F.col("step_")), 2)).select(*rows.columns, name)


def reputation(hosts: DataFrame, outcomes: DataFrame, tail: float = 0.05, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, domain, suffix, n, bad, mean, low): posterior share of bad pages of each host and its `tail` quantile.

    `hosts` lists host; `outcomes` has host and bad (0 or 1), one row per labelled page. Hosts without labelled pages have
    n = 0 and the prior of their domain. Null outcomes are not counted. Without any outcome the share is one half.
    """
    host = F.col("host")
    named = hosts.select("host").distinct().select(
        "host", domain_of(host, suffixes).alias("domain"), suffix_of(host, suffixes).alias("suffix")
    )
    seen = outcomes.where("bad is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    counted = stage(named.join(seen, "host", "left").fillna(0, ["n", "bad"]), "hosts")

    # The share of all pages has a weak prior of one half.
    whole = {f"{c}_above": counted.agg(F.sum(c)).scalar() for c in ("n", "bad")}
    whole |= {"prior_above": F.lit(0.5), "strength_above": F.lit(1.0)}
    parent, keys = None, []
    for level in LEVELS:
        above, keys = keys, [*keys, level]
        groups = counted.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = groups.join(parent, above) if above else groups.withColumns(whole)
        rest_bad = F.col("bad_above") - F.col("bad") + F.col("strength_above") * F.col("prior_above")
        prior = rest_bad / (F.col("n_above") - F.col("n") + F.col("strength_above"))
        groups = stage(groups.select(*keys, "n", "bad", prior.alias("prior")), level)
        strength = _strength(groups.where("n > 0"), F.lit(STRENGTH_RANGE[1]))
        known = groups.withColumn("strength", strength.scalar())
        parent = known.withColumnsRenamed({c: f"{c}_above" for c in ("n", "bad", "prior", "strength")})
    a = F.col("bad") + F.col("strength") * F.col("prior")
    shrunk = known.select(*keys, "n", "bad", a.alias("a"), (F.col("n") + F.col("strength") - a).alias("b"))
    shrunk = beta_quantile(shrunk, "a", "b", tail, "low")
    return shrunk.select(*keys, "n", "bad", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"), "low")


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Rules,
    limit: float | None = 0.5,
    tail: float = 0.05,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, share, low; one row per page.

    `outcomes` has page_id and bad. Null urls and urls without :// have empty host and path; the empty host has a reputation
    of its own like any other. Pages without an outcome do not count. Repeated rows count each; an outcome that names
    no page is ignored, as are other columns. An empty table gives no rows. Without a limit and without outcomes all hosts
    pass.
    """
    url = F.col("url")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labelled = placed.join(outcomes.select("page_id", "bad"), "page_id").select("host", "bad")
    known = stage(reputation(placed, labelled, tail, suffixes), "reputation")
    most = F.lit(limit) if limit is not None else known.agg(F.try_divide(F.sum("bad"), F.sum("n"))).scalar()
    known = known.select("host", F.col("mean").alias("share"), "low", (F.col("low") > most).alias("is_bad"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("is_bad"), "block").otherwise("allow")
    judged = placed.join(known, "host").withColumn("rule", rule)
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce(action, own).alias("verdict"), "share", "low"
    )
