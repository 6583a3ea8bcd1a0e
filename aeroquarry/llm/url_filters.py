"""Operator 2: URL rules first, then empirical-Bayes host reputation.

Labelled page outcomes are counted for each host, registered domain and public
suffix. Rates are shrunk from the top down through beta-binomial priors: the
suffix towards all pages, the domain towards its suffix, the host towards its
domain. Each host so has a beta posterior of its bad rate; it is blocked where
that rate lies above the limit with probability ``certainty``, that is, where
the posterior's lower bound does. The limit is ``lift`` times the rate of all
labelled pages (``MOST_LIMIT`` at most), as what is usual differs between
corpora. The posterior's probability is the incomplete beta function, as a
continued fraction. Only DataFrame functions run.

Defined results: a url that is null or has no ``://`` has an empty host and
path, matches no rule and is allowed; a host without labelled pages has its
domain's posterior mean (without one its suffix's, then that of all pages) with
the prior's width; without labelled pages every host is allowed; of rules of
equal length the last in order of host, path and verdict wins; urls of any
length are read whole; rows with null ids and repeated rows are judged one by
one; further columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch

#: Public suffixes of two labels, of the most common ones; the whole list can be handed over as a table.
TWO_PART = ("co.uk", "org.uk", "com.au", "co.jp", "co.nz", "com.br", "co.za", "co.in", "com.mx", "com.cn")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules are compiled into one expression; more are joined as a table, with the same results.
MAX_RULES = 1000
MOST_LIMIT = 0.95
#: Terms of the continued fraction, and the weight beyond which a posterior counts as normal: there both agree.
TERMS, NORMAL_FROM = 200, 20_000.0


def url_host(url: Column) -> Column:
    rest = F.expr("substring(__u, locate('://', __u) + 3)")
    return _on(url, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER))


def url_path(url: Column) -> Column:
    rest = F.expr("substring(__u, locate('://', __u) + 3)")
    return _on(url, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def _on(url: Column, value: Column) -> Column:
    return F.when(F.coalesce(F.locate("://", F.col("__u")), F.lit(0)) > 0, value).otherwise(F.lit(""))


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    plain = pages.withColumn("__u", F.col(url))
    return plain.withColumns({"host": url_host(F.col("__u")), "path": url_path(F.col("__u"))}).drop("__u")


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (host, path prefix, verdict) that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest ends up outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def with_rule(parts: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Adds ``rule`` and ``verdict``. Long lists and tables (host, prefix, verdict) meet the hosts by equality of a host's endings."""
    if not isinstance(rules, DataFrame):
        if len(rules) <= MAX_RULES:
            rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
            return parts.withColumns({"rule": rule, "verdict": verdict})
        rules = parts.sparkSession.createDataFrame(list(rules), "host string, prefix string, verdict string")
    labels = F.split("host", "[.]")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = parts.where("host <> ''").select("host").distinct().select("host", F.explode(ends).alias("end"))
    listed = rules.select(F.col("host").alias("end"), F.struct(F.length(F.concat("host", "prefix")).alias("n"), F.col("host").alias("h"), F.col("prefix").alias("p"), F.col("verdict").alias("v")).alias("r"))
    own = Scratch(parts.sparkSession, "url-rules").save(each.join(listed, "end").groupBy(F.col("host").alias("__h")).agg(F.collect_list("r").alias("__rules")), "rules")
    fits = F.array_max(F.filter("__rules", lambda r: F.col("path").startswith(r["p"])))
    found = parts.join(own, F.col("host") == F.col("__h"), "left").withColumn("__r", fits)
    return found.withColumns({"rule": F.concat("__r.h", "__r.p"), "verdict": F.col("__r.v")}).drop("__h", "__rules", "__r")


def _log_gamma(z: Column) -> Column:
    """Stirling's series after seven steps of the recurrence."""
    y = z + 7
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5))
    return series - reduce(lambda a, b: a + b, [F.log(z + i) for i in range(7)])


def probability_below(a: Column, b: Column, x: Column) -> Column:
    """Of a beta distribution with parameters a and b, the probability below x in (0, 1)."""
    flip = x > (a + 1) / (a + b + 2)  # the fraction converges fast on one side of the middle
    p, q, y = F.when(flip, b).otherwise(a), F.when(flip, a).otherwise(b), F.when(flip, 1 - x).otherwise(x)
    tiny = 1e-300
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def term(s, k):
        """One step of Lentz's evaluation: odd and even terms of the fraction alternate."""
        m = F.floor(k / 2)
        odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
        t = F.when(k % 2 == 1, odd).otherwise(even)
        d = 1 / safe(1 + t * s["d"])
        c = safe(1 + t / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(1.0).alias("h"))
    h = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, term, lambda s: 1 / s["h"])
    front = F.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * F.log(y) + q * F.log(1 - y)) / p
    side = front * h
    exact = F.when(flip, 1 - side).otherwise(side)
    mean = a / (a + b)
    z = (x - mean) / F.sqrt(mean * (1 - mean) / (a + b + 1))
    normal = 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))
    return F.when(a + b > NORMAL_FROM, normal).otherwise(exact)


def reputation(outcomes: DataFrame, default_strength: float = 20.0, lift: float = 2.0, two_part_suffixes: Sequence[str] | DataFrame = TWO_PART, others: DataFrame | None = None) -> DataFrame:
    """From (host, bad) rows: host, n, bad, posterior mean ``rate`` and ``above``, the probability that it lies above the limit.

    ``others`` are hosts to judge even without rows. ``two_part_suffixes``: public suffixes of two labels, as a short
    list or, for the whole public list, as a table with a column ``suffix``.
    """
    scratch = Scratch(outcomes.sparkSession, "reputation")
    last = lambda m: F.substring_index("host", ".", -m)

    def levelled(hosts: DataFrame) -> DataFrame:
        if isinstance(two_part_suffixes, DataFrame):
            known = two_part_suffixes.select(F.col("suffix").alias("__two")).distinct()
            hosts, longer = hosts.join(known, last(2) == F.col("__two"), "left"), F.col("__two").isNotNull()
        else:
            longer = last(2).isin(*two_part_suffixes) if two_part_suffixes else F.lit(False)
        return hosts.withColumns({"suffix": F.when(longer, last(2)).otherwise(last(1)), "domain": F.when(longer, last(3)).otherwise(last(2))}).drop("__two")

    hosts = outcomes.where(F.col("host") != "").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    hosts = scratch.save(levelled(hosts), "hosts")
    domains = scratch.save(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk")), "domains")
    suffixes = scratch.save(domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk")), "suffixes")
    top = suffixes.agg(F.sum("sk"), F.sum("sn")).first()
    mean = top[0] / top[1] if top[1] else 0.0

    def strength(level: DataFrame, k: str, n: str) -> float:
        rate = F.col(k) / F.col(n)
        r = level.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v"), F.avg(1 / F.col(n)).alias("inv")).first()
        if r["m"] is None:
            return default_strength
        between = (r["v"] or 0.0) - r["m"] * (1 - r["m"]) * r["inv"]
        return min(max(r["m"] * (1 - r["m"]) / between - 1, 2.0), 1e4) if between > 0 else 1e4

    s, d, h = strength(suffixes, "sk", "sn"), strength(domains, "dk", "dn"), strength(hosts, "k", "n")
    if others is not None:
        fresh = others.where(F.col("host") != "").select("host").distinct().join(hosts, "host", "left_anti")
        hosts = hosts.unionByName(levelled(fresh.withColumns({"n": F.lit(0).cast("long"), "k": F.lit(0).cast("long")})))
    suffixes = suffixes.select("suffix", ((F.col("sk") + s * mean) / (F.col("sn") + s)).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", ((F.col("dk") + d * F.col("suffix_rate")) / (F.col("dn") + d)).alias("domain_rate"))
    prior = F.coalesce("domain_rate", "suffix_rate", F.lit(mean))  # of the lowest level with labelled pages
    # Prior rates are kept off 0 and 1, where a beta distribution has no density.
    prior = F.greatest(F.least(prior, F.lit(1 - 1e-6)), F.lit(1e-6))
    rows = hosts.join(domains, ["suffix", "domain"], "left").join(suffixes, "suffix", "left").select("host", "n", F.col("k").alias("bad"), prior.alias("prior"))
    rows = rows.withColumns({"a": F.col("bad") + h * F.col("prior"), "b": F.col("n") - F.col("bad") + h * (1 - F.col("prior"))})
    limit = min(lift * mean, MOST_LIMIT)
    above = 1 - probability_below(F.col("a"), F.col("b"), F.lit(limit)) if 0 < limit else F.lit(0.0)
    return rows.select("host", "n", "bad", (F.col("a") / (F.col("a") + F.col("b"))).alias("rate"), above.alias("above"))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, certainty: float = 0.95, **options) -> DataFrame:
    """Pages (page_id, url) with host, path, rule and verdict. ``outcomes``: (host, bad) of labelled pages; options as in ``reputation``."""
    parts = with_parts(pages.select("page_id", "url")).drop("url")
    judged = Scratch(pages.sparkSession, "url-filter").save(reputation(outcomes, others=parts, **options), "hosts")
    blocked = judged.where(F.col("above") >= certainty).select(F.col("host").alias("__blocked"))
    joined = with_rule(parts, rules).join(blocked, F.col("host") == F.col("__blocked"), "left")
    own = F.when(F.col("__blocked").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"))


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of pages whose path ends in the number of a labelled document; bad: low quality or toxic.

    Pages with several labels count once for each; labels without any value are no outcome.
    """
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]{1,18})([.]html)?/?$', 1) AS bigint)")
    numbered = with_parts(pages.select("page_id", "url")).select("host", number.alias("__doc")).where("__doc IS NOT NULL")
    bad = reduce(lambda a, b: a | b, [F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))])
    known = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").select(F.col("doc_id").alias("__doc"), bad.alias("bad"))
    return numbered.join(known, "__doc").select("host", "bad")
