"""URL filter: rules where they fit, else trust and distrust that spread over host links.

Hosts that the rules mostly allow are trusted seeds, hosts that they mostly block are blocked
seeds. Personalised PageRank carries trust from the trusted seeds along links, and distrust from
the blocked seeds against them (who links to a blocked host is suspect). Both run as joins and
grouped sums over one row per host, in the same rounds. Edges are the absolute links of the
pages, counted, and a light edge both ways between a host and the domain above it, so that
the parts of one site stand together even where pages link to their own host only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HUB, dealt_apart, dealt_by_count, dropped, materialize

#: Share of a score that a host passes on each round; rounds end when the scores (a sum of 1 each) change by less than this in all.
DAMPING = 0.85
TOLERANCE = 0.01
#: A host is blocked where its distrust is above its trust by more than this many times the mean distrust of a host.
MARGIN = 1.5
#: Characters of the longest host name that there can be: what is longer has no domain above it.
LONGEST_NAME = 253
#: Weight of the edges between a host and the domain above it; a link has weight 1.
SITE_WEIGHT = 0.1

#: Absolute and protocol-relative links.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _located(expression: str, url: str) -> Column:
    return F.expr(expression.format(url=f"`{url}`"))


def parsed(pages: DataFrame, id_col: str, url_col: str, keep: list[str]) -> DataFrame:
    """page_id, host and path of every page."""
    after = "substr({url}, locate('://', {url}) + 3)"
    whole = f"regexp_extract({after}, '^[^?#]*', 0)"
    has = _located("locate('://', {url}) > 0", url_col)
    host = F.when(has, ascii_lower(_located(f"regexp_extract({after}, '^[^/?#]*', 0)", url_col)))
    path = F.when(has, _located(f"regexp_extract({whole}, '^[^/]*((?s).*)$', 1)", url_col))
    return pages.select(F.col(id_col).alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), *keep)


def suffixes(host: Column, most: int | None = None) -> Column:
    """The host and all domains above it; most: only those of so many labels or fewer."""
    labels = F.split(host, r"\.")
    first = F.lit(1) if most is None else F.greatest(F.lit(1), F.size(labels) - (most - 1))
    return F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def fitting_rules(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host and rules (array of rule, path, verdict; longest first) for every distinct host that some rule names."""
    spark = hosts.sparkSession
    table = spark.createDataFrame([(rule, rule.split("/", 1)[0], "/" + rule.split("/", 1)[1], verdict) for rule, verdict in rules], "rule string, domain string, start string, verdict string")
    most = max((rule.split("/", 1)[0].count(".") + 1 for rule, _ in rules), default=1)
    named = hosts.select("host", F.explode(suffixes(F.col("host"), most)).alias("domain")).join(table, "domain")
    longest = F.array_sort(F.collect_list(F.struct((-F.length("rule")).alias("by"), "rule", "start", "verdict")))
    return named.groupBy("host").agg(longest.alias("rules"))


def propagate(hosts: DataFrame, edges: DataFrame, rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust and distrust from seeds of both kinds, after so many rounds or when a round changes less than the tolerance.

    hosts: host, trusted, blocked (seed weights, each kind summing to 1 or 0); edges: src, dst, weight, over these hosts.
    Trust flows from src to dst, distrust from dst to src, in shares of the weight. Mass of hosts without an edge onward is
    lost; scores that are scaled to a sum of 1 are those that sending it back to the seeds would give.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("whole"), F.count("*").alias("n"))
    back = edges.groupBy("dst").agg(F.sum("weight").alias("whole"), F.count("*").alias("n"))
    forward = dealt_by_count(edges, out, "src", ["dst"]).select(F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("weight") / F.col("whole")).alias("t"), F.lit(0.0).alias("d"))
    against = dealt_by_count(edges, back, "dst", ["src"]).select(F.col("dst").alias("from"), F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("whole")).alias("d"))
    shares = forward.unionByName(against).groupBy("from", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    hubs = materialize(shares.groupBy("from").agg(F.count("*").alias("n")).where(F.col("n") > HUB).select(F.col("from").alias("host"), F.ceil(F.col("n") / HUB).cast("int").alias("parts")), "hubs")
    crowded = not hubs.isEmpty()
    if crowded:
        part = F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1)).cast("long")).cast("int")
        # a hub has HUB edges, so there are few of them; Spark broadcasts them where they are small enough for it
        shares = shares.join(hubs.withColumnRenamed("host", "from"), "from", "left").withColumn("part", part).drop("parts")
    shares = materialize(shares, "host-edges")
    scores, stored, done = hosts.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust")), None, 0
    while rounds is None or done < rounds:
        giving = scores.where("trust > 0 or distrust > 0").withColumnRenamed("host", "from")
        if crowded:
            copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
            giving = giving.join(hubs.withColumnRenamed("host", "from"), "from", "left").select("from", "trust", "distrust", copies)
        sent = shares.join(giving, ["from", "part"] if crowded else ["from"])
        got = sent.groupBy(F.col("to").alias("host")).agg(F.sum(F.col("trust") * F.col("t")).alias("t"), F.sum(F.col("distrust") * F.col("d")).alias("d"))
        was = scores.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
        now = hosts.join(was, "host").join(got, "host", "left").select(
            "host",
            ((1 - damping) * F.col("trusted") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping) * F.col("blocked") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
            "t0",
            "d0",
        )
        # one row a host is stored each round, so that no plan grows with the rounds
        now = materialize(now, "host-scores")
        moved = now.agg(F.sum(F.abs(F.col("trust") - F.col("t0")) + F.abs(F.col("distrust") - F.col("d0")))).first()[0] or 0.0
        if stored is not None:
            dropped(stored)
        scores, stored, done = now.select("host", "trust", "distrust"), now, done + 1
        if rounds is None and moved < tolerance:
            break
    return scores


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rounds: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page.

    rules: (rule, verdict) such as ("example.com/en/", "block"). A rule fits its host and all hosts below it where
    the path starts with the rule's; the longest wins and gives the verdict. Other pages get their host's: block
    where distrust is above trust by more than MARGIN times the mean, else allow (as hosts get that no seed reaches, and urls
    without a host). trust and distrust are scaled to a sum of 1 over all hosts. Of rules of one length the least in order wins.
    A null url has neither host nor path; a null html has no links. Repeated rows each get a row.
    """
    links = F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))
    rows = parsed(pages, id_col, url_col, [F.array_distinct(links).alias("links")])
    rows = materialize(rows, "pages")
    rules_of = fitting_rules(rows.where("host <> ''").select("host").distinct(), rules)
    judged = dealt_apart(rows, rules_of, "host", ["page_id", "path"])
    fit = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["start"])), F.lit(0))
    judged = judged.withColumn("fit", fit).select("page_id", "host", "path", "links", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule"))

    counted = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("by_rule") == "allow").alias("allowed"), F.count_if(F.col("by_rule") == "block").alias("denied")
    )
    linked = judged.where("host <> ''").select(F.col("host").alias("src"), F.explode("links").alias("dst")).select("src", ascii_lower(F.col("dst")).alias("dst"))
    linked = linked.where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    known = counted.select("host").unionByName(linked.select(F.col("dst").alias("host"))).distinct()
    above = known.where(F.length("host") <= LONGEST_NAME).select(F.explode(suffixes(F.col("host"))).alias("host"))
    sites = above.where("host like '%.%'").distinct()
    climb = sites.select("host", F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("up")).where("up like '%.%'")
    site_edges = climb.select(F.col("host").alias("src"), F.col("up").alias("dst")).unionByName(climb.select(F.col("up").alias("src"), F.col("host").alias("dst")))
    edges = linked.unionByName(site_edges.withColumn("weight", F.lit(SITE_WEIGHT)))

    everyone = sites.unionByName(known).distinct().join(counted, "host", "left")
    seeds = everyone.select("host", (F.col("allowed") * 2 > F.col("n")).cast("int").alias("trusted"), (F.col("denied") * 2 > F.col("n")).cast("int").alias("blocked")).na.fill(0)
    seeds = materialize(seeds, "hosts")
    totals = seeds.agg(F.sum("trusted"), F.sum("blocked")).first()
    share = lambda name, total: (F.col(name) / F.lit(float(total or 1))).alias(name)
    hosts = seeds.select("host", share("trusted", totals[0]), share("blocked", totals[1]))
    scores = materialize(propagate(hosts, edges, rounds), "host-scores")
    sums = scores.agg(F.sum("trust"), F.sum("distrust"), F.count("*")).first()
    whole = lambda name, total: (F.col(name) / F.lit(total or 1.0)).alias(name)
    scores = scores.select("host", whole("trust", sums[0]), whole("distrust", sums[1]))
    mean = 1.0 / max(sums[2], 1) if sums[1] else 0.0
    distrusted = F.col("distrust") - F.col("trust") > MARGIN * mean
    verdict = F.coalesce(F.col("by_rule"), F.when(distrusted, F.lit("block")).otherwise(F.lit("allow")))
    judged = dealt_apart(judged.drop("links"), scores, "host", ["page_id", "path"])
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
