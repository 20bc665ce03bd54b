"""URL filters: rules for hosts and paths, and trust that spreads over the links between hosts.

Where no rule fits a page, its host decides.  Hosts with pages that rules allow are trusted seeds, hosts with pages that rules block are
blocked ones, each by the number of such pages.  Personalised PageRank carries trust from the trusted seeds along the links between hosts, and
distrust from the blocked seeds against them (who links to blocked hosts is distrusted).  A host that has more distrust than `tolerance`
times its trust is blocked.

Ranks are whole numbers of a fixed unit, and every share is rounded down, so sums do not depend on their order and a rerun gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Ranks of all hosts together stay below this, where whole numbers of doubles are exact; a page has UNIT at most.
WHOLE, UNIT = 1 << 50, 1 << 20
#: Verdicts of this many hosts at most are broadcast.
HOSTS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts of the links of a page: href of a and area elements that name a host.
LINK = r"""<(?:[Aa]|[Aa][Rr][Ee][Aa])[ \t\n\r\f](?:[^<>]*[ \t\n\r\f])?[Hh][Rr][Ee][Ff][ \t\n\r\f]*=[ \t\n\r\f]*["']?[ \t\n\r\f]*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'> \t\n\r\f]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):  # the last that fits wins; of equal ones, block
        name, slash, rest = rule.partition("/")
        name = name.translate(str.maketrans(_UPPER, _LOWER))
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_ranks(seeds: DataFrame, links: DataFrame, *, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """(host, trust, distrust) of all hosts that either reaches.

    `seeds` is (host, allowed, blocked), numbers of pages; `links` is (src, dst, weight). A round gives each host (1 - damping) of its own
    seed and damping of what its neighbours hand on: trust goes from src to dst, distrust from dst to src, dealt by weight. It starts with the seeds and
    ends after `rounds`, or before where nothing changes any more. A host without links hands nothing on.
    """
    total = seeds.agg(F.sum(F.col("allowed") + F.col("blocked"))).first()[0] or 0
    unit = max(1, min(UNIT, WHOLE // max(int(total), 1)))
    own = written(seeds.where("allowed + blocked > 0").select("host", (F.col("allowed") * float(unit)).alias("trust"), (F.col("blocked") * float(unit)).alias("distrust")))
    both = links.select(F.col("src").alias("host"), F.col("dst").alias("to"), F.col("weight").alias("t"), F.lit(0).cast("long").alias("d"))
    both = both.union(links.select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0).cast("long").alias("t"), F.col("weight").alias("d")))
    both = both.groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    out = both.groupBy("host").agg(F.sum("t").alias("all_t"), F.sum("d").alias("all_d"))
    share = lambda part, whole: F.when(F.col(whole) > 0, F.lit(damping) * F.col(part) / F.col(whole)).otherwise(0.0)
    flows = written(both.join(out, "host").select("host", "to", share("t", "all_t").alias("t"), share("d", "all_d").alias("d")))
    kept = own.select("host", F.floor(F.col("trust") * (1 - damping)).cast("double").alias("trust"), F.floor(F.col("distrust") * (1 - damping)).cast("double").alias("distrust"))
    now, before = own, None
    for _ in range(rounds):
        handed = now.join(flows, "host").select(F.col("to").alias("host"), F.floor(F.col("trust") * F.col("t")).cast("double").alias("trust"), F.floor(F.col("distrust") * F.col("d")).cast("double").alias("distrust"))
        now = written(kept.union(handed).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).where("trust + distrust > 0"))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("host", "trust", "distrust").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select("host", F.col("trust").cast("long").alias("trust"), F.col("distrust").cast("long").alias("distrust"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", damping: float = 0.85, rounds: int = 20, tolerance: float = 1.0) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) for every page.

    `rules` are pairs such as ("block", "example.org/es/"): of all that fit a page the longest decides. A page that none fits is blocked where its host's
    distrust is over `tolerance` times its trust; a host that neither reaches is allowed. The rules are tried one by one, so keep them to some hundreds.

    Defined cases: a null url and one without :// have an empty host and path, which no rule fits, and links of such pages count for nothing; a null
    html has no links; links within a host are left out, and a page counts once for each host that it links to; repeated rows are pages each; ids may be of any type
    and null; an empty table gives an empty table; other columns are not read.
    """
    if not 0 < damping < 1 or any(v not in ("allow", "block") for v, _ in rules):
        raise ValueError("damping must be between 0 and 1, verdicts allow or block")
    host, path = F.col("host"), F.col("path")
    read = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    linked = F.transform(F.coalesce(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), F.array().cast("array<string>")), lambda h: F.translate(h, _UPPER, _LOWER))
    judged = written(read.select("id", "host", "path", _rule(host, path, rules).alias("by"), F.array_remove(F.array_distinct(linked), host).alias("linked")))
    seeds = judged.where("host <> ''").groupBy("host").agg(F.count(F.when(F.col("by.verdict") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("by.verdict") == "block", 1)).alias("blocked"))
    links = judged.where("host <> ''").select(F.col("host").alias("src"), F.explode("linked").alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    ranks = host_ranks(seeds, links, damping=damping, rounds=rounds)
    if ranks.count() <= HOSTS:
        ranks = F.broadcast(ranks)
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    verdict = F.coalesce(F.col("by.verdict"), F.when(distrust > F.lit(float(tolerance)) * trust, "block").otherwise("allow"))
    return judged.join(ranks, "host", "left").select(F.col("id").alias(id_col), "host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"), trust.cast("long").alias("trust"), distrust.cast("long").alias("distrust"))
