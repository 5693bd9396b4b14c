"""URL filters by association rules (operator 3).

Labelled urls become sets of tokens (labels of the host, segments of the path, names of the query); a page is bad
if it is toxic or of quality 0. Rules `tokens -> bad` over all labelled rows are kept if they reach the support
and no shorter rule within them already holds. The same support, a share of the labelled rows, is asked at every size;
what guards against chance is the confidence: its lower bound (Wilson's, `Z` standard deviations) must reach
`MIN_CONFIDENCE`, so few rows need a clearer case than many.

All tokens of a url take part. The sets grow level by level, one token at a time, by joins over distinct token sets, and
only such sets go on as may still give a rule that holds no shorter one:

* bad rows only become fewer, so sets below the support end;
* a set that is a rule ends: what holds it says nothing new;
* each token of a set must exclude a good row that the others let through. If it does not, then the set without
  it has as many good rows and no fewer bad ones, so it is a rule whenever the set is, and the same
  holds for every set around both. Tokens that always come together therefore never pair, however many they are.

So the work follows the sets that tell good rows apart, not all subsets of a url.
Each rule is posted under its rarest token; a url meets it there and is
blocked if it holds all of the rule's tokens. A policy of host and path rules goes before the mined ones.

Edge cases: a null url, or one without `://`, has empty host and path, no tokens, and is allowed; the verdict
depends on the url alone, so repeated rows agree; labels without a page and null labels are ignored; no labels,
no rules; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, stage

# (host, path, verdict): a rule holds for the host and its subdomains if the path starts so; the longest wins.
POLICY = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT, MIN_CONFIDENCE, Z = 0.002, 0.6, 2.0
MOST_TOKENS = 10                # no limit here: urls up to this size are what the tests mine by brute force


def _rest(url: Column) -> Column:
    """What follows the first `://`; null without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens; runs of digits count as one digit."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parts = [F.transform(F.split(host(url), r"\."), lambda x: F.concat(F.lit("h:"), x)),
             F.transform(F.split(path(url), r"[/.]"), lambda x: F.concat(F.lit("p:"), x)),
             F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))]
    every = F.concat(*[F.coalesce(p, F.array().cast("array<string>")) for p in parts])
    plain = F.transform(every, lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    return F.array_distinct(F.filter(plain, lambda x: F.length(x) > 2))


def lower_bound(share: Column, n: Column, z: float = Z) -> Column:
    """Wilson's lower bound of a share seen in n rows."""
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _bound(bad: Column, rows: Column) -> Column:
    return lower_bound(bad / rows, rows)


def mine(spark: SparkSession, pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules: rule (id), key (rarest token), tokens, confidence, support."""
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    known = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    rows = pages.join(known.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), "page_id")
    rows = rows.select(F.array_sort(tokens(F.col("url"))).alias("t"), "bad").where(F.size("t") > 0)
    # urls with the same tokens are one row from here on
    rows = stage(spark, rows.groupBy("t").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")), "url-rows")
    n = rows.agg(F.sum(F.col("bad") + F.col("good"))).first()[0] or 0
    # fewer bad rows than `least` can reach neither the support nor, all of them bad, the bound
    least = max(min_support * n, min_confidence * Z * Z / (1 - min_confidence) - 1e-9 if min_confidence < 1 else 1, 1)
    often = rows.select(F.explode("t").alias("token"), "bad", "good").groupBy("token").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    often = stage(spark, often.where(F.col("bad") >= least), "url-tokens")
    # `held`: the sets of one size, as sorted tokens, in every row; `level`: their counts
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "t", "bad", "good")
    held = rows.select("row", F.explode("t").alias("token"), F.col("bad").alias("b"), F.col("good").alias("g")).join(often.select("token"), "token")
    held = stage(spark, held.select("row", "b", "g", F.array("token").alias("set")), "url-held")
    level = often.select(F.array("token").alias("set"), "bad", "good")
    ok = (F.col("bad") / (F.col("bad") + F.col("good")) >= min_confidence) & (_bound(F.col("bad"), F.col("bad") + F.col("good")) >= min_confidence)
    found = []
    while True:
        level = stage(spark, level.withColumn("ok", ok), "url-sets")
        found.append(level.where("ok").drop("ok"))
        open_ = level.where("not ok and good > 0").drop("ok")        # what holds a rule is none; without good rows no token adds
        if open_.isEmpty():
            break
        held = held.join(open_.select("set"), "set").select(
            "row", "b", "g", F.slice("set", 1, F.size("set") - 1).alias("head"), F.element_at("set", -1).alias("last"))
        other = held.select("row", "head", F.col("last").alias("next"))
        wider = held.join(other, ["row", "head"]).where(F.col("last") < F.col("next"))
        held = stage(spark, wider.select("row", "b", "g", F.concat("head", F.array("last", "next")).alias("set")), "url-held")
        counted = held.groupBy("set").agg(F.sum("b").alias("bad"), F.sum("g").alias("good")).where(F.col("bad") >= least)
        # every set with one token less must be open itself and hold more good rows
        parts = counted.select("set", "bad", "good", F.explode(F.transform(
            "set", lambda x, i: F.concat(F.slice("set", 1, i), F.slice("set", i + 2, F.size("set"))))).alias("part"))
        less = open_.select(F.col("set").alias("part"), F.col("good").alias("of"))
        level = parts.join(less, "part").where("of > good").groupBy("set", "bad", "good").agg(F.count("*").alias("n")).where(
            F.col("n") == F.size("set")).drop("n")
    found = reduce(DataFrame.unionByName, found).select(F.xxhash64("set").alias("rule"), F.col("set").alias("tokens"), (
        F.col("bad") / (F.col("bad") + F.col("good"))).alias("confidence"), (F.col("bad") / F.lit(max(n, 1))).alias("support"))
    often = often.select("token", (F.col("bad") + F.col("good")).alias("count"))
    posted = found.select("rule", F.explode("tokens").alias("token")).join(often, "token")
    key = posted.groupBy("rule").agg(F.min(F.struct("count", "token")).alias("k"))
    return stage(spark, found.join(key, "rule").select("rule", F.col("k.token").alias("key"), "tokens", "confidence", "support"), "url-posted")


def blocked(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """k1, k2 (row_key of the url) of the urls that a mined rule blocks."""
    k1, k2 = row_key("url")
    urls = pages.select(k1.alias("k1"), k2.alias("k2"), tokens(F.col("url")).alias("held"))
    met = urls.select("k1", "k2", "held", F.explode("held").alias("key")).join(
        rules.select("key", F.col("tokens").alias("asked")), "key")
    return met.where(F.size(F.array_except("asked", "held")) == 0).select("k1", "k2").distinct()


def policy_rule(host_: Column, path_: Column, policy=POLICY) -> tuple[Column, Column]:
    """(rule, verdict) of the longest policy rule that fits; nulls if none does."""
    ordered = sorted(policy, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(((host_ == h) | host_.endswith("." + h)) & path_.startswith(p), h + p, v) for h, p, v in ordered]
    pick = lambda k: reduce(lambda c, f: c.when(f[0], f[k]), fits[1:], F.when(fits[0][0], fits[0][k]))
    return pick(1), pick(2)


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame, policy=POLICY, **how) -> DataFrame:
    """page_id, host, path, rule (of the policy), verdict (allow or block)."""
    pages = pages.select("page_id", "url")
    hits = blocked(pages, mine(spark, pages, labels, **how)).withColumn("hit", F.lit(True))
    k1, k2 = row_key("url")
    rows = pages.select("page_id", k1.alias("k1"), k2.alias("k2"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = policy_rule(F.col("host"), F.col("path"), policy)
    both = rows.join(hits, ["k1", "k2"], "left").select("page_id", "host", "path", rule.alias("rule"), verdict.alias("own"), "hit")
    return both.select("page_id", "host", "path", "rule", F.coalesce(
        "own", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))
