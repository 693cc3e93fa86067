"""URL filter by association rules.

Stated host and path rules decide what they cover. Their decisions label urls;
FP-growth mines combinations of url tokens that go with a label, rules below
the confidence and support bounds or implied by a shorter rule are pruned, and
the rest judge the other urls through an inverted index: each rule is posted
under its rarest token, candidates are found by an equality join on tokens and
kept if the url has all tokens of the rule.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

#: Fixed rules of the url contract: (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
    empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty as for the host."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def stated_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (size, rule, verdict), or null. A
    rule fits its host and all subdomains if the path starts with the rule's."""
    found = F.lit(None).cast("struct<size:int,host:int,rule:string,verdict:string>")
    hits = []
    for verdict, h, p in rules:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(len(h + p)).alias("size"), F.lit(len(h)).alias("host"),
                         F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        hits.append(F.when(fits, value))
    return F.greatest(*hits, found) if hits else found


def url_tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path segments and query names, marked by
    where they stand."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(F.split(F.lower(path), "/"), lambda x: F.concat(F.lit("path:"), x))
    names = F.transform(F.split(F.lower(query), "&"), lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^[^=]*", 0)))
    every = F.array_distinct(F.concat(labels, parts, names))
    return F.filter(F.coalesce(every, F.array().cast("array<string>")), lambda t: ~t.rlike("^(host|path|query):$"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, antecedent, verdict, confidence, support) from urls with a
    verdict (url, verdict). A rule goes if the rule without one of its tokens
    is as confident."""
    spark = labelled.sparkSession
    items = save(labelled.where("verdict is not null").select(
        F.array_append(url_tokens(F.col("url")), F.concat(F.lit("label:"), F.col("verdict"))).alias("items")))
    empty = "rule_id long, antecedent array<string>, verdict string, confidence double, support double, anchor string"
    if items.isEmpty():
        return spark.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith("label:") & ~F.exists(
        "antecedent", lambda t: t.startswith("label:")))
    rules = save(rules.select(F.array_sort("antecedent").alias("antecedent"),
                              F.substring(F.element_at("consequent", 1), 7, 20).alias("verdict"), "confidence", "support"))
    shorter = rules.select(F.col("antecedent").alias("part"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    implied = (rules.where(F.size("antecedent") > 1)
               .select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("t"))
               .withColumn("part", F.array_remove("antecedent", F.col("t")))
               .join(shorter, "part").where("v = verdict and c >= confidence")
               .select("antecedent", "verdict").distinct())
    rules = rules.join(implied, ["antecedent", "verdict"], "left_anti")
    # the rarest token of a rule is the one it is posted under
    counts = items.select(F.explode("items").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    posted = (rules.select("*", F.explode("antecedent").alias("anchor")).join(counts, "anchor")
              .groupBy("antecedent", "verdict", "confidence", "support")
              .agg(F.min(F.struct("n", "anchor")).alias("x")))
    return save(posted.select(F.xxhash64("antecedent", "verdict").alias("rule_id"), "antecedent", "verdict",
                              "confidence", "support", F.col("x.anchor").alias("anchor")))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, confidence, antecedent): each distinct url of ``urls`` that
    a rule fits, with the most confident rule; then the best supported, the
    longest, and block before allow."""
    tokens = urls.where("url is not null").select("url").distinct().withColumn("tokens", url_tokens(F.col("url")))
    hit = tokens.select("url", "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    hit = hit.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = hit.groupBy("url").agg(F.max(F.struct(
        "confidence", "support", F.size("antecedent").alias("size"), (F.col("verdict") == "block").alias("block"),
        "antecedent")).alias("x"))
    return best.select("url", F.when(F.col("x.block"), "block").otherwise("allow").alias("verdict"),
                       F.col("x.confidence").alias("confidence"), F.col("x.antecedent").alias("antecedent"))


def judge(pages: DataFrame, stated=RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence, antecedent), one row per
    input row. ``rule`` is the stated rule that decided, else null; without one
    the best mined rule decides, and where none fits the verdict is
    ``default``. Null urls and urls without `://` have an empty host and path,
    no stated rule and the default unless their tokens fit a mined rule. Extra
    columns are ignored; repeated rows are all returned."""
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", url.alias("url")).select("page_id", "url", host_of(F.col("url")).alias("host"),
                                                              path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("stated", stated_rule(F.col("host"), F.col("path"), stated))
    parsed = save(parsed)
    rules = mine(parsed.select("url", F.col("stated.verdict").alias("verdict")), min_support, min_confidence)
    other = match(parsed.where("stated is null"), rules).withColumnsRenamed({"verdict": "mined"})
    return parsed.join(other, "url", "left").select(
        "page_id", "host", "path", F.col("stated.rule").alias("rule"),
        F.coalesce("stated.verdict", F.when(F.col("stated").isNull(), F.col("mined")), F.lit(default)).alias("verdict"),
        F.when(F.col("stated").isNull(), F.col("confidence")).alias("confidence"),
        F.when(F.col("stated").isNull(), F.col("antecedent")).alias("antecedent"))
