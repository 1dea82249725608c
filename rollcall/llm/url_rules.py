"""URL filters by association rules. DataFrame operations and Spark's FP-growth only.

Labelled pages are transactions of URL tokens and a label. FP-growth mines the frequent combinations; rules of any
number of tokens that imply a bad label with enough confidence and support block the URLs that hold all their tokens.
A rule is left out if one with a token less has at least its confidence, which changes neither a verdict nor the highest
confidence. Rules are matched through an inverted index from each rule's rarest token. Given rules by host and path come
first.

Defined cases: a null url, or one without "://", has an empty host and path and no tokens; no mined rule blocks it. A
page without a label is no transaction; one with several labels counts once per label. Repeated rows are judged
each. Without labels or without frequent combinations, pages that no given rule decides are allowed. An empty table
gives an empty table. Columns other than page_id and url are not looked at.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.llm.common import lower_ascii, session_of, store_of

#: Given rules: host, path and verdict.
GIVEN = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
#: Bad labelled pages that a combination must match, in a table of any size, and their share among those it matches.
LEAST_PAGES, LEAST_CONFIDENCE = 20, 0.6
BAD = "=bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        text, verdict = F.when(fits, F.lit(name + prefix)).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens, in order: the host and its labels, path segments and file suffix without numbers, query keys."""
    def marked(mark: str, parts: Column) -> Column:
        parts = F.filter(parts, lambda p: (p != "") & ~p.rlike("^[0-9]+$"))
        return F.transform(parts, lambda p: F.concat(F.lit(mark + ":"), p))

    # a number with a suffix leaves the suffix
    segments = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(s, r"^[0-9]+\.", "."))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.transform(query, lambda q: F.regexp_replace(q, r"(?s)=.*", ""))
    return F.array_sort(F.array_distinct(F.concat(
        marked("host", F.array(host)), marked("label", F.split(host, r"\.")), marked("path", segments),
        marked("query", query))))


def mine_rules(tokens: DataFrame, least_pages: int = LEAST_PAGES,
               least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """rule (number), tokens, confidence, support. Takes the columns tokens (distinct strings) and bad (boolean)."""
    items = tokens.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
                          .alias("items"))
    n = items.count()
    if n < least_pages:
        return session_of(tokens).createDataFrame(
            [], StructType.fromDDL("tokens array<string>, confidence double, support double, rule long"))
    support = (least_pages - 0.5) / n  # times n it is rounded up
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=least_confidence).fit(items)
    mined = store_of(tokens, "url_rules").keep(
        model.associationRules.where(F.get("consequent", F.lit(0)) == BAD)
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"), "mined")
    return without_implied(mined).withColumn("rule", F.monotonically_increasing_id())


def without_implied(mined: DataFrame) -> DataFrame:
    """The rules but those of which one with a token less has at least their confidence. Tokens are sorted."""
    fewer = F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))
    implied = (mined.select("tokens", "confidence", F.explode(fewer).alias("_fewer"))
               .join(mined.select(F.col("tokens").alias("_fewer"), F.col("confidence").alias("_confidence")), "_fewer")
               .where("_confidence >= confidence").select("tokens").distinct())
    return mined.join(implied, "tokens", "left_anti")


def matches(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The token sets that hold all tokens of a rule, with the highest confidence among those rules.

    The index has one row per rule, under that of its tokens which the fewest token sets hold. Token sets are distinct,
    so a host with most pages is one row here.
    """
    tokens = token_sets.select("tokens", F.explode("tokens").alias("token"))
    needed = rules.select("rule", "confidence", F.col("tokens").alias("needed"), F.explode("tokens").alias("token"))
    holders = tokens.join(needed.select("token").distinct(), "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"))
    index = needed.join(holders, "token").groupBy("rule", "confidence", "needed").agg(
        F.min_by("token", F.struct("sets", "token")).alias("token"))
    return (tokens.join(index, "token").where(F.size(F.array_except("needed", "tokens")) == 0)
            .groupBy("tokens").agg(F.max("confidence").alias("bad_confidence")))


def judge_urls(pages: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """page_id, host, path, rule, verdict and bad_confidence of every row. `labels` has doc_id and bad.

    A page shows the document whose number its path carries, so that document's label is the page's.
    """
    store = store_of(pages, "url_rules")
    host, path = host_and_path(F.col("url"))
    read = (pages.select("page_id", "url", host.alias("host"), path.alias("path"))
            .withColumn("tokens", F.when(F.concat("host", "path") == "", F.array().cast("array<string>"))
                        .otherwise(url_tokens(F.col("url"), F.col("host"), F.col("path")))))
    read = store.keep(read.drop("url"), "tokens")
    shown = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) AS bigint)")
    transactions = (read.where(F.size("tokens") > 0).select(shown.alias("doc_id"), "tokens")
                    .join(labels, "doc_id").select("tokens", "bad"))
    rules = store.keep(mine_rules(store.keep(transactions, "transactions"), **parameters), "rules")
    hits = store.keep(matches(read.select("tokens").distinct(), rules), "hits")
    text, verdict = given_rule(F.col("host"), F.col("path"))
    mined = F.when(F.col("bad_confidence").isNotNull(), "block").otherwise("allow")
    return read.join(hits, "tokens", "left").select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "bad_confidence")


def bad_labels(labels: DataFrame) -> DataFrame:
    """Low quality or toxic is bad; a null label is not."""
    return labels.select("doc_id", (F.coalesce(F.col("quality"), F.lit(1)) == 0).alias("low"),
                         (F.coalesce(F.col("toxic"), F.lit(0)) == 1).alias("toxic")).select(
        "doc_id", (F.col("low") | F.col("toxic")).alias("bad"))
