"""URL filters: host-suffix and path-prefix expressions against a rule table.

Every distinct host and path expands into expressions, one per host suffix (at a dot) and path prefix.
Only suffixes of as many labels and prefixes of as many characters as some rule has are made, which
loses nothing and keeps very long URLs cheap. Rules are folded to one row per prefix, the first
``PREFIX_DIGITS`` hex digits of their SHA-256. Expressions meet them by an equi-join on the prefix alone;
then the full digests of the prefix's rules confirm. The longest rule wins, of equally
long ones the one with the longer host, then ``block`` before ``allow``. The folded rules are stored and
broadcast below Spark's own threshold; beyond it a prefix that many URLs share is a skewed side of a sorted join, which AQE splits.

Defined cases: a null URL or one without ``://`` has empty host and path and no rule; an empty path is
matched only by rules with an empty path; no rule at all means ``DEFAULT_VERDICT``. Repeated rows are
judged alike. Null rule fields never match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm import common

PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substring(__url, locate('://', __url) + 3)")).otherwise(F.lit(""))


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path`` in place of columns of that name."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("host", "path")]
    rest = _after_scheme(F.col("__url"))
    return (
        df.select(*kept, F.coalesce(F.col(url), F.lit("")).alias("__url"))
        .withColumn("__rest", rest)
        .withColumn("host", F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), UPPER, LOWER))
        .withColumn("path", F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1))
        .drop("__url", "__rest")
    )


def _digest(host: Column, path: Column) -> Column:
    # A length first, so that no other split of the same characters has the same digest.
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def fold_rules(rules: DataFrame) -> DataFrame:
    """(prefix, rules): the rules of each digest prefix, one per host and path (of several actions the greatest).

    Stored, so that the planner knows its size and broadcasts it only below Spark's threshold.
    """
    whole = rules.filter("host is not null and path is not null and action is not null")
    one_each = whole.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).agg(F.max("action").alias("action"))
    with_digest = one_each.withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
    prefix = F.left("rule_digest", F.lit(PREFIX_DIGITS)).alias("prefix")
    folded = with_digest.groupBy(prefix).agg(F.collect_list(F.struct("rule_digest", "rule_host", "rule_path", "action")).alias("rules"))
    return common.store(folded, "url-rules")[0]


def match_rules(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """``pairs`` (host, path), distinct, with the winning ``rule`` and ``action`` of those that have one."""
    folded = fold_rules(rules)
    # Shapes of rules: labels of the host, characters of the path. One row of two short arrays, since
    # hosts have at most 127 labels and paths of rules few lengths.
    shapes = folded.select(F.inline("rules")).agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    )
    shape = shapes.first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])
    if not labels:
        return pairs.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action")).limit(0)
    suffixes = F.array(*[F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in labels])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    parts = (
        pairs.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .filter("suffix is not null")
        .select("host", "path", "suffix", F.explode("prefixes").alias("start"))
        .filter("start is not null")
        .select("host", "path", _digest(F.col("suffix"), F.col("start")).alias("digest"))
    )
    likely = parts.withColumn("digest_prefix", F.left("digest", F.lit(PREFIX_DIGITS))).join(folded, F.col("digest_prefix") == F.col("prefix"))
    confirmed = F.get(F.filter("rules", lambda r: r["rule_digest"] == F.col("digest")), F.lit(0))
    hits = likely.select("host", "path", confirmed.alias("hit")).filter("hit is not null").select("host", "path", "hit.rule_host", "hit.rule_path", "hit.action")
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        F.col("action"),  # "block" sorts after "allow"
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    return hits.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.action")


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``df`` with host, path, rule and verdict. ``rules``: host, path, action."""
    known = ("rule", "verdict")
    parsed = split_url(df, url)
    parsed = parsed.select(*[F.col(f"`{c}`") for c in parsed.columns if c.lower() not in known])
    won = match_rules(parsed.select("host", "path").distinct(), rules)
    won = won.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "rule", F.col("action").alias("__action"))
    joined = parsed.join(won, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
    return joined.withColumn("verdict", F.coalesce("__action", F.lit(default))).drop("__host", "__path", "__action")
