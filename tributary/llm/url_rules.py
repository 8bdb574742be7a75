"""URL filters over hashed host-suffix and path-prefix expressions.

A rule (host, path) fits a URL of its host or a subdomain whose path starts
with the rule's path.  Each URL is expanded into the expressions (host suffix +
path prefix) that some rule could have; the expressions meet the rules in an
equi-join on the first 32 bits of their SHA-256 digest; what meets is confirmed
by the full digest, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SHAPES = 10_000   # distinct label counts or path lengths of all rules (the driver reads them)


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    u = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    u = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``verdict``, ``rule`` (host + path) rows from ``[("block", "net/"), ...]``."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def _prepared(rules: DataFrame) -> DataFrame:
    """Rules with their parts, digest and short prefix; one row a rule (block beats allow where both are given)."""
    at = F.instr("rule", "/")
    parts = (rules.where(F.col("rule").isNotNull() & F.col("verdict").isin("block", "allow"))
             .select("verdict", F.when(at > 0, F.translate(F.expr("substring(rule, 1, instr(rule, '/') - 1)"), UPPER, LOWER))
                     .otherwise(F.translate("rule", UPPER, LOWER)).alias("rule_host"),
                     F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("rule_path")))
    one = parts.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    text = F.concat("rule_host", "rule_path")
    return one.select("verdict", "rule_host", "rule_path", text.alias("rule"), F.sha2(text, 256).alias("digest"),
                      F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long").alias("short"))


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``.

    The longest rule that fits decides (most characters of host and path; then
    the longer host); a rule given twice counts as block if either says so.
    Without a rule that fits, the verdict is ``default``.  Null URLs and those
    without ``://`` have an empty host and path, which only a rule without
    both would fit.  Repeated rows are judged alike; columns named like the
    four new ones are replaced.  No rules: everything has the default.

    Equal (host, path) pairs are judged once, whatever part of the rows they
    hold.  A URL is expanded only to the label counts and path lengths that
    occur among the rules, so any rule is found and none is guessed.
    """
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    prepared = _prepared(rules)
    labels = F.size(F.split("rule_host", r"\."))
    shapes = prepared.select(F.explode(F.array(F.struct(F.lit("h").alias("k"), labels.alias("n")), F.struct(F.lit("p").alias("k"), F.length("rule_path").alias("n")))).alias("s")).select("s.*").distinct().limit(2 * RULE_SHAPES + 1).collect()
    if len(shapes) > 2 * RULE_SHAPES:
        raise ValueError("rules of too many shapes")
    counts = sorted(r["n"] for r in shapes if r["k"] == "h")
    lengths = sorted(r["n"] for r in shapes if r["k"] == "p")
    split = df.select(*kept, host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    if not counts:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    distinct = split.select("host", "path").distinct()
    n_labels = F.size(F.split("host", r"\."))
    suffixes = F.array_compact(F.array(*(F.when(n_labels >= c, F.substring_index("host", ".", -c)) for c in counts)))
    prefixes = F.array_compact(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)))
    expressions = (distinct.withColumn("e_host", F.explode(suffixes)).withColumn("e_path", F.explode(prefixes))
                   .withColumn("e_digest", F.sha2(F.concat("e_host", "e_path"), 256))
                   .withColumn("e_short", F.conv(F.substring("e_digest", 1, 8), 16, 10).cast("long")))
    confirmed = (expressions.join(prepared, F.col("e_short") == F.col("short"))
                 .where((F.col("e_digest") == F.col("digest")) & (F.col("e_host") == F.col("rule_host")) & (F.col("e_path") == F.col("rule_path"))))
    best = (confirmed.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("l"), F.length("rule_host").alias("h"), F.col("rule"), F.col("verdict"))).alias("b"))
            .select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict")))
    return (split.join(best, ["host", "path"], "left")
            .select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
