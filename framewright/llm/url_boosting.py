"""URL filters: domain rules, and gradient-boosted trees on lexical features for the rest.

The trees are trained from labelled URLs (here those that a rule decides) on length, depth, digit
ratio, entropy, parameter counts and suffix statistics. Everything on the way is DataFrame
expressions and Spark's own tree ensembles, which run in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import ascii_lower, written

#: Fixed by the contract: (host/path rule, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
LEXICAL = ("n_url", "n_host", "n_path", "n_query", "n_labels", "depth", "digits", "entropy", "params", "marks", "fragment")
SUFFIXES = ("tld", "domain", "segment")
FOLDS = 10


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: then up to
    ``? #`` or the end. Both are empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; equally long rules: the first listed."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0]))[::-1]:
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of ``url``, ``host`` and ``path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels, bare = F.split("host", r"\."), F.regexp_replace(url, "[0-9]", "")
    # Shannon entropy of the characters: each distinct one counts by what its removal shortens
    part = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    chars = F.transform(F.filter(F.array_distinct(F.split(url, "")), lambda c: c != ""), lambda c: -part(c) * F.log2(part(c)))
    return df.select(
        "*", F.length(url).cast("double").alias("n_url"), F.length("host").cast("double").alias("n_host"),
        F.length("path").cast("double").alias("n_path"), F.length(query).cast("double").alias("n_query"),
        F.size(labels).cast("double").alias("n_labels"),
        (F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))).cast("double").alias("depth"),
        ((F.length(url) - F.length(bare)) / size).alias("digits"),
        F.aggregate(chars, F.lit(0.0), lambda a, x: a + x).alias("entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("params"),
        (F.length(F.regexp_replace(url, "[A-Za-z0-9/:.]", "")) / size).alias("marks"),
        F.contains(url, F.lit("#")).cast("double").alias("fragment"))


def with_suffixes(df: DataFrame) -> DataFrame:
    """Adds the suffixes of ``host`` and ``path``."""
    labels = F.split("host", r"\.")
    return df.select("*", F.element_at(labels, -1).alias("tld"), F.array_join(F.slice(F.reverse(labels), 1, 2), ".").alias("domain"),
                     F.regexp_extract("path", "^(/[^/]*)", 1).alias("segment"))


def suffix_counts(known: DataFrame) -> DataFrame:
    """(kind, value, fold, blocked, n): how many labelled URLs of each fold have a suffix, and how many of them are blocked."""
    each = known.select("label", "fold", F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("value")) for s in SUFFIXES])).alias("s"))
    return each.groupBy("s.kind", "s.value", "fold").agg(F.sum("label").alias("blocked"), F.count("*").alias("n"))


def with_rates(part: DataFrame, counts: DataFrame, prior: float, smooth: float, apart: bool = False) -> DataFrame:
    """Adds rate and count of each suffix; with ``apart`` those of the other folds than the row's own.

    Leaving out a row's label alone would tell it: of one suffix the blocked rows would have the lower rate."""
    blocked, n = F.coalesce("__blocked", F.lit(0.0)), F.coalesce("__n", F.lit(0))
    for s in SUFFIXES:
        mine = counts.where(F.col("kind") == s).withColumnRenamed("value", s)
        part = part.join(mine.groupBy(s).agg(F.sum("blocked").alias("__blocked"), F.sum("n").alias("__n")), s, "left")
        if apart:
            part = part.join(mine.select(s, "fold", F.col("blocked").alias("__own"), F.col("n").alias("__of")), [s, "fold"], "left")
            part = part.withColumns({"__blocked": blocked - F.coalesce("__own", F.lit(0.0)), "__n": n - F.coalesce("__of", F.lit(0))})
        part = part.withColumns({f"{s}_rate": (blocked + prior * smooth) / (n + smooth), f"{s}_count": F.log1p(n.cast("double"))})
        part = part.drop("__blocked", "__n", "__own", "__of")
    return part


def judge(df: DataFrame, key_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = 10_000, trees: int = 12,
          depth: int = 4, smooth: float = 4.0) -> DataFrame:
    """(key, host, path, rule, verdict): the longest rule's verdict, else the trees'.

    The trees are fitted on at most ``sample`` distinct labelled URLs, those of the smallest hash
    (a bounded, repeatable sample). The suffix statistics, smoothed block rate and count of top-level
    domain, domain and first path segment, are those of all distinct labelled URLs; a training row
    gets those without the tenth of the URLs that it is in, so its own label is left out. Every row is judged. Null and empty URLs have empty host and
    path, fit no rule and are scored on zeros. If the labelled URLs all have one verdict, the rest
    get it; with none, all rows are allowed. Rows of equal URLs get equal verdicts. An empty table gives no rows.
    Other columns aren't read."""
    host, path = host_and_path(F.col("url"))
    rows = df.select(F.col(key_col).alias("key"), F.col(url_col).alias("url")).select("key", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    keep = ["key", "host", "path", F.col("ruled.rule").alias("rule")]
    block = (F.col("ruled.verdict") == "block").cast("double")
    known = with_suffixes(rows.where(F.col("ruled").isNotNull()).select("url", "host", "path", block.alias("label")).distinct())
    known = written(known.withColumn("fold", F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS))), "urls")
    n, blocked = known.agg(F.count("*"), F.sum("label")).first()
    default = "block" if n and blocked == n else "allow"
    if not n or blocked in (0, n):
        return rows.select(*keep, F.coalesce("ruled.verdict", F.lit(default)).alias("verdict")).withColumnRenamed("key", key_col)
    prior, counts = blocked / n, written(suffix_counts(known), "urls")
    names = [*LEXICAL, *[f"{s}_{x}" for s in SUFFIXES for x in ("rate", "count")]]
    vector = VectorAssembler(inputCols=names, outputCol="features")
    train = written(known.orderBy(F.xxhash64("url"), "url").limit(sample).coalesce(1), "urls")
    fitted = with_rates(train, counts, prior, smooth, apart=True)
    fitted = written(lexical(fitted).orderBy(F.xxhash64("url"), "url").select("label", *names).coalesce(1), "urls")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1).fit(vector.transform(fitted))
    # the statistics meet the distinct suffixes first, so the rows travel once
    rows = with_suffixes(rows)
    rates = written(with_rates(rows.select(*SUFFIXES).distinct(), counts, prior, smooth), "urls")
    scored = model.transform(vector.transform(lexical(rows.join(rates, [*SUFFIXES]))))
    method = F.when(F.col("prediction") == 1, "block").otherwise("allow")
    return scored.select(*keep, F.coalesce("ruled.verdict", method).alias("verdict")).withColumnRenamed("key", key_col)
