"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

A rule names a host (its subdomains included) and a path prefix; the longest rule that fits wins.
URLs that a rule judges are the labelled URLs. The trees learn from them how a blocked URL is
written: lengths, path depth, labels, digit ratio, character entropy, parameter and hyphen counts,
and statistics of the host's suffix over all URLs (rows, hosts, mean length), each as a power of
two. No feature is made from labels, and none names a host or a suffix: suffixes of like size look
alike to the trees. URLs without a rule get the trees' verdict.

The statistics cover all rows. The trees are fitted on a sample of the labelled URLs, chosen by a
hash of id and URL, of about ``TRAIN_ROWS`` rows; so one URL on very many pages gives its share of
the sample and no more. With ``held_out``, labelled URLs of one host in so many are kept out of the
sample, so that ``agreement`` can tell what the trees know of hosts they have not seen. If the
labelled URLs are of one kind only, that kind is the verdict; without labelled URLs it is allow.

A null URL, or one without ``://``, has an empty host and path and is judged by the trees. URLs of
any length are read whole. Rows are judged one by one; repeated rows alike. An empty table gives an
empty one. Only the id and the URL are read. All of it is DataFrame functions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

TRAIN_ROWS = 20_000
DRAWS = 1 << 40
# (verdict, rule): host, then path from the first slash.
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
]
FEATURES = [
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_entropy",
    "f_parameters", "f_hyphens", "f_suffix_rows", "f_suffix_hosts", "f_suffix_length",
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    written = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(written, UPPER, LOWER), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    # The longest is asked first, so it is added last.
    for kind, written in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = written.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(written)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits for each character."""
    letters = F.split(text, "")
    n = F.char_length(text).cast("double")
    counted = F.aggregate(
        F.array_distinct(letters),
        F.lit(0.0),
        lambda total, c: total
        + (n - F.char_length(F.replace(text, c, F.lit(""))))
        * F.log2(F.greatest(n - F.char_length(F.replace(text, c, F.lit(""))), F.lit(1.0))),
    )
    return F.when(n > 0, F.log2(n) - counted / n).otherwise(F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that need the URL alone, and the suffix."""
    url = F.coalesce("url", F.lit(""))
    n = F.char_length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns({
        "f_length": n.cast("double"),
        "f_host_length": F.char_length("host").cast("double"),
        "f_path_length": F.char_length("path").cast("double"),
        "f_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "f_labels": F.regexp_count("host", F.lit(r"\.")).cast("double"),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
        "f_entropy": entropy(url),
        "f_parameters": F.regexp_count(query, F.lit("[^&]+")).cast("double"),
        "f_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "_suffix": F.substring_index("host", ".", -1),
    })


def suffixes(rows: DataFrame) -> DataFrame:
    """Per suffix the powers of two below its rows, hosts and mean URL length, written."""
    power = lambda x: F.floor(F.log2(x)).cast("double")
    # Hosts first: a suffix on most rows is summed by host, then by suffix.
    hosts = rows.groupBy("_suffix", "host").agg(F.count(F.lit(1)).alias("_n"), F.sum("f_length").alias("_sum"))
    found = hosts.groupBy("_suffix").agg(
        power(F.sum("_n")).alias("f_suffix_rows"),
        power(F.count(F.lit(1))).alias("f_suffix_hosts"),
        power(F.greatest(F.sum("_sum") / F.sum("_n"), F.lit(1.0))).alias("f_suffix_length"),
    )
    return materialize(found, "suffixes")


def described(pages: DataFrame, rules: list[tuple[str, str]], id_column: str, seed: int = 7) -> DataFrame:
    """Per page its host, path, rule, what the rule says, its label, a random draw and ``FEATURES``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_column).alias("_id"), "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = lexical(rows.withColumns({"rule": rule, "_ruled": verdict}))
    blocked = F.when(F.col("_ruled") == "block", 1).when(F.col("_ruled") == "allow", 0)
    rows = rows.withColumn("_label", blocked.cast("double")).drop("url")
    draw = F.pmod(F.xxhash64(F.lit(seed), "_id", "host", "path"), F.lit(DRAWS))
    rows = materialize(rows.withColumn("_draw", draw), "urls")
    return rows.join(small_side(suffixes(rows)), "_suffix")


def in_fold(host: Column, held_out: int | None, seed: int = 7) -> Column:
    """Whether a host is kept out of the sample."""
    if not held_out:
        return F.lit(False)
    return F.pmod(F.xxhash64(F.lit(seed), F.lit("host"), host), F.lit(held_out)) == 0


def scored(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_column: str = "page_id",
           train_rows: int = TRAIN_ROWS, seed: int = 7, held_out: int | None = None) -> DataFrame:
    """The described pages with ``_block``, the trees' verdict as 0 or 1, and ``score``, their
    probability of a block (null where there was nothing to learn)."""
    rows = described(pages, rules, id_column, seed)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
    labelled = rows.filter(F.col("_label").isNotNull() & ~in_fold(F.col("host"), held_out, seed))
    kinds = {row[0]: row[1] for row in labelled.groupBy("_label").count().collect()}
    if len(kinds) < 2:
        return rows.withColumns({
            "_block": F.lit(max(kinds, default=0.0)), "score": F.lit(None).cast("double"),
        })
    share = min(DRAWS, DRAWS * train_rows // sum(kinds.values()))
    sample = materialize(labelled.filter(F.col("_draw") < share).select("_features", "_label"), "sample")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_block",
        maxIter=20, maxDepth=4, stepSize=0.2, seed=seed,
    ).setProbabilityCol("_p").setRawPredictionCol("_raw")
    return trees.fit(sample).transform(rows).withColumn("score", vector_to_array("_p")[1])


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_column: str = "page_id",
           train_rows: int = TRAIN_ROWS, seed: int = 7) -> DataFrame:
    """One row per page: host, path, the rule that fits, the verdict, and ``score``, the trees'
    probability of a block (null where there was nothing to learn)."""
    rows = scored(pages, rules, id_column, train_rows, seed)
    learned = F.when(F.col("_block") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        F.col("_id").alias(id_column), "host", "path", "rule",
        F.coalesce("_ruled", learned).alias("verdict"), "score",
    )


def agreement(pages: DataFrame, held_out: int = 5, **options) -> DataFrame:
    """For each host kept out of the sample: its labelled rows, how many the rules block, and for
    how many the trees say what the rule says."""
    seed = options.get("seed", 7)
    rows = scored(pages, held_out=held_out, **options)
    rows = rows.filter(F.col("_label").isNotNull() & in_fold(F.col("host"), held_out, seed))
    return rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("_label").cast("long").alias("n_blocked"),
        F.sum((F.col("_label") == F.col("_block")).cast("long")).alias("n_agree"),
    )
