"""Private-domain label of a URL, by joining its host with the public-suffix rules."""

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelore.functions.urls import url_host

# Rules of one last label lie in hash buckets of about so many, so that each look-up is short.
_BUCKET_RULES = 4

_EXACT, _WILDCARD, _EXCEPTION = 1, 2, 4

# A label starts and ends with a letter or digit; "-" and "_" may stand in between. Any
# non-ASCII character counts as a letter. The last label may not start with a digit. All
# repetitions are possessive: a host is read once, from left to right.
_LETTER = r"a-z\x{80}-\x{10ffff}"
_REST = rf"[{_LETTER}0-9]*+(?:[-_]++[{_LETTER}0-9]++)*+"
_DOMAIN = rf"\A(?:[{_LETTER}0-9]{_REST}\.)*+[{_LETTER}]{_REST}\z"
_LONG_LABEL = r"[^.]{64}"
_MAX_LABEL = 63
_MAX_NAME = 253


def parse_suffix_rules(lines: DataFrame) -> DataFrame:
    """Rule lines (column ``value``) -> suffix, labels, kinds.

    ``kinds`` adds up which forms of rule exist for a suffix: plain, ``*.`` and ``!``.
    """
    rule = F.regexp_extract("value", r"\A\s*(\S+)", 1)
    rules = lines.select(rule.alias("rule")).where(
        (F.col("rule") != "") & ~F.col("rule").startswith("//")
    )
    kind = (
        F.when(F.col("rule").startswith("*."), _WILDCARD)
        .when(F.col("rule").startswith("!"), _EXCEPTION)
        .otherwise(_EXACT)
    )
    return (
        rules.select(
            F.lower(F.regexp_replace("rule", r"\A(?:\*\.|!)", "")).alias("suffix"),
            kind.alias("kind"),
        )
        .groupBy("suffix")
        .agg(F.bit_or("kind").alias("kinds"))
        .select("suffix", F.size(F.split("suffix", r"\.")).alias("labels"), "kinds")
    )


def suffix_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The public-suffix rules, from a list file or else the list that Spark ships."""
    return parse_suffix_rules(_shipped_lines(spark) if path is None else spark.read.text(path))


def compiled_rules(rules: DataFrame) -> DataFrame:
    """(suffix, labels, kinds) -> (last, depth, buckets): one row for each last label.

    ``depth`` is the number of labels of its longest rule; ``buckets`` is an array of arrays
    of suffix and kinds, each rule in the one that the hash of its suffix says.
    """
    keyed = rules.select("*", F.substring_index("suffix", ".", -1).alias("last"))
    sizes = keyed.groupBy(F.col("last").alias("size_last")).agg(
        F.max("labels").alias("depth"),
        F.ceil(F.count("*") / _BUCKET_RULES).cast("int").alias("size"),
    )
    rule = F.struct("suffix", "kinds")
    full = keyed.join(sizes, F.col("last") == F.col("size_last")).select(
        "last", F.pmod(F.xxhash64("suffix"), F.col("size")).cast("int").alias("bucket"), rule.alias("rule")
    )
    grid = sizes.select(
        F.col("size_last").alias("last"), F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("bucket"),
        F.lit(None).cast(full.schema["rule"].dataType).alias("rule"),
    )
    filled = full.unionAll(grid).groupBy("last", "bucket").agg(F.collect_list("rule").alias("rules"))
    placed = filled.groupBy("last").agg(F.sort_array(F.collect_list(F.struct("bucket", "rules"))).alias("placed"))
    return placed.join(sizes, F.col("last") == F.col("size_last")).select(
        "last", "depth", F.col("placed.rules").alias("buckets")
    )


def _shipped_rules(spark: SparkSession) -> DataFrame:
    if not _shipped:
        _shipped.append(compiled_rules(suffix_rules(spark)).toArrow())
    return spark.createDataFrame(_shipped[0])


# The list that Spark ships, compiled once per process: about 9,000 rules, 1,500 last labels.
_shipped: list[pa.Table] = []


def _shipped_lines(spark: SparkSession) -> DataFrame:
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    stream = loader.getResourceAsStream("mozilla/public-suffix-list.txt")
    if stream is None:
        raise FileNotFoundError("this Spark build has no public-suffix list; pass a path")
    try:
        text = bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
    return spark.createDataFrame(pa.table({"value": text.splitlines()}))


def _label_count(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("."))) + 1


def top_private_domain(
    df: DataFrame, url_col: str, out: str = "tpd", rules: DataFrame | None = None
) -> DataFrame:
    """Add the label in front of the public suffix of each URL's host.

    No URL host gives ''; a host that is no domain name stays as it is; a host that is
    itself a public suffix gives that suffix; a host under no known suffix gives its last
    label.

    Rules are compiled to one row for each last label. A host meets its row in one join and
    is looked up there, longest suffix first. Spark broadcasts compiled rules up to its
    ``autoBroadcastJoinThreshold``, as it does with the public list.
    """
    spark = df.sparkSession
    table = _shipped_rules(spark) if rules is None else compiled_rules(rules)
    table = table.select(
        F.col("last").alias("_last"), F.col("depth").alias("_depth"),
        F.col("buckets").alias("_buckets"),
    )
    last = F.when(F.col("_valid"), F.substring_index("_name", ".", -1))
    found = _with_name(df, url_col).join(table, last == F.col("_last"), "left")
    before_suffix = F.try_element_at(F.split("_name", r"\."), -(F.col("_suffix_labels") + 1))
    label = (
        F.when(~F.col("_valid"), F.col("_host"))
        .when(F.col("_suffix_labels") == 0, F.substring_index("_host", ".", -1))
        .when(F.col("_suffix_labels") >= F.col("_labels"), F.col("_name"))
        .otherwise(before_suffix)
    )
    return found.withColumn("_suffix_labels", _suffix_labels()).select(
        *(c for c in df.columns if c != out), label.alias(out)
    )


def _suffix_labels() -> Column:
    """Labels of the public suffix of a host, by its longest rule; 0 without one."""
    labels, buckets = F.col("_labels"), F.col("_buckets")

    def rule(n: Column) -> Column:
        suffix = F.call_function("substring_index", F.col("_name"), F.lit("."), -n)
        bucket = F.get(buckets, F.pmod(F.xxhash64(suffix), F.size(buckets)).cast("int"))
        same = F.filter(bucket, lambda rule: rule["suffix"] == suffix)
        return F.struct(n.alias("n"), F.get(same, 0)["kinds"].alias("kinds"))

    def taken(found: Column) -> Column:
        n, kinds = found["n"], found["kinds"]
        return (
            F.when((kinds.bitwiseAND(_WILDCARD) != 0) & (labels > n), n + 1)
            .when(kinds.bitwiseAND(_EXACT) != 0, n)
            .when(kinds.bitwiseAND(_EXCEPTION) != 0, n - 1)
        )

    lengths = F.sequence(F.least(labels, F.col("_depth")), F.lit(1), F.lit(-1))
    matches = F.filter(F.transform(F.transform(lengths, rule), taken), lambda n: n.isNotNull())
    return F.coalesce(F.get(matches, 0), F.lit(0))


def _with_name(df: DataFrame, url_col: str) -> DataFrame:
    """Add the raw host and its normalised domain name, label count and validity.

    Only ASCII letters are folded, and other full stops count as dots; for the many hosts
    that are all ASCII that is just lower case.
    """
    host, folded = F.col("_host"), F.col("_folded")
    fold = F.when(F.length(host) == F.octet_length(host), F.lower(host)).otherwise(
        F.translate(host, string.ascii_uppercase + "。．｡", string.ascii_lowercase + "...")
    )
    name = F.when(folded.endswith("."), F.substring(folded, 1, F.length(folded) - 1))
    short = (F.length("_name") <= _MAX_LABEL) | ~F.col("_name").rlike(_LONG_LABEL)
    valid = F.col("_name").rlike(_DOMAIN) & short & (F.length("_name") <= _MAX_NAME)
    return (
        df.withColumn("_host", url_host(F.col(url_col)))
        .withColumn("_folded", fold)
        .withColumn("_name", name.otherwise(folded))
        .drop("_folded")
        .withColumn("_valid", valid)
        .withColumn("_labels", F.when(F.col("_valid"), _label_count(F.col("_name"))))
    )
