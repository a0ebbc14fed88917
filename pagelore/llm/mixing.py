"""Mix sources to target weights by entropy balancing.

Each document gets a rate: how often the mix should take it. Of all rates that meet every
source's target of words, entropy balancing takes those that differ least from 1 in relative
entropy, with no rate above ``most``: rate = min(most, exp(tilt * size / mean size)). The tilts
are the optimum of a convex dual and come out of Newton's method. Rates depend on source and
size only, so Spark counts the documents of each source and size once, and every iteration is a
join and an aggregation of that table. Rates then become whole copies.
"""

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.packing import rank_within
from pagelore.llm.storage import stage, temporaries

MOST_COPIES = 3
#: Newton stops when every source is this near its target, as a share of it; rounding makes up
#: for what is left. It fails if so many steps, far more than halving needs, do not get there.
NEAR = 1e-5
STEPS = 200
#: Lower bits of monotonically_increasing_id, which count within a partition.
_ID_BITS = 33


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, size) -> (source, size, target).

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share all sizes. A target
    stops at ``most`` times the source's size; the excess goes to the others by weight until
    none is above. Only sums travel to the driver.
    """
    spark = sources.sparkSession
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    # The id has the number of the partition in its upper bits, that of the row within in the lower.
    numbered = stage(
        ordered.select(
            F.col("source").cast("string"), F.col("size").cast("long"), F.monotonically_increasing_id().alias("id")
        ),
        "mix-sources",
    ).withColumn("part", F.shiftright("id", _ID_BITS).cast("int"))
    counts = sorted(tuple(r) for r in numbered.groupBy("part").agg(F.count("*")).collect())
    before = [0, *accumulate(n for _, n in counts)][: len(counts)]
    # From Arrow, as rows of a list would go through Python workers.
    starts = spark.createDataFrame(
        pa.table({"of_part": pa.array([part for part, _ in counts], pa.int32()), "before": pa.array(before, pa.int64())})
    )
    place = F.col("before") + F.col("id").bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    weighed = stage(
        numbered.join(F.broadcast(starts), F.col("part") == F.col("of_part")).select(
            "source", "size", (place % 3 + 1.0).alias("weight")
        ),
        "mix-sources",
    ).withColumn("cap", F.col("size") * float(most))
    total = weighed.agg(F.sum("size")).first()[0] or 0
    share = 0.0
    while True:
        capped = F.col("cap") < F.lit(share) * F.col("weight")
        left = weighed.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("weight"),
        ).first()
        again = (total - left["capped"]) / left["weight"] if left["weight"] else share
        if again <= share:
            break
        share = again
    return weighed.select(
        "source", "size", F.least("cap", F.lit(share) * F.col("weight")).alias("target")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order of its terms; terms count to 10 digits after the
    point, and 28 before it."""
    return F.sum(x.cast("decimal(38,10)")).cast("double")


def balanced_rates(counts: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, words, n) and (source, size, target) -> (source, words, n, rate).

    Newton's method on each source's dual, kept inside a bracket that halves when a step would
    leave it. ``words`` of 0 gets rate 1, a source without words as well. Sums are of decimals,
    which give the same result in any order, so that reruns agree to the last bit.
    """
    sizes = counts.groupBy("source").agg(
        F.sum(F.col("words") * F.col("n")).alias("source_words"), F.sum("n").alias("docs")
    )
    sizes = sizes.withColumnRenamed("source", "s").where("source_words > 0")
    known = sizes.join(targets.select(F.col("source").alias("t"), "target"), _same("s", "t"))
    state = known.select(
        F.col("s").alias("tilt_source"), "target",
        (F.col("source_words") / F.col("docs")).alias("mean"),
        F.lit(0.0).alias("tilt"), F.lit(-1e9).alias("low"), F.lit(1e9).alias("high"),
    )
    state = stage(state, "mix-tilts")
    x = F.col("words") / F.col("mean")
    rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * x, F.lit(50.0))))
    for _ in range(STEPS):
        now = counts.join(state, _same("source", "tilt_source"))
        moved = now.groupBy("tilt_source").agg(
            F.first("target").alias("target"), F.first("mean").alias("mean"),
            F.first("tilt").alias("tilt"), F.first("low").alias("low"), F.first("high").alias("high"),
            _exact_sum(rate * F.col("words") * F.col("n")).alias("words"),
            _exact_sum(F.when(rate < most, rate * x * F.col("words") * F.col("n")).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        near = F.abs(gap) <= NEAR * F.col("target")
        step = F.when(F.col("slope") > 0, F.col("tilt") - gap / F.col("slope"))
        # Where all rates are at the limit there is no slope and no better tilt above.
        inside = (step > F.col("new_low")) & (step < F.col("new_high"))
        middle = F.when(F.col("new_high") >= 1e9, F.abs(F.col("tilt")) * 4 + 1.0).when(
            F.col("new_low") <= -1e9, -(F.abs(F.col("tilt")) * 4 + 1.0)
        ).otherwise((F.col("new_low") + F.col("new_high")) / 2)
        moved = moved.withColumns({"new_low": low, "new_high": high, "near": near})
        moved = stage(
            moved.select(
                "tilt_source", "target", "mean",
                F.when(F.col("near"), F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
                F.col("new_low").alias("low"), F.col("new_high").alias("high"), "near",
            ),
            "mix-tilts",
        )
        state = moved.drop("near")
        if moved.where(~F.col("near")).isEmpty():
            break
    else:
        raise RuntimeError("a source's rates do not meet its target")
    found = state.select("tilt_source", "tilt", "mean")
    return counts.join(found, _same("source", "tilt_source"), "left").select(
        "source", "words", "n", F.coalesce(rate, F.lit(1.0)).alias("rate")
    )


def whole_copies(rates: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, words, n, rate) -> (source, words, copies, extra): ``extra`` of the documents
    are taken once more than ``copies``.

    Goes through a source's sizes from the largest to the smallest and carries what rounding
    left over, so that the words taken differ from the rates' by about the smallest size. A
    source has one row for each size, at most as many as its longest document has words.
    """
    out = "source string, words long, copies int, extra long"

    def round_source(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("words", "descending")])
        carry, copies, extra = 0.0, [], []
        for words, n, rate in zip(*(rows[c].to_pylist() for c in ("words", "n", "rate"))):
            base = min(int(rate), most)
            wanted = (rate - base) * n
            if not words:
                more = 0
            else:
                more = int(min(n if base < most else 0, max(0, round(wanted + carry / words))))
                carry += (wanted - more) * words
            copies.append(base)
            extra.append(more)
        done = rows.select(["source", "words"])
        done = done.append_column("copies", pa.array(copies, pa.int32()))
        return done.append_column("extra", pa.array(extra, pa.int64()))

    return rates.groupBy("source").applyInArrow(round_source, out)


def mix(
    docs: DataFrame, most: int = MOST_COPIES, text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """All rows and columns of a table with size, source_size, target and copies added.

    Null sources are one source; null texts have size 0. Documents without words have no
    copies. Which of equally long documents of a source get one copy more follows from the hash
    of the row, so reruns agree; equal rows count one by one. Columns of the added names are
    replaced.
    """
    added = ("size", "source_size", "target", "copies")
    names = [c for c in docs.columns if c not in added]
    text, source = F.col(text_column).cast("string"), F.col(source_column).cast("string")
    marked = docs.select(F.struct(*names).alias("row"), source.alias("mix_source"), word_count(text).alias("mix_size"))
    return _with_copies(marked, most).select("row.*", *added)


def mixed_sizes(docs: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """The same without the texts: doc_id, size, source_size, target, copies."""
    marked = docs.select(
        F.struct(F.col("doc_id")).alias("row"), F.col("source").cast("string").alias("mix_source"),
        word_count(F.col("text").cast("string")).alias("mix_size"),
    )
    marked = stage(marked, "mix-sizes", keep=True)
    return _with_copies(marked, most).select("row.*", "size", "source_size", "target", "copies")


def _class_copies(marked: DataFrame, most: int) -> DataFrame:
    """(class_source, class_size, source_size, target, copies, extra) of all sources and sizes."""
    counts = stage(
        marked.groupBy(F.col("mix_source").alias("source"), F.col("mix_size").alias("words")).agg(
            F.count("*").alias("n")
        ),
        "mix-counts",
    )
    sources = counts.groupBy("source").agg(F.sum(F.col("words") * F.col("n")).alias("size"))
    targets = stage(source_targets(sources, most), "mix-targets")
    copies = whole_copies(balanced_rates(counts, targets, most), most)
    return copies.join(targets.withColumnRenamed("source", "t"), _same("source", "t")).select(
        F.col("source").alias("class_source"), F.col("words").alias("class_size"),
        F.col("size").alias("source_size"), "target", "copies", "extra",
    )


def _with_copies(marked: DataFrame, most: int) -> DataFrame:
    spark = marked.sparkSession
    with temporaries(spark):
        per_class = stage(_class_copies(marked, most), "mix-copies", keep=True)
    # A struct, so that the null source is a class of its own.
    keyed = marked.withColumn("mix_class", F.struct("mix_source", "mix_size"))
    ranked = rank_within(keyed, "mix_class", "mix_rank")
    joined = ranked.join(
        per_class,
        (F.col("mix_size") == F.col("class_size")) & _same("mix_source", "class_source"),
    )
    taken = F.when(F.col("mix_size") == 0, 0).otherwise(
        F.col("copies") + F.when(F.col("mix_rank") < F.col("extra"), 1).otherwise(0)
    )
    return joined.select(
        "row", F.col("mix_size").alias("size"), "source_size", "target", taken.cast("int").alias("copies")
    )
