"""Mixing sources to target weights: hash-random order inside each source, prefix sums, a cut at each exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.store import n_words, null_last, stable_key, stored, text_of

EPOCHS = 3
WEIGHTS = (1, 2, 3)
KEY_DIGITS = 15
BUCKET_DIGITS = 3


def keyed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", row: Column | None = None) -> DataFrame:
    """One row per input row: source key, random key, bucket of the key, size in words; `row` is carried along if given."""
    key = F.substring(F.md5(stable_key(docs, id_col, text).cast("binary")), 1, KEY_DIGITS)
    columns = [
        docs[id_col].alias("id"),
        null_last(docs[source]).alias("src"),
        key.alias("key"),
        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
        n_words(text_of(docs, text)).alias("size"),
    ]
    return docs.select(*columns, *([row.alias("row")] if row is not None else []))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """src, source_size, target from rows (src, source_size): shares by weight, none above `epochs` times its source.

    Sources in code-point order, null last, take the weights in turn. With the sources ordered by cap per unit of weight,
    those that end at their cap are a prefix, so resharing until nothing is above is one pass of running sums.
    The frame has one row per source, so its global order is small beside the data.
    """
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    caps = sizes.select("src", "source_size", weight.cast("long").alias("weight")).withColumn("cap", F.col("source_size") * epochs)
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    capped = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    run = caps.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(capped), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(capped), F.lit(0))).alias("open"),
    )
    level = F.col("left") / F.col("open")
    fits = F.when(level <= F.col("cap") / F.col("weight"), level)
    lowest = run.withColumn("level", F.coalesce(F.max(fits).over(everything), F.lit(0.0)))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return lowest.select("src", "source_size", target.alias("target"))


def mix(rows: DataFrame, counted: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Rows of `keyed` with source_size, target, copies (whole epochs) and taken (words the mix takes, repeats counted).

    Inside a source, rows stand in the order of a hash of their id. Each is taken whole as often as its source's target
    holds the whole source, and once more while the prefix sum of the sizes is below the rest; the row at the cut gives the
    words that are left, so a source's taken words add up to its target rounded down.

    A source is cut into buckets of the key. The prefix sum of a row is the total of the buckets before its own plus a
    running sum inside the bucket, so no task holds a whole source. `counted` may be a stored copy of `rows` without `row`.

    Null text: size 0. Null source: a source of its own. Null id: ordered by a hash of the text. Equal rows: each counts
    by itself. Empty input: empty result.
    """
    totals = stored((rows if counted is None else counted).groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    budget = targets(totals.groupBy("src").agg(F.sum("bucket_size").alias("source_size")), weights, epochs)
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("src", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(offsets.join(budget, "src"), ["src", "bucket"])
    start = F.col("before") + F.sum("size").over(inside) - F.col("size")
    words = F.floor("target").cast("long")
    copies = F.coalesce(F.least(F.lit(epochs), F.try_divide(words, F.col("source_size")).cast("long")), F.lit(0)).cast("long")
    whole = placed.withColumn("start", start).withColumn("copies", copies)
    rest = words - F.col("copies") * F.col("source_size") - F.col("start")
    extra = F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return whole.withColumn("taken", F.col("copies") * F.col("size") + extra).drop("bucket", "before")


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mix as whole documents: each row once per epoch, and once more if the cut reaches it. Same columns as `docs`.

    A document without words is in the mix once per whole epoch of its source, and never by the cut.
    """
    rows = keyed(docs, row=F.struct(*[docs[c] for c in docs.columns]))
    taken = mix(rows, keyed(docs), weights, epochs)
    times = F.col("copies") + (F.col("taken") > F.col("copies") * F.col("size")).cast("long")
    repeated = taken.filter(times > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("epoch"))
    return repeated.select("row.*")


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of `docs`."""
    rows = stored(keyed(docs), "mix-rows")
    return mix(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
