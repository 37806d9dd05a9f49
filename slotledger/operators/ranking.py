"""Top rows, dense ranks, scores and unpivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotledger import settings


def preview(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in an order: a top-n in every task, never a full sort."""
    return df.orderBy(*order).limit(n)


def top_one(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return preview(df, order, 1)


BUCKETS = 64
_REPEATS = 10_000  # equal rows brought back by one array


def dense_ranks(
    df: DataFrame, ranks: Mapping[str, Column], buckets: Mapping[str, Column] | None = None, last: bool = False
) -> DataFrame:
    """Dense rank columns, one per named number: the least is first, NULL shares the last place.

    The distinct values of all ranks form one table, each value in a field of its own type. They are dealt into buckets
    of about equal count by approximate quantiles, a short array for each rank from a scalar subquery. The quantiles
    only divide the work: values are ranked inside their bucket, and the first of each bucket tells all others how many
    it holds, so ranks are exact and no task sorts everything. All places of a row come back by one join and meet again
    as an array on the row; a value that very many rows share is a skewed join key, which adaptive execution splits.

    ``buckets`` gives for each rank a number from 0 to BUCKETS - 1 that rises with its value, where one is known; no
    quantiles are needed then. With ``last`` there is a column ``<name>_last`` too: the last place of the rank. Equal rows
    stay as many as they were; columns must be of types that can be grouped.
    """
    kinds = [df.select(key).schema[0].dataType for key in ranks.values()]

    def identity(i: int, name: str, key: Column) -> Column:
        fields = [(key if j == i else F.lit(None)).cast(kind).alias(f"k{j}") for j, kind in enumerate(kinds)]
        known = (buckets[name] if buckets else F.lit(None)).cast("int").alias("bucket")
        return F.struct(F.lit(i).alias("rank"), key.isNull().alias("missing"), known, *fields)

    keys = F.array(*[identity(i, name, key) for i, (name, key) in enumerate(ranks.items())])
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    keyed = counted.filter("_n > 0").select(F.struct(*df.columns).alias("_row"), "_n", F.explode(keys).alias("_key"))
    # rows and values come from the same shuffle, as both need all columns and the count
    values = keyed.select("_key").distinct()
    known = values.withColumn("_bucket", F.col("_key.bucket")) if buckets else _in_quantiles(values, len(kinds))
    places = _places(known.select("_key", "_key.rank", F.when(F.col("_key.missing"), BUCKETS).otherwise(F.col("_bucket")).alias("_bucket")))
    places = places.withColumnRenamed("_key", "_ranked")
    found = keyed.join(places, F.col("_key") == F.col("_ranked"), "left").select("_row", "_n", "_key.rank", "_place", "_last")
    place = lambda i, column: F.max(F.when(F.col("rank") == i, F.col(column)))
    wanted = [place(i, "_place").alias(name) for i, name in enumerate(ranks)]
    wanted += [place(i, "_last").alias(f"{name}_last") for i, name in enumerate(ranks) if last]
    whole = found.groupBy("_row", "_n").agg(F.struct(*wanted).alias("_ranks"))
    some = whole.select("*", F.explode(F.sequence(F.lit(0), ((F.col("_n") - 1) / _REPEATS).cast("int"))).alias("_part"))
    left = F.least(F.lit(_REPEATS), F.col("_n") - F.col("_part") * _REPEATS).cast("int")
    return some.select("_row", "_ranks", F.explode(F.array_repeat(F.lit(1), left)).alias("_one")).select("_row.*", "_ranks.*")


def _in_quantiles(values: DataFrame, kinds: int) -> DataFrame:
    """With _bucket: which of BUCKETS ranges, of about as many values each, a value lies in."""
    size = F.coalesce(*[F.col(f"_key.k{j}").cast("double") for j in range(kinds)])
    parts = [i / BUCKETS for i in range(1, BUCKETS)]
    quantiles = values.groupBy("_key.rank").agg(F.percentile_approx(size, parts, 1000).alias("bounds"))
    bounds = quantiles.agg(F.map_from_entries(F.collect_list(F.struct("rank", "bounds")))).scalar()
    lower = F.filter(F.element_at("_bounds", F.col("_key.rank")), lambda b: b < size)
    return values.withColumn("_bounds", bounds).withColumn("_bucket", F.size(lower))


def _places(placed: DataFrame) -> DataFrame:
    """_key, _place and _last of distinct (_key, rank, _bucket)."""
    bucket = Window.partitionBy("rank", "_bucket")
    within = placed.select(
        "*", F.row_number().over(bucket.orderBy("_key")).alias("_within"), F.count(F.lit(1)).over(bucket).alias("_size")
    )
    kind, nothing = placed.schema["_key"].dataType, F.lit(0).cast("long")

    def entry(at: Column, key: Column, within: Column, below: Column, all_: Column) -> Column:
        parts = {"at": at, "_key": key, "_within": within, "below": below, "all": all_}
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    own = entry(F.col("_bucket"), F.col("_key"), F.col("_within"), nothing, nothing)
    none, size = F.lit(None), F.col("_size")
    told = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS)),
        lambda at: entry(at, none.cast(kind), none.cast("int"), F.when(at > F.col("_bucket"), size).otherwise(nothing), size),
    )
    entries = F.when(F.col("_within") == 1, F.concat(F.array(own), told)).otherwise(F.array(own))
    spread = within.select("rank", F.explode(entries).alias("e")).select("rank", "e.*")
    there = Window.partitionBy("rank", "at")
    summed = spread.select("_key", "_within", F.sum("below").over(there).alias("below"), F.sum("all").over(there).alias("all"))
    place = (F.col("below") + F.col("_within")).cast("int").alias("_place")
    return summed.filter(F.col("_key").isNotNull()).select("_key", place, F.col("all").cast("int").alias("_last"))


def unpivot_metrics(df: DataFrame, by: str, labels: Mapping[str, str] = settings.METRIC_LABELS) -> DataFrame:
    """One row per metric of each row, with the metric's label."""
    metrics = [F.col(m).cast("double").alias(m) for m in labels]
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return (
        df.select(by, *metrics)
        .unpivot(by, list(labels), "metric", "metric_value")
        .withColumn("metric_display", F.create_map(*pairs)[F.col("metric")])
    )


def minmax_score(df: DataFrame, by: str, value: str, name: str, inverted: Sequence[str] = ()) -> DataFrame:
    """Place of each value between its group's least and greatest, 0 to 1.

    A group without spread scores the neutral value throughout; groups in ``inverted`` count down.
    Rows without a group form one of their own. The bounds are joined as Spark's measured sizes suggest.
    """
    bounds = df.groupBy(by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    spread = F.col("_high") - F.col("_low")
    flat = F.coalesce(spread == 0, F.lit(True))
    score = F.when(flat, F.lit(settings.NEUTRAL_SCORE)).otherwise((F.col(value) - F.col("_low")) / spread)
    if inverted:
        score = F.when(F.col(by).isin(list(inverted)), 1 - score).otherwise(score)
    bounds = bounds.withColumnRenamed(by, "_by")
    return df.join(bounds, F.col(by).eqNullSafe(F.col("_by")), "left").withColumn(name, score).drop("_by", "_low", "_high")
