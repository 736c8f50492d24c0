"""Left joins of a wide frame whose rows are put in the order of a report, with one shuffle of the wide rows."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasediff.operators import joins
from phasediff.operators.joins import estimated_bytes
from phasediff.operators.ordering import presentation_sort
from phasediff.operators.skew import heavy_keys, skew_join

#: Rows of a place on average at most, and keys sampled for each place.
PLACE_ROWS = 250_000
PLACE_SAMPLES = 60

#: A right side and the columns it is joined on.
Right = tuple[DataFrame, list[str]]


def _order_key(order: list[str]) -> Column:
    """One value that sorts like the columns, NULLs last."""
    return F.struct(*[c for i, k in enumerate(order) for c in (F.isnull(k).alias(f"n{i}"), F.col(k).alias(f"k{i}"))])


def _bounds(df: DataFrame, order: list[str], rows: int, places: int) -> Column:
    """Ascending keys between places, from a seeded sample; a key of many rows stands in it more than once."""
    share = min(1.0, PLACE_SAMPLES * places / max(1, rows))
    sampled = df.select(_order_key(order).alias("key")).sample(share, seed=17)
    ranked = sampled.agg(F.array_sort(F.collect_list("key")).alias("keys"))
    at = (F.size("keys") * F.col("i") / places).cast("int")
    picked = ranked.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(places - 1))))
    chosen = picked.select(F.get("keys", at).alias("key")).agg(F.array_sort(F.collect_list("key")).alias("bounds"))
    return df.sparkSession.createDataFrame(chosen.collect(), chosen.schema).scalar()


def _with_places(df: DataFrame, order: list[str], bounds: Column, places: int) -> DataFrame:
    """`_from` and `_to`: the places whose range holds the row's key, more than one for a key that is a bound."""
    strides = F.array(*[F.lit(1 << e) for e in reversed(range(places.bit_length()))])

    def passed(below: Callable[[Column], Column]) -> Column:
        def step(at: Column, stride: Column) -> Column:
            return F.when(below(F.get("_bounds", at + stride - 1)), at + stride).otherwise(at)

        return F.reduce(strides, F.lit(0), step)

    keyed = df.withColumns({"_key": _order_key(order), "_bounds": bounds})
    lowest = keyed.withColumn("_from", passed(lambda b: b < F.col("_key")))
    on_bound = F.get("_bounds", F.col("_from")) == F.col("_key")
    highest = F.when(on_bound, passed(lambda b: b <= F.col("_key"))).otherwise(F.col("_from"))
    return lowest.withColumn("_to", highest).drop("_key", "_bounds")


def _packed(df: DataFrame, keys: set[str]) -> tuple[DataFrame, list[Column]]:
    """The frame with its long decimals in 8 bytes, but for the keys, and the columns that undo this.

    Spark moves and sorts a decimal of more than 18 digits in 24 bytes, however small it is. A row that has a
    larger value keeps all of its long decimals beside the short ones.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    long = [c for c, t in types.items() if isinstance(t, T.DecimalType) and t.precision > 18 >= t.scale]
    long = [c for c in long if c not in keys]
    if not long:
        return df, [F.col(c) for c in types]
    short = {c: F.col(c).try_cast(T.DecimalType(18, types[c].scale)) for c in long}
    lost = reduce(or_, [F.col(c).isNotNull() & value.isNull() for c, value in short.items()])
    packed = df.withColumns(short | {"_long": F.when(lost, F.struct(*long))})

    def full(c: str) -> Column:
        return F.when(F.col("_long").isNull(), F.col(c).cast(types[c])).otherwise(F.col(f"_long.{c}")).alias(c)

    return packed, [full(c) if c in long else F.col(c) for c in types]


def ordered_left_joins(left: DataFrame, rights: list[Right], order: list[str], cells: int | None = None) -> DataFrame:
    """Left joins that may fan out with every right side, in the order of a report, NULLs last.

    The rows of the left side are wide: a shuffle for each join and one more for the order would move them
    again and again. Here the order alone moves them. Its ranges, the places, are known before: from a sample,
    as in Spark's own sort. The keys of the left side meet the right sides without the other columns, and what
    they find is sent to the places that hold rows with such a key, where it is joined with these rows. Rows
    that tie may lie in any of the places of their key, so large groups of ties are spread over several.

    Right sides under the broadcast limit are broadcast. A key that has more than 1 / cells of the rows of a right
    side would fan out in few places; if there is one, the joins are `skew_join`s and all rows are sorted after
    them. The left side is read several times and should be stored. The keys of the first right side must be
    among those of the others. NULL keys match nothing.
    """
    spark = left.sparkSession
    sized = [(right, on, estimated_bytes(right)) for right, on in rights]
    large = [(r, on) for r, on, size in sized if size is None or size > joins.BROADCAST_LIMIT_BYTES]
    small = [(r, on) for r, on, size in sized if size is not None and size <= joins.BROADCAST_LIMIT_BYTES]
    columns = [*left.columns, *[c for right, on in rights for c in right.columns if c not in on]]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells or shuffles
    large = [(right.dropna(subset=on), on) for right, on in large]
    if not large or any(_has_hot_key(right, on, cells) for right, on in large):
        joined = left
        for right, on in rights:
            joined = skew_join(joined, right, on, cells=cells)
        return presentation_sort(joined.select(*columns), *order)

    common = large[0][1]
    rows, frequent = heavy_keys(left, common)
    places = max(2, shuffles, math.ceil(rows / PLACE_ROWS))
    bounds = _bounds(left, order, rows, places)
    placed = _with_places(left, order, bounds, places)

    on = list(dict.fromkeys(k for _, keys in large for k in keys))
    keys = placed.dropna(subset=common).select(*on, "_from", "_to")
    if max(frequent.values(), default=0) > max(1, rows // cells):
        keys = keys.distinct()  # a hot key would bring all its rows to one task
    keys = keys.repartition(shuffles, *common).distinct()
    found = keys.select(*on, F.explode(F.sequence("_from", "_to")).alias("_place")).distinct()
    met = F.lit(False)
    for i, (right, right_on) in enumerate(large):
        if i:
            right = right.repartition(shuffles, *common)
        found = found.join(right.withColumn(f"_met{i}", F.lit(True)), right_on, "left")
        met = met | F.coalesce(f"_met{i}", F.lit(False))
    gained = [c for right, right_on in large for c in right.columns if c not in right_on]
    sent = found.filter(met).select("_place", *on, *gained).repartitionById(places, "_place")

    spread = F.col("_from") + F.pmod(F.spark_partition_id(), F.col("_to") - F.col("_from") + 1)
    wide, unpacked = _packed(placed.withColumn("_place", spread).drop("_from", "_to"), {*order, *on})
    sent = sent.withColumnsRenamed({k: f"_r_{k}" for k in ("_place", *on)})
    same = [F.col(k) == F.col(f"_r_{k}") for k in ("_place", *common)]
    # a line that lacks a key of one right side may have matches in the others
    same += [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on if k not in common]
    joined = wide.repartitionById(places, "_place").join(sent, reduce(and_, same), "left")
    for right, right_on in small:
        joined = joined.join(F.broadcast(right), right_on, "left")
    ordered = joined.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in order])
    return ordered.select(*unpacked, *columns[len(left.columns) :]).drop("_place")


def _has_hot_key(df: DataFrame, on: list[str], cells: int) -> bool:
    rows, frequent = heavy_keys(df, on)
    return max(frequent.values(), default=0) > max(1, rows // cells)
