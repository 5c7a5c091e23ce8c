"""Exact candidates for set similarity by prefixes, for what banding has left open.

Elements are put in order of frequency, rare ones first. Two similar sets then share one of the first elements of each,
and the place at which they first agree bounds all they can share. Sets of a crowded band are thus told apart by
what they do not have in common, where comparing them all would grow with the square of the band.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import stage


def prefix_pairs(elements: DataFrame, tie: Callable[[DataFrame], DataFrame], percent: int = 80, sketches: DataFrame | None = None, allowed: Column | None = None) -> DataFrame:
    """Pairs (a, b) of lids in different components, with all whose Jaccard similarity is ``percent`` or more.

    ``elements`` are rows (lid, n, element), each element of a set once and n the set's size; ``tie`` adds a column component to
    rows with a lid. The place of an element in its set is by its frequency among these sets, then by itself. Sets of n and m elements that
    share s are similar only if s >= (n + m) * percent / (100 + percent); at their first common element, s is at most
    1 + what follows it in either. Elements of one set only count as places, and need no rows. Where an element's
    sets are of several components, those outside the largest one meet the others. ``sketches`` may add columns by lid, and
    ``allowed`` a test of a pair on them (with endings _a and _b): what fails it never becomes a row.
    """
    shared = stage(elements.groupBy("element").agg(F.count("*").alias("df")).where("df > 1"), "prefix-frequencies")
    inside = Window.partitionBy("lid")
    after = F.count("*").over(inside) - F.row_number().over(inside.orderBy("df", "element"))
    placed = elements.join(shared, "element").withColumn("after", after)
    # the last place at which a set of the least size that is similar can begin to agree
    prefix = placed.where(F.col("after") + 1 >= F.ceil(F.col("n") * percent / 100)).select("element", "lid", "n", "after")
    prefix = stage(tie(prefix), "prefixes")
    sizes = prefix.groupBy("element", "component").agg(F.count("*").alias("m")).groupBy("element").agg(F.max_by("component", "m").alias("largest"), F.count("*").alias("held"))
    several = stage(sizes.where("held > 1").select("element", "largest"), "prefix-keys")
    known = stage(prefix.join(several, "element"), "prefix-rows")
    more = [] if sketches is None else [c for c in sketches.columns if c not in known.columns]
    rows = known if sketches is None else known.join(sketches.select("lid", *more), "lid")
    left, right = (rows.select(F.col("element").alias(f"e_{c}"), F.col("lid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "after", "component", "largest", *more)]) for c in "ab")
    most = F.least("after_a", "after_b") + 1
    enough = (most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent) & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    # pairs outside the largest component meet from both sides; one of them is enough
    once = (F.col("component_b") == F.col("largest_b")) | (F.col("a") < F.col("b"))
    apart = (F.col("component_a") != F.col("component_b")) & once & enough & (F.lit(True) if allowed is None else allowed)
    return left.where("component_a <> largest_a").join(right, (F.col("e_a") == F.col("e_b")) & apart).select("a", "b")
