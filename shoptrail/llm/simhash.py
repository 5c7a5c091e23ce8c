"""SimHash near-duplicates, searched with pivot distance tables.

Reference fingerprints (pivots) serve twice. Against the zero fingerprint, 32 pivots of two bits each
measure how many bits a fingerprint has in each pair of bits. Two fingerprints that differ in at most
d bits differ in at most d of these 32 measures; with the measures in d + 4 groups at least four
groups agree, so equal measures in some four groups are the key by which candidates meet. Against
the pseudo-random pivots the distances of a pair differ by at most d (triangle inequality): pairs
with a larger coordinate difference are discarded, and the bits of the survivors are compared.

Fingerprints are reduced to distinct ones first, so copies of one text never meet each other, and no
key holds more than the few fingerprints that agree in two thirds of their bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import per_text, stage
from shoptrail.llm.components import components

SEED = 42
SHINGLE = 3
_SPACE = bytes(range(9, 14)) + b" "
_UPPER = bytes(range(0x41, 0x5B))
_TABLE = bytes.maketrans(_UPPER + _SPACE, _UPPER.lower() + b" " * len(_SPACE))
_BLOCK = 1 << 16
#: Pseudo-random reference fingerprints whose distances are compared before the bits are.
PIVOTS = tuple(xxhash.xxh64_intdigest(b"pivot %d" % i) for i in range(7))
#: Groups of measures that must agree.
AGREE = 4


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """SimHash of word shingles, repeats included; zero for a text without words."""
    words = text.encode().translate(_TABLE).split()
    if not words:
        return 0
    shingles = words if size == 1 else map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):  # bounds the unpacked bits
        part = hashes[at : at + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _distance(column: str, pivot: int) -> Column:
    return F.bit_count(F.col(column).bitwiseXOR(F.lit(_signed(pivot)))).cast("long")


def pivot_table(prints: DataFrame, within: int, column: str = "fp") -> DataFrame:
    """``prints`` with ``keys``, from the two-bit pivots, and ``far``, the distances to the others.

    The distance to a two-bit pivot is ones(f) + 2 - 2 * (bits that f has in that pair), ones(f) being the
    distance to zero. ``pairs`` holds these 32 numbers of bits, two binary digits each, which give the distances and
    are given by them. ``far`` holds the seven other distances, one byte each.
    """
    groups = within + AGREE
    low, high = (c.bitwiseAND(F.lit(0x5555555555555555)) for c in (F.col(column), F.shiftrightunsigned(column, 1)))
    pairs = F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))
    masks = [_signed(sum(3 << 2 * i for i in range(32) if i % groups in some)) for some in combinations(range(groups), AGREE)]
    keys = [F.xxhash64(F.lit(n), F.col("pairs").bitwiseAND(F.lit(mask))) for n, mask in enumerate(masks)]
    far = sum((F.shiftleft(_distance(column, p), 8 * i) for i, p in enumerate(PIVOTS)), F.lit(0).cast("long"))
    return prints.withColumn("pairs", pairs).withColumns({"keys": F.array(*keys), "far": far})


def links(prints: DataFrame, within: int) -> DataFrame:
    """Pairs (left, right), left < right as signed numbers, of fingerprints that differ in 1 to ``within`` bits.

    ``prints`` has a column ``fp`` of distinct fingerprints.
    """
    table = pivot_table(prints.select("fp"), within).select("fp", "far", F.explode("keys").alias("key"))
    left, right = table.select("key", F.col("fp").alias("left"), F.col("far").alias("far_left")), table.select("key", F.col("fp").alias("right"), F.col("far").alias("far_right"))
    coordinate = lambda c, i: F.shiftright(F.col(c), 8 * i).bitwiseAND(F.lit(255))
    near = F.greatest(*[F.abs(coordinate("far_left", i) - coordinate("far_right", i)) for i in range(len(PIVOTS))]) <= within
    close = F.bit_count(F.col("left").bitwiseXOR(F.col("right"))) <= within
    # both tests are part of the join condition: pairs that fail them never become rows
    return left.join(right, (left["key"] == right["key"]) & (F.col("left") < F.col("right")) & near & close).select("left", "right").distinct()


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long."""
    return per_text(docs, keep, text, lambda: lambda texts: {"fp": [_signed(fingerprint(t, size)) for t in texts]}, "fp long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", within: int = 2, size: int = SHINGLE) -> DataFrame:
    """One row (id, fingerprint, component_id, n_links) for each row of ``docs``.

    component_id is the smallest id reachable over links, n_links the number of other distinct
    fingerprints within reach of this one's. Null, empty and blank texts have fingerprint zero and are
    linked as any other. A null id keeps its row and gives no component id unless its component has
    no other.
    """
    rows = stage(fingerprints(docs, [id_column], text, size), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min(id_column).alias("least"))
    pairs = stage(links(prints, within), "links")
    both = pairs.unionByName(pairs.select(F.col("right").alias("left"), F.col("left").alias("right")))
    degree = both.groupBy(F.col("left").alias("fp")).agg(F.count("*").alias("n_links"))
    tied = components(pairs, "left", "right").withColumnRenamed("node", "fp")
    known = prints.join(tied, "fp", "left").join(degree, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "component").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(known, "fp").select(id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", within: int = 2, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stand first in their component; of equal ids one row stays.

    Null, empty and blank texts are one group, as they have one fingerprint. Rows without an id cannot be told apart
    by it and all stay.
    """
    groups = near_duplicates(docs, id_column, text, within, size)
    kept = groups.groupBy("component_id").agg(F.min(id_column).alias("__kept")).where(F.col("__kept").isNotNull())
    first = docs.join(kept.select(F.col("__kept").alias(id_column)), id_column, "left_semi")
    return first.dropDuplicates([id_column]).select(*docs.columns).unionByName(docs.where(F.col(id_column).isNull()))
