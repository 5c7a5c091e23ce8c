"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of words: the hash of the words at its positions ignores the others, so
a word that was substituted there does not hide a hit. Hashes of test items and of training texts
are joined. Around each hit, item and text are laid side by side, and the best stretch is scored: 1 for an
equal word, -1 for a different one. Stretches that reach the least score are overlaps.

Words are runs of letters and digits, lower-cased, and are compared by their 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import stage

#: Positions in the window that count: seven of twelve and of eleven words, and six of eight. Of passages of
#: 15 words with a tenth of them substituted, these find 98 in 100; of those with 30 words, all but a few in 10,000.
SEEDS = ((0, 1, 3, 4, 7, 10, 11), (0, 2, 3, 5, 8, 9, 10), (0, 1, 2, 4, 6, 7), (0, 2, 3, 5, 6, 7))
#: Items of up to so many words, in which a seed may not fit, are looked up as a whole.
SHORT = 11
MISMATCH = 1
#: Least score of an overlap; items of fewer words must reach 0.8 of their number.
LEAST = 10
#: Rows of a few numbers each up to which a side is broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 500_000


def word_hashes(text: str) -> Column:
    split = F.split(F.lower(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def _places(rows: DataFrame, words: str, masks: list[tuple[int, ...]]) -> DataFrame:
    """Rows of ``rows`` without ``words``, for each place and mask that fits in there: at, key.

    The array is laid beside itself, moved by one word each time, so that every exploded row holds its
    window as plain columns and no row carries the array.
    """
    width = max(max(m) for m in masks) + 1
    others = [c for c in rows.columns if c != words]
    moved = F.arrays_zip(*[F.slice(words, i + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{i}") for i in range(width)])
    windows = rows.select(*others, F.posexplode(moved).alias("at", "w"))
    keys = [F.when(F.col(f"w.w{max(m)}").isNotNull(), F.xxhash64(F.lit(n), *[F.col(f"w.w{i}") for i in m])) for n, m in enumerate(masks)]
    return windows.select(*others, "at", F.explode(F.array(*keys)).alias("key")).where(F.col("key").isNotNull())


def _bounded(table: DataFrame) -> DataFrame:
    """A staged table, to be broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def find_overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """Rows (doc id, item id, score, n_equal, n_item_words, first_word), one for each text and item that overlap.

    score is that of the best stretch, n_equal the equal words of that alignment, first_word the place of the
    item's first word in the text (negative if the item begins before it). Null and empty texts and
    items overlap with nothing, and rows without an id are left out; repeated rows of one id count as one.
    """
    tests = items.where(F.col(f"`{item_id}`").isNotNull()).select(F.col(f"`{item_id}`").alias("__item"), word_hashes(item_text).alias("__test"))
    tests = stage(tests.where(F.size("__test") > 0).distinct(), "test-items")
    short = sorted(r[0] for r in tests.where(F.size("__test") <= SHORT).select(F.size("__test")).distinct().collect())  # at most SHORT numbers
    masks = [*SEEDS, *(tuple(range(n)) for n in short)]
    seeds = stage(_places(tests, "__test", masks).select("key", "__item", F.col("at").alias("__test_at")).distinct(), "seeds")

    rows = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").alias("__doc"), F.col(f"`{text}`").alias("__text"))
    places = _places(rows.select("__doc", word_hashes("__text").alias("__words")), "__words", masks)
    hits = places.join(_bounded(seeds), "key").select("__doc", "__item", (F.col("at") - F.col("__test_at")).alias("shift"))
    hits = stage(hits.distinct(), "seed-hits")

    hit_texts = rows.join(_bounded(stage(hits.select("__doc").distinct(), "hit-texts")), "__doc", "left_semi")
    pairs = hit_texts.select("__doc", word_hashes("__text").alias("__words")).join(hits, "__doc").join(_bounded(tests), "__item")
    begin, before = F.greatest(F.col("shift"), F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    beside = F.slice("__words", begin + 1, F.size("__test"))
    equal = F.zip_with(F.slice("__test", before + 1, F.size("__test")), beside, lambda a, b: F.coalesce(a == b, F.lit(False)))
    laid = pairs.select("__doc", "__item", F.size("__test").alias("n_item_words"), "shift", equal.alias("__equal"))
    step = lambda e: F.when(e, 1).otherwise(-MISMATCH)
    best = F.aggregate(
        "__equal",
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("equal")),
        lambda a, e: F.struct(
            F.greatest(F.lit(0), a["now"] + step(e)).alias("now"),
            F.greatest(a["best"], a["now"] + step(e)).alias("best"),
            (a["equal"] + F.when(e, 1).otherwise(0)).alias("equal"),
        ),
    )
    scored = laid.select("__doc", "__item", "n_item_words", "shift", best.alias("b"))
    scored = scored.where(F.col("b.best") >= F.least(F.lit(LEAST), F.ceil(F.col("n_item_words") * 0.8)))
    top = scored.groupBy("__doc", "__item").agg(F.max(F.struct(F.col("b.best").alias("score"), F.col("b.equal").alias("n_equal"), (-F.col("shift")).alias("back"), "n_item_words")).alias("t"))
    return top.select(
        F.col("__doc").alias(doc_id),
        F.col("__item").alias(item_id),
        F.col("t.score").cast("long").alias("score"),
        F.col("t.n_equal").cast("long").alias("n_equal"),
        F.col("t.n_item_words").cast("long").alias("n_item_words"),
        (-F.col("t.back")).cast("long").alias("first_word"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has no overlap; a null id never has one."""
    found = find_overlaps(docs, items, text=text, doc_id=doc_id).select(F.col(doc_id)).distinct()
    return docs.join(found, doc_id, "left_anti").select(*docs.columns)
