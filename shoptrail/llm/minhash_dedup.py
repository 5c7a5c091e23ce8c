"""MinHash near-duplicates: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

1. A text's set holds the 64-bit hashes of its different word shingles. Texts of one set are reduced to one row.
2. Universal hash functions h(x) = (a x + b mod 2^64) >> 32 give 128 minima, dealt to 32 bands of four; the
   lowest four bits of each minimum are the signature.
3. Sets that agree in a band are in one bucket. In each bucket all meet its first set, then one drawn by a
   hash, which differs from bucket to bucket, unless they are already known to belong together.
4. Sets of buckets that still hold several components go through an exact prefix filter: in order of frequency, rare
   shingles first, two similar sets share one of the first shingles of each, and their places bound what else they can
   share. A hot bucket is thus told apart by what its sets do not have in common.
5. Candidates pass if sizes and signatures allow the similarity; it is then confirmed on the full sets.
6. Components come from alternating large-star and small-star steps.

A pair of similarity 0.8 agrees in no band with chance 5e-8, and its signatures fail with chance 2e-8; nothing else can lose a
pair. In a bucket a set meets two others; a prefix joins only sets of different components.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import per_text, stage
from shoptrail.llm.components import components
from shoptrail.llm.prefix_filter import prefix_pairs

SHINGLE = 4
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 80
BANDS, ROWS = 32, 4
#: Of 128 parts of a signature, how many must agree: 104 are expected at 0.8, with a deviation of 4.4.
LEAST_EQUAL = 79
_BLOCK = 1 << 12
_SPACE = bytes(range(9, 14)) + b" "
_UPPER = bytes(range(0x41, 0x5B))
_TABLE = bytes.maketrans(_UPPER + _SPACE, _UPPER.lower() + b" " * len(_SPACE))


def _constants(label: bytes, n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"%s %d" % (label, i)) for i in range(n)], "<u8")


_A, _B = _constants(b"factor", BANDS * ROWS) | np.uint64(1), _constants(b"summand", BANDS * ROWS)
_PLACES = _constants(b"place", 16) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different word shingles; of fewer words, one of them all; without words, none."""
    words = text.encode().translate(_TABLE).split()
    if not words:
        return np.empty(0, "<u8")
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], "<u8")
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), "<u8", len(words))
    n = len(words) - size + 1
    return np.unique(_mixed(sum((hashes[i : i + n] * _PLACES[i] for i in range(size)), np.zeros(n, "<u8"))))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The 128 minima, 32 bits each, of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, "<u8")
    for at in range(0, len(hashes), _BLOCK):  # bounds the table of values
        np.minimum(least, (hashes[at : at + _BLOCK, None] * _A + _B).min(0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(least: np.ndarray) -> np.ndarray:
    """One hash per band, of its number and its minima."""
    pairs = least.view("<u8").reshape(BANDS, ROWS // 2)
    return _mixed((pairs * _PLACES[: ROWS // 2]).sum(1, dtype="<u8") + np.arange(BANDS, dtype="<u8") * _PLACES[8]).view("<i8")


def signature(least: np.ndarray) -> np.ndarray:
    """The lowest four bits of each minimum, sixteen to a long."""
    low = (least & np.uint32(15)).astype("<u8").reshape(-1, 16) << (np.arange(16, dtype="<u8") * np.uint64(4))
    return np.bitwise_or.reduce(low, axis=1).view("<i8")


def _described(texts: list[str], size: int) -> dict[str, list]:
    out: dict[str, list] = {"n_shingles": [], "d1": [], "d2": [], "keys": [], "sig": []}
    for text in texts:
        hashes = shingle_set(text, size)
        out["n_shingles"].append(len(hashes))
        if not len(hashes):
            for name in ("d1", "d2", "keys", "sig"):
                out[name].append(None)
            continue
        data = hashes.tobytes()
        least = minima(hashes)
        for name, value in (("d1", _signed(xxhash.xxh64_intdigest(data))), ("d2", _signed(xxhash.xxh64_intdigest(data, 1))), ("keys", band_keys(least)), ("sig", signature(least))):
            out[name].append(value)
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _held(texts: list[str], size: int) -> dict[str, list]:
    """Digests and full sets, for the confirmation."""
    sets = [shingle_set(t, size) for t in texts]
    data = [s.tobytes() for s in sets]
    return {"d1": [_signed(xxhash.xxh64_intdigest(d)) for d in data], "d2": [_signed(xxhash.xxh64_intdigest(d, 1)) for d in data], "hashes": [s.view("<i8") for s in sets]}


def _may_be_similar(n_a: str, n_b: str, sig_a: str, sig_b: str) -> Column:
    """Sizes that allow the similarity (a bound), and enough equal parts of the signatures."""
    unequal = F.lit(0)
    for i in range(BANDS * ROWS // 16):
        x = F.get(sig_a, F.lit(i)).bitwiseXOR(F.get(sig_b, F.lit(i)))
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        folded = folded.bitwiseOR(F.shiftrightunsigned(folded, 1)).bitwiseAND(F.lit(0x1111111111111111))
        unequal = unequal + F.bit_count(folded)
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT
    return sizes & (unequal <= BANDS * ROWS - LEAST_EQUAL)


class _Search:
    """The links of one table of documents, found bucket by bucket."""

    def __init__(self, docs: DataFrame, id_column: str, text: str, size: int):
        self.size = size
        self.plain = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
        described = per_text(self.plain, ["__id"], "__text", lambda: lambda texts: _described(texts, size), "n_shingles long, d1 long, d2 long, keys array<long>, sig array<long>")
        self.rows = stage(described, "minhash-rows")
        # what is the same in all copies of a set is taken from any of them
        once = self.rows.where("d1 is not null and __id is not null").groupBy("d1", "d2").agg(
            F.min("__id").alias("doc"), F.any_value("n_shingles").alias("n"), F.any_value("keys").alias("keys"), F.any_value("sig").alias("sig")
        )
        self.sets = stage(once.select(F.monotonically_increasing_id().alias("lid"), "*"), "minhash-sets")
        self.links: DataFrame | None = None
        self.tied: DataFrame | None = None

    def confirm(self, pairs: DataFrame) -> bool:
        """Adds the links among pairs (a, b) of lids, and brings the components up to date; False if there is none."""
        left, right = (self.sets.select(F.col("lid").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "ab")
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        close = ordered.join(left, "a").join(right, "b").where(_may_be_similar("n_a", "n_b", "sig_a", "sig_b"))
        close = stage(close.select("a", "b"), "minhash-close")
        if close.isEmpty():
            return False
        full = self.full_sets(close.select(F.explode(F.array("a", "b")).alias("lid")))
        one, two = (full.select(F.col("lid").alias(c), F.struct("doc", "lid").alias(f"node_{c}"), F.col("hashes").alias(f"x_{c}")) for c in "ab")
        both = close.join(one, "a").join(two, "b").select("node_a", "node_b", F.size(F.array_intersect("x_a", "x_b")).alias("common"), (F.size("x_a") + F.size("x_b")).alias("sizes"))
        found = stage(both.where(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * PERCENT).select("node_a", "node_b"), "minhash-links")
        if found.isEmpty():
            return False
        self.links = found if self.links is None else self.links.unionByName(found)
        self.tied = stage(components(self.links, "node_a", "node_b"), "minhash-components")
        return True

    def full_sets(self, lids: DataFrame) -> DataFrame:
        """Staged rows (lid, doc, hashes) of the sets in column ``lid``, made anew from their texts."""
        wanted = stage(self.sets.select("lid", "doc", "d1", "d2").join(lids.distinct(), "lid"), "minhash-wanted")
        some = self.plain.join(wanted.select(F.col("doc").alias("__id")).distinct(), "__id", "left_semi")
        size = self.size
        full = per_text(some, ["__id"], "__text", lambda: lambda texts: _held(texts, size), "d1 long, d2 long, hashes array<long>")
        full = full.join(wanted, (full["__id"] == wanted["doc"]) & (full["d1"] == wanted["d1"]) & (full["d2"] == wanted["d2"])).select("lid", "doc", "hashes")
        return stage(full.dropDuplicates(["lid"]), "minhash-full")

    def with_components(self, lids: DataFrame) -> DataFrame:
        """``lids`` with the component each belongs to so far."""
        if self.tied is None:
            return lids.withColumn("component", F.col("lid"))
        of = self.tied.select(F.col("node.lid").alias("lid"), F.col("component.lid").alias("component"))
        return lids.join(of, "lid", "left").withColumn("component", F.coalesce("component", "lid"))

    def split(self, members: DataFrame) -> DataFrame:
        """Rows (key, lid, component) of buckets that hold more than one component."""
        known = self.with_components(members.select("key", "lid"))
        several = known.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
        return stage(known.join(stage(several, "minhash-split-keys"), "key"), "minhash-buckets")

    def meet_one(self, members: DataFrame, order: Column) -> DataFrame:
        """Pairs of each bucket's first member in ``order`` with its members in other components."""
        first = stage(members.groupBy("key").agg(F.min_by(F.struct("lid", "component"), order).alias("f")).select("key", F.col("f.lid").alias("a"), F.col("f.component").alias("of")), "minhash-firsts")
        return members.join(first, "key").where(F.col("component") != F.col("of")).select("a", F.col("lid").alias("b"))

    def run(self) -> None:
        members = self.split(self.sets.select(F.explode("keys").alias("key"), "lid"))
        for order in (F.col("lid"), F.xxhash64("key", "lid")):
            if self.confirm(self.meet_one(members, order)):
                members = self.split(members)
        left = stage(members.select("lid").distinct(), "minhash-left")
        if not left.isEmpty():
            self.confirm(self.meet_by_prefix(left))

    def meet_by_prefix(self, lids: DataFrame) -> DataFrame:
        """Pairs (a, b) of different components among ``lids``, with all that are similar."""
        full = self.full_sets(lids)
        return prefix_pairs(full.select("lid", F.size("hashes").alias("n"), F.explode("hashes").alias("element")), self.with_components, PERCENT)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row (id, n_shingles, component_id, kept) for each row of ``docs``; component_id is the smallest id reachable over links.

    Null, empty and blank texts have no shingles: they are linked with nothing and are their own component. Rows that
    repeat an id are judged each by its own text. A row without an id takes part in no link; its component_id is null
    and it is kept.
    """
    search = _Search(docs, id_column, text, size)
    search.run()
    if search.tied is None:
        nodes = search.sets.select("d1", "d2", F.col("doc").alias("component_id"))
    else:
        of = search.tied.select(F.col("node.lid").alias("lid"), F.col("component.doc").alias("least"))
        nodes = search.sets.select("lid", "d1", "d2", "doc").join(of, "lid", "left").select("d1", "d2", F.coalesce("least", "doc").alias("component_id"))
    nodes = stage(nodes, "minhash-nodes").withColumnsRenamed({"d1": "e1", "d2": "e2"})
    named = F.col("__id").isNotNull() & F.col("d1").isNotNull()
    joined = search.rows.join(nodes, named & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    tied = F.when(F.col("__id").isNotNull(), F.coalesce("component_id", "__id"))
    return joined.select(
        F.col("__id").alias(id_column), "n_shingles", tied.alias("component_id"), F.coalesce(tied == F.col("__id"), F.lit(True)).alias("kept")
    )


SQL = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS d, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT d, unnest(CASE WHEN len(w) < 4 THEN [w] ELSE list_transform(range(1, len(w) - 2), lambda i: w[i : i + 3]) END) AS s
    FROM words WHERE len(w) > 0
), sizes AS (SELECT d, count(*) AS n FROM shingles GROUP BY d
), common AS (
    SELECT a.d AS x, b.d AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.d < b.d GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes p ON p.d = x JOIN sizes q ON q.d = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(d, other) AS (
    SELECT d, d FROM words
    UNION SELECT reached.d, both_ways.y FROM reached JOIN both_ways ON both_ways.x = reached.other
), smallest AS (
    SELECT reached.d, min(o.doc_id) AS component_id FROM reached JOIN words o ON o.d = reached.other GROUP BY reached.d
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM words JOIN smallest USING (d) LEFT JOIN sizes USING (d)
"""
