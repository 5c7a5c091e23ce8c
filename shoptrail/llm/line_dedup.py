r"""Line dedup: fuzzy equal lines are found over all texts, and one line of each group stays.

1. Lines (split at ``\n``; lower-cased, white space at the ends trimmed) are numbered and written once.
2. All of a line's character shingles are hashed, row by row in generated code, and fall into 21 bins. The least hash of each bin,
   kept while equal lines are combined, is the signature; an empty bin takes that of the next one.
3. A band is three bins, for lines of few shingles two. Lines that agree in one of seven bands (few: 21) are candidates. In each band's group the
   first line meets all others; pairs whose sizes and parity sketches rule the similarity out are dropped.
   The Jaccard similarity of the full shingle sets of the others is computed exactly; pairs of 0.8 or more are links.
4. In small groups lines without a link to the first one meet all others in the same way. In larger groups they
   meet two drawn ones, others in each band. What this leaves in several components there meets by the prefix filter: pairs that
   no common rare shingle joins are too far apart, so a crowded band is never compared with itself.
5. Union-find gives the components. The first line in order of document and place stays.

Two sets of similarity J have the same minimum with chance J, and agree in a band of three with
about J ** 3: of pairs with J = 0.8 seven bands find 99 %, of more similar ones more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import stage
from shoptrail.llm.components import components
from shoptrail.llm.prefix_filter import prefix_pairs

SHINGLE = 8
BANDS, ROWS = 7, 3
BINS = BANDS * ROWS
LEAST = 0.8
#: Lines with up to ``FEW`` bins of their own meet in bands of two, those with ``MANY`` or more in bands of three, those with ``TINY`` or less
#: in twice as many bands of two: so few hashes soon stand in for each other.
TINY, MANY, FEW = 6, 10, 13
#: Longs of a parity sketch.
SKETCH = 8
#: Lines of a band up to which those not linked to its first one meet all directly; of a larger one, by the prefix filter.
DIRECT = 32
#: Lines drawn from a larger band that its others meet, before the prefix filter.
DRAWN = 2


def shingles(line: Column) -> Column:
    """The hashes of all shingles of ``line``; a short line is one shingle.

    Characters take four bytes each, so any place is found at once. The bytes are bound as the variable of an
    outer function: a column of binary type would be copied for each shingle.
    """
    each = lambda w: F.transform(places(w), lambda i: F.xxhash64(F.substring(w, i, F.lit(4 * SHINGLE))))
    return F.get(F.transform(F.array(F.encode(line, "UTF-32")), each), F.lit(0))


def places(wide: Column) -> Column:
    """Where the shingles of a line begin, whose characters take four bytes each."""
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(wide) - (4 * SHINGLE - 1)), F.lit(4))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """Rows (lid, hashes), to be exploded by ``explode_outer``: ``explode`` would test for empty sets first, and make each set twice."""
    return texts.select("lid", F.array_distinct(shingles(F.col("line"))).alias("hashes"))


def sketches(texts: DataFrame) -> DataFrame:
    """Staged rows (lid, n, p): size and parity sketch of the lines' shingle sets.

    A bit of the sketch is the parity of the number of hashes that fall to it: sets that differ in d hashes differ in at most d bits.
    """
    each = shingle_sets(texts).select("lid", F.explode_outer("hashes").alias("h"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("h", 1).bitwiseAND(F.lit(63)).cast("int"))
    each = each.select("lid", bit.alias("bit"), F.shiftright("h", 7).bitwiseAND(F.lit(SKETCH - 1)).alias("part"))
    parts = [F.expr(f"bit_xor(bit) FILTER (WHERE part = {i})").alias(f"p{i}") for i in range(SKETCH)]
    summed = each.groupBy("lid").agg(F.count("*").alias("n"), *parts)
    return stage(summed.select("lid", "n", F.array(*[F.coalesce(f"p{i}", F.lit(0).cast("long")) for i in range(SKETCH)]).alias("p")), "sketches")


def may_be_similar() -> Column:
    """False only for pairs (n_a, p_a), (n_b, p_b) below ``LEAST``: J >= 0.8 leaves at most a ninth of n_a + n_b hashes to one side only."""
    apart = sum((F.bit_count(F.get("p_a", F.lit(i)).bitwiseXOR(F.get("p_b", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    return (F.least("n_a", "n_b") >= LEAST * F.greatest("n_a", "n_b")) & (apart * (1 + LEAST) <= (1 - LEAST) * (F.col("n_a") + F.col("n_b")) + 1e-6)


def split_lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows (doc, at, line, d1, d2) of the lines that hold anything but white space; d1, d2: their digest."""
    lines = docs.where(F.col(f"`{id_column}`").isNotNull()).select(F.col(f"`{id_column}`").alias("doc"), F.posexplode(F.split(F.col(f"`{text}`").cast("string"), "\n")).alias("at", "raw"))
    lines = lines.select("doc", "at", F.btrim("raw", F.lit(" \t\r\x0b\x0c")).alias("raw")).where("raw <> ''")
    return lines.select("doc", "at", F.lower("raw").alias("line")).select("*", F.xxhash64("line").alias("d1"), F.xxhash64(F.lit(1), "line").alias("d2"))


def occurrences(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Staged rows (oid, doc, at, line, d1, d2): the lines of ``split_lines``, numbered."""
    return stage(split_lines(docs, id_column, text).select(F.monotonically_increasing_id().alias("oid"), "*"), "occurrences")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Staged rows (d1, d2, lid, repeated, keys): each line once, with the least number of its occurrences and the keys of its bands.

    Shingles are rows that only exist inside a task's generated code. No text is shuffled: minima are combined in the tasks, by digest.
    """
    wide = lines.select("oid", "d1", "d2", F.encode("line", "UTF-32").alias("w"))
    each = wide.select("oid", "d1", "d2", "w", F.explode(places(F.col("w"))).alias("i"))
    hashed = each.select("oid", "d1", "d2", F.xxhash64(F.substring("w", F.col("i"), F.lit(4 * SHINGLE))).alias("h"))
    binned = hashed.withColumn("bin", F.col("h").bitwiseAND(F.lit(2**31 - 1)).cast("int") % BINS)
    least = [F.expr(f"min(h) FILTER (WHERE bin = {b})").alias(f"m{b}") for b in range(BINS)]
    once = binned.groupBy("d1", "d2").agg(F.min("oid").alias("lid"), F.max("oid").alias("last"), *least)
    mask = sum((F.when(F.col(f"m{b}").isNull(), 0).otherwise(1 << b) for b in range(BINS)), F.lit(0))
    known = ["d1", "d2", "lid", (F.col("lid") < F.col("last")).alias("repeated")]
    held = once.select(*known, mask.alias("mask"), F.array(*[f"m{b}" for b in range(BINS)]).alias("bins"))
    own = F.bit_count("mask")
    held = held.select("d1", "d2", "lid", "repeated", "mask", own.alias("own"), F.when(own == BINS, F.col("bins")).otherwise(F.filter("bins", lambda h: h.isNotNull())).alias("hashes"))

    def nth(band: Column) -> Column:
        """The first own hash from a bin on: as many own ones lie before it as there are bits below in the mask."""
        below = F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), band) - 1)
        return F.get("hashes", F.bit_count(below) % F.col("own"))

    def pairs(apart: int) -> Column:
        both = lambda b: (nth(b), nth((b + apart) % BINS))
        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.xxhash64(F.lit(-1), F.least(*both(b)), F.greatest(*both(b))))

    many = F.array(*[F.xxhash64(F.lit(b), *[nth(F.lit(b + r * BANDS)) for r in range(ROWS)]) for b in range(BANDS)])
    # lines within LEAST of each other have one kind of bands in common
    kinds = ((F.col("own") >= MANY, many), (F.col("own") <= FEW, pairs(BANDS)), (F.col("own") <= TINY, pairs(BANDS // 2 + 1)))
    keys = F.concat(*[F.when(some, bands).otherwise(F.array().cast("array<bigint>")) for some, bands in kinds])
    return stage(held.select("d1", "d2", "lid", "repeated", F.array_distinct(keys).alias("keys")), "lines")


def band_members(table: DataFrame) -> DataFrame:
    """Staged rows (key, rep, lid) of the lines in bands of two lines or more; rep is a band's least lid."""
    rows = table.select("lid", F.explode("keys").alias("key"))
    # counted inside the tasks first, and joined: a band of any size is a large key of a join, which adaptive execution splits
    several = rows.groupBy("key").agg(F.min("lid").alias("rep"), F.max("lid").alias("last")).where("rep < last").select("key", "rep")
    return stage(rows.join(stage(several, "band-firsts"), "key"), "band-members")


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Staged links (a, b), a < b: the pairs (a, b, sizes) of lids whose lines have a Jaccard similarity of ``LEAST`` or more; sizes: of both sets."""
    left, right = ends(texts, ["line"])
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sizes").distinct().join(left, "a").join(right, "b")
    # an intersection holds each hash once, however often the lines do
    shared = both.select("a", "b", "sizes", F.size(F.array_intersect(shingles(F.col("line_a")), shingles(F.col("line_b")))).alias("common"))
    percent = round(100 * LEAST)  # named once in the test, the intersection is made once
    return stage(shared.where(F.col("common") * (100 + percent) >= F.col("sizes") * percent).select("a", "b"), "line-links")


def split_bands(members: DataFrame, links: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Staged rows (key, lid) of the bands that ``links`` leave in several components, and what adds the component to rows with a lid."""
    tied = stage(components(links, "a", "b").withColumnRenamed("node", "lid"), "line-components")

    def tie(rows: DataFrame) -> DataFrame:
        return rows.join(tied, "lid", "left").withColumn("component", F.coalesce("component", "lid"))

    known = tie(members.select("key", "lid"))
    bands = known.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    return stage(members.select("key", "lid").join(bands, "key", "left_semi"), "lines-left"), tie


def ends(rows: DataFrame, columns: list[str]) -> list[DataFrame]:
    """``rows`` as the two ends a and b of pairs: the lid named so, the other columns with that ending."""
    return [rows.select(F.col("lid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in columns]) for c in ("a", "b")]


def hopeful(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (a, b, sizes) of those pairs (a, b), each once, that may be similar by what is ``known`` of their lines; sizes: of both sets."""
    one, two = ends(known, ["n", "p"])
    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return once.join(one, "a").join(two, "b").where(may_be_similar()).select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"))


def unlinked(members: DataFrame, links: DataFrame) -> DataFrame:
    """Staged rows (key, lid, off, lines) of the bands that hold lines without a link to the first one (off), without that one; lines: how many it has."""
    star = links.select(F.col("a").alias("rep"), F.col("b").alias("lid"), F.lit(False).alias("off"))
    rows = members.where("lid <> rep").join(star, ["rep", "lid"], "left").select("key", "lid", F.coalesce("off", F.lit(True)).alias("off"))
    bands = rows.groupBy("key").agg((F.count("*") + 1).alias("lines"), F.max("off").alias("any")).where("any and lines > 2").select("key", "lines")
    return stage(rows.join(bands, "key"), "lines-unlinked")


def meet_drawn(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of lines drawn from each band's unlinked ones, another in each turn, with the band's other lines."""
    turns = [F.min_by("lid", F.xxhash64(F.lit(t), "key", "lid")).alias(f"d{t}") for t in range(DRAWN)]
    drawn = rows.where("off").groupBy("key").agg(*turns).select("key", F.explode(F.array_distinct(F.array(*[f"d{t}" for t in range(DRAWN)]))).alias("a"))
    return rows.join(drawn, "key").where("lid <> a").select("a", F.col("lid").alias("b"))


def line_links(table: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between distinct lines, enough to tie all that are similar, and staged rows (lid, line, d1, d2) of all that may have one."""
    members = band_members(table)
    texts = stage(lines.withColumnRenamed("oid", "lid").join(members.select("lid").distinct(), "lid", "left_semi").select("lid", "line", "d1", "d2"), "candidate-lines")
    known = sketches(texts)
    links = similar(hopeful(members.where("lid <> rep").select(F.col("rep").alias("a"), F.col("lid").alias("b")), known), texts)
    left = unlinked(members, links)
    small = left.where(F.col("lines") <= DIRECT).join(known, "lid")
    one, two = ends(small, ["key", "off", "n", "p"])
    # the tests are part of the join's condition: pairs that fail them never become rows
    met = (F.col("key_a") == F.col("key_b")) & F.col("off_a") & (F.col("a") != F.col("b")) & (~F.col("off_b") | (F.col("a") < F.col("b"))) & may_be_similar()
    direct = one.join(two, met).select("a", "b", (F.col("n_a") + F.col("n_b")).alias("sizes"))
    crowd = left.where(F.col("lines") > DIRECT)
    links = links.unionByName(similar(direct.unionByName(hopeful(meet_drawn(crowd), known)), texts))
    if crowd.isEmpty():
        return links, texts
    crowd, tie = split_bands(members.join(crowd.select("key").distinct(), "key", "left_semi"), links)
    if crowd.isEmpty():
        return links, texts
    sets = shingle_sets(texts.join(crowd.select("lid").distinct(), "lid", "left_semi"))
    pairs = prefix_pairs(sets.select("lid", F.size("hashes").alias("n"), F.explode_outer("hashes").alias("element")), tie, round(100 * LEAST), known, may_be_similar())
    return links.unionByName(similar(hopeful(pairs, known), texts)), texts


def grouped_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged rows (doc, at, group): the occurrences of all lines that are repeated or have similar lines."""
    lines = occurrences(docs, id_column, text)
    table = distinct_lines(lines)
    links, texts = line_links(table, lines)
    tied = stage(components(links, "a", "b").select(F.col("node").alias("lid"), F.col("component").alias("group")), "line-components")
    alone = table.where("repeated").join(tied, "lid", "left_anti").select("d1", "d2", F.col("lid").alias("group"))
    groups = texts.select("lid", "d1", "d2").join(tied, "lid").select("d1", "d2", "group").unionByName(alone)
    return stage(lines.select("doc", "at", "d1", "d2").join(groups, ["d1", "d2"]).select("doc", "at", "group"), "grouped-lines")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", count: str | None = "n_removed") -> DataFrame:
    r"""``docs`` with the lines of ``text`` that stay, and how many went as ``count`` (None: no such column).

    Lines of white space only stay where they are. A null text stays null, an empty one empty, and a
    text whose lines all stand elsewhere becomes empty. Rows with one id count as one document: what
    is kept of one is kept of all. Rows without an id keep all their lines. Other columns pass through.
    """
    rows = grouped_lines(docs, id_column, text)
    firsts = rows.groupBy("group").agg(F.min(F.struct("doc", "at")).alias("first"))
    gone = rows.join(firsts, "group").where((F.col("doc") != F.col("first.doc")) | (F.col("at") != F.col("first.at")))
    removed = gone.groupBy("doc").agg(F.collect_set("at").alias("__gone")).withColumnRenamed("doc", "__doc")
    joined = docs.join(removed, F.col(f"`{id_column}`") == F.col("__doc"), "left")
    kept = F.filter(F.split(F.col(f"`{text}`").cast("string"), "\n"), lambda line, i: ~F.array_contains("__gone", i))
    others = [F.when(F.col("__gone").isNull(), F.col(f"`{c}`")).otherwise(F.array_join(kept, "\n")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*others, *([F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias(count)] if count else []))
