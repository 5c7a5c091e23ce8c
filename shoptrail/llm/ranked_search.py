"""Ranked lexical search over all documents: an inverted index in shards, read by Block-Max MaxScore.

Index. Texts are dealt to shards of some megabytes as they are read. A shard has one row per term, whose postings
stand in blocks of 128: for each block its last document, its largest impact and its packed postings (gaps
between documents and frequencies, in the fewest bytes that hold the block's). One more row holds the shard's
document ids and lengths. The table is written once and grows with the text.

Search. A term's impact in a document, without the term's weight, is known when the index is built, as it
depends on the length of all texts only. For each query in each shard:

* The query's lists are put in order of weight times their largest impact. Lists at the low end whose bounds add up to less
  than the tenth best score so far cannot bring a document in: only documents of the other, essential lists are candidates.
* The essential lists are added up. Then each non-essential list, from the highest bound down: a candidate goes if its
  score, plus the maximum of the block it would stand in, plus the bounds of the lists still to come, is below the
  tenth best. Only blocks that hold a place of a candidate left are unpacked.

Candidates that can only equal the tenth best stay, as a smaller id wins ties. A task keeps its best ten
from shard to shard; the tasks' heaps are merged at the end. All scores are whole numbers and exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shoptrail.llm.common import delete_at_end, per_text, ship_code
from shoptrail.storage import new_folder

BLOCK = 128
#: Bytes of text after which a shard is closed.
SHARD_BYTES = 16 << 20
#: Queries searched for in one pass over the index; more are taken in as many passes as they need.
QUERIES_AT_ONCE = 20_000
BEST = 10
#: Rows of a shard that are handed on together.
ROWS_AT_ONCE = 50_000
#: Stands for a missing id inside the index; comes last among ties.
NO_ID = (1 << 63) - 1
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_UPPER = bytes(range(0x41, 0x5B))
_TABLE = bytes(b + 32 if b in _UPPER else b if b in _KEPT else 32 for b in range(256))
INDEX = "shard long, term string, n_docs long, top long, lasts binary, tops binary, ends binary, postings binary"
_DOCUMENTS = ""


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8: runs of letters and digits and of everything beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_TABLE).split()


def statistics(docs: DataFrame, text: str) -> tuple[int, int]:
    """Number of documents with a term, and of all their terms."""
    counted = per_text(docs, [], text, lambda: lambda texts: {"n": [len(terms_of(t)) for t in texts]}, "n long")
    return tuple(counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first())


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """A term's share of the score in documents of these lengths, without its weight."""
    m = 25 + (75 * n * length) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _widths(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each run of values, the fewest bytes of 1, 2 and 4 that hold them all."""
    most = np.maximum.reduceat(values, begins)
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _packed(columns: list[np.ndarray], begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All blocks as bytes, and where each ends: for each column a byte for the width, and the block's values in that width."""
    counts = np.diff(begins, append=len(columns[0]))
    widths = [_widths(c, begins) for c in columns]
    ends = np.cumsum(sum(1 + w * counts for w in widths))
    data = np.zeros(int(ends[-1]), np.uint8)
    at = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(columns[0])) - np.repeat(begins, counts)
    for values, width in zip(columns, widths, strict=True):
        data[at] = width
        each = np.repeat(width, counts)
        first = np.repeat(at + 1, counts) + place * each
        for byte in range(int(width.max())):
            held = each > byte
            data[first[held] + byte] = (values[held] >> 8 * byte) & 255
        at = at + 1 + width * counts
    return data, ends


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes cut at ``ends``, as a column."""
    cuts = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])


def _widened(data: bytes, at: int, count: int) -> tuple[np.ndarray, int]:
    width = data[at]
    return np.frombuffer(data, f"<u{width}", count, at + 1).astype(np.int64), at + 1 + width * count


class _Numbers(dict):
    """A number for each term, in order of first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


class _Shard:
    """Texts gathered until there are enough for a shard."""

    def __init__(self, n: int, total: int):
        self.n, self.total = n, total
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.occurrences: list[np.ndarray] = []
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.held = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        terms = terms_of(text or "")
        if not terms:
            return
        self.occurrences.append(np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms)))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(terms))
        self.held += len(text) + 64

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The shard's rows: its documents, then its terms. Everything is done for all terms at once."""
        if not self.ids:
            return
        lengths, size = np.array(self.lengths, np.int64), len(self.ids)
        documents = np.array(self.ids, "<i8").tobytes() + lengths.astype("<i8").tobytes()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "term": _DOCUMENTS, "n_docs": size, "postings": documents}], schema=_ARROW)
        docs = np.repeat(np.arange(size), lengths)
        pairs, tf = np.unique(np.concatenate(self.occurrences) * size + docs, return_counts=True)
        term, doc = pairs // size, pairs % size
        impact = impacts(tf, lengths[doc], self.n, self.total)
        lists = np.flatnonzero(np.diff(term, prepend=-1))
        counts = np.diff(lists, append=len(term))
        # a block begins with its list and at every BLOCK-th place in it
        blocks = np.flatnonzero((np.arange(len(term)) - np.repeat(lists, counts)) % BLOCK == 0)
        gaps = np.diff(doc, prepend=0)
        gaps[lists] = doc[lists] + 1
        data, ends = _packed([gaps, tf], blocks)
        last_block = np.searchsorted(blocks, lists + counts) - 1
        list_ends = ends[last_block]
        inside = ends - np.repeat(np.concatenate([[0], list_ends[:-1]]), np.diff(last_block, prepend=-1))
        lasts = doc[np.append(blocks[1:], len(term)) - 1]
        per_block = lambda values: _binaries(values.astype("<u4").view(np.uint8), 4 * (last_block + 1))
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(lists), shard)),
                pa.array(list(self.numbers), pa.binary()).cast(pa.string()),
                pa.array(counts),
                pa.array(np.maximum.reduceat(impact, lists)),
                per_block(lasts),
                per_block(np.maximum.reduceat(impact, blocks)),
                per_block(inside),
                _binaries(data, list_ends),
            ],
            schema=_ARROW,
        )
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


_ARROW = pa.schema(
    [("shard", pa.int64()), ("term", pa.string()), ("n_docs", pa.int64()), ("top", pa.int64())] + [(f, pa.binary()) for f in ("lasts", "tops", "ends", "postings")]
)


def build_index(docs: DataFrame, folder: str, id_column: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int, int]:
    """Writes the index of all texts to ``folder``; gives its table, N and L.

    Ids are whole numbers or null. A null, empty or termless text is no document. Each row is a document, so rows
    that repeat an id are found each. A shard's number is that of its task and its place in the task.
    """
    spark = docs.sparkSession
    ship_code(spark)
    n, total = statistics(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        shard, closed = _Shard(n, total), 0
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard.add(doc_id, value)
                if shard.held >= shard_bytes:
                    yield from shard.rows(first + closed)
                    shard.clear()
                    closed += 1
        yield from shard.rows(first + closed)

    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    plain.mapInArrow(run, INDEX).write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return spark.read.schema(INDEX).parquet(folder), n, total


def query_terms(queries: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (__query, __term, __times): the terms of each query, and how often they stand in it.

    Rows without an id or without terms ask nothing. A repeated row counts once; different texts of one id are one query.
    """
    asked = queries.where(F.col(f"`{id_column}`").isNotNull()).select(F.col(f"`{id_column}`").alias("__query"), F.col(f"`{text}`").cast("string").alias("__text")).distinct()
    split = per_text(asked, ["__query"], "__text", lambda: lambda texts: {"__terms": [[w.decode() for w in terms_of(t)] for t in texts]}, "__terms array<string>")
    return split.select("__query", F.explode("__terms").alias("__term")).groupBy("__query", "__term").agg(F.count("*").alias("__times"))


class _List:
    """One term's postings in one shard, unpacked block by block when asked for."""

    def __init__(self, row: tuple, m: np.ndarray):
        self.top, (lasts, tops, ends) = row[0], (np.frombuffer(b, "<u4").astype(np.int64) for b in row[1:4])
        self.lasts, self.tops, self.ends, self.data, self.m = lasts, tops, ends, row[4], m
        self.n_docs, self.unpacked = row[5], {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self.unpacked:
            count = min(BLOCK, self.n_docs - number * BLOCK)
            gaps, at = _widened(self.data, int(self.ends[number - 1]) if number else 0, count)
            tf, _ = _widened(self.data, at, count)
            docs = np.cumsum(gaps) + (self.lasts[number - 1] if number else -1)
            self.unpacked[number] = docs, (1_000_000_000 * tf) // (1000 * tf + 8 * self.m[docs])
        return self.unpacked[number]

    def blocks(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in numbers]
        return parts[0] if len(parts) == 1 else (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def search_shard(lists: list[tuple[int, _List]], size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard, and their scores, that reach ``least`` (at least 1); ``lists`` are (weight, list)."""
    lists = sorted(((w * one.top, w, one) for w, one in lists if w > 0), key=lambda x: x[0])
    bounds = np.cumsum([b for b, _, _ in lists])
    essential = int(np.searchsorted(bounds, least)) if lists else 0
    if essential == len(lists):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    scores = np.zeros(size, np.int64)
    for _, weight, one in lists[essential:]:
        docs, impact = one.blocks(range(len(one.lasts)))
        scores[docs] += weight * impact
    found = np.flatnonzero(scores)
    for i in range(essential - 1, -1, -1):
        _, weight, one = lists[i]
        below = bounds[i - 1] if i else 0
        found = found[scores[found] + bounds[i] >= least]
        at = np.searchsorted(one.lasts, found)
        inside = at < len(one.lasts)
        tops = np.where(inside, weight * one.tops[np.minimum(at, len(one.lasts) - 1)], 0)
        stays = scores[found] + tops + below >= least
        found, at = found[stays], at[stays & inside]
        if len(at):
            docs, impact = one.blocks(np.unique(at).tolist())
            place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            held = docs[place] == found
            scores[found[held]] += weight * impact[place[held]]
    found = found[scores[found] >= least]
    return found, scores[found]


def _best(held: list[tuple[int, int]], new: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(held + new)[:k]


def search(index: DataFrame, n: int, total: int, asked: DataFrame, id_column: str = "item_id", k: int = BEST) -> DataFrame:
    """Rows (id, rank, doc_id, score): the ``k`` best documents of each query, equal scores by ascending doc_id.

    ``asked`` are the rows of ``query_terms``. Queries are searched for in blocks of at most ``QUERIES_AT_ONCE``, dealt by a hash of their id; a
    block's terms and weights are what each task is sent.
    """
    kind = asked.schema["__query"].dataType
    # a query set is small beside the index: its lists are what is read of it
    n_queries = asked.select("__query").distinct().count()
    passes = max(1, -(-n_queries // QUERIES_AT_ONCE))
    found = None
    for turn in range(passes):
        some = asked if passes == 1 else asked.where(F.pmod(F.xxhash64("__query"), F.lit(passes)) == turn)
        best = _search_some(index, n, total, some, kind, k)
        found = best if found is None else found.unionByName(best)
    place = F.row_number().over(Window.partitionBy("__query").orderBy(F.desc("score"), F.asc("doc")))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select(F.col("__query").alias(id_column), "rank", F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "score")


def _search_some(index: DataFrame, n: int, total: int, asked: DataFrame, kind, k: int) -> DataFrame:
    terms = asked.select(F.col("__term").alias("term")).distinct()
    held = index.join(terms, "term", "left_semi")
    known = {r["term"]: r["df"] for r in held.groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    queries: dict = {}
    for row in asked.collect():
        if row["__term"] in known:
            weight = math.floor(1000 * math.log((2 * n + 2) / (2 * known[row["__term"]] + 1))) * row["__times"]
            queries.setdefault(row["__query"], []).append((row["__term"], weight))
    numbered = list(queries.items())
    fields = StructType([StructField("__query", kind), StructField("doc", LongType()), StructField("score", LongType())])
    if not numbered:
        return index.sparkSession.createDataFrame([], fields)
    sent = index.sparkSession.sparkContext.broadcast([lists for _, lists in numbered])

    def one_shard(rows: dict[str, tuple], heaps: dict[int, list[tuple[int, int]]]) -> None:
        *_, data, size = rows[_DOCUMENTS]
        ids, lengths = np.frombuffer(data, "<i8").reshape(2, size)
        m = 25 + (75 * n * lengths) // total
        lists = {t: _List(row, m) for t, row in rows.items() if t != _DOCUMENTS}
        for number, query in enumerate(sent.value):
            here = [(weight, lists[t]) for t, weight in query if t in lists]
            heap = heaps.get(number, [])
            docs, scores = search_shard(here, size, -heap[-1][0] if len(heap) == k else 1)
            if len(docs):
                if len(docs) > k:
                    first = np.lexsort((ids[docs], -scores))[:k]
                    docs, scores = docs[first], scores[first]
                heaps[number] = _best(heap, list(zip((-scores).tolist(), ids[docs].tolist(), strict=True)), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[int, int]]] = {}
        now, rows = None, {}
        for batch in batches:
            for shard, term, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now:
                    if rows:
                        one_shard(rows, heaps)
                    now, rows = shard, {}
                rows[term] = tuple(row)
        if rows:
            one_shard(rows, heaps)
        flat = [(number, -score, doc) for number, heap in heaps.items() for score, doc in heap]
        yield pa.RecordBatch.from_pydict({"number": [f[0] for f in flat], "doc": [f[2] for f in flat], "score": [f[1] for f in flat]}, schema=result)

    result = pa.schema([("number", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
    wanted = index.where(F.col("term") == _DOCUMENTS).unionByName(held).select("shard", "term", "top", "lasts", "tops", "ends", "postings", "n_docs")
    best = wanted.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "number long, doc long, score long")
    names = index.sparkSession.createDataFrame([(i, q) for i, (q, _) in enumerate(numbered)], StructType([StructField("number", LongType()), StructField("__query", kind)]))
    return best.join(names, "number").select("__query", "doc", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, id_column: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text", k: int = BEST) -> DataFrame:
    """The ``k`` best documents of each query, from an index written for this call to the shared folder."""
    spark: SparkSession = docs.sparkSession
    folder = new_folder(spark, "search-index")
    delete_at_end(spark, folder)
    index, n, total = build_index(docs, folder, id_column, text)
    return search(index, n, total, query_terms(queries, query_id, query_text), query_id, k)


SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), numbers AS (SELECT count(DISTINCT d) AS n_docs, count(*) AS n_terms FROM words
), lengths AS (SELECT d, count(*) AS n FROM words GROUP BY d
), counts AS (SELECT d, doc_id, term, count(*) AS tf FROM words GROUP BY d, doc_id, term
), frequencies AS (SELECT term, count(*) AS df FROM counts GROUP BY term
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), weights AS (
    SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) * count(*) AS w
    FROM asked JOIN frequencies USING (term) CROSS JOIN numbers GROUP BY item_id, term, df, n_docs
), scored AS (
    SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM weights JOIN counts USING (term) JOIN lengths USING (d) CROSS JOIN numbers GROUP BY item_id, d, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
