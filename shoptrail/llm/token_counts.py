"""Token counts through a cache of digests.

A text is known by the digest of its normalised content and of the tokenizer's version. Counts that
the cache table has are joined; each other content is encoded once, however many rows hold it, and
its count is appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import per_text
from shoptrail.storage import finished_folders

#: Raised when normalisation or counting changes, so that older counts are no longer found.
RULES = "1"
CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of this module's rules."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + RULES.encode()).hexdigest()


def byte_level_ranks(spec: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks and special tokens of a plain byte-level BPE file; None if the file asks for more."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE"
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and all(not t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized"))
    )
    if not plain:
        return None
    # printable bytes stand for themselves, the others for code points from 256 on, in order
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    vocabulary = {bytes(byte_of[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
    # merges must be ranked as the ids are: then "lowest id first" merges in the same order
    last = -1
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        rank = model["vocab"].get(left + right, -1)
        if rank <= last:
            return None
        last = rank
    if len(vocabulary) != 256 + len(model["merges"]):
        return None
    return vocabulary, special


def make_counter(path: str, pattern: str | None = None):
    """A function from a list of texts to their token counts, as the file's library gives them.

    ``.model`` files go to sentencepiece, ``.json`` files to tokenizers. A plain byte-level BPE file
    is counted by tiktoken from the same vocabulary, which is several times faster and gives
    the same ids; its splitting ``pattern`` is needed for that.
    """
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
    if pattern:
        with open(path, encoding="utf-8") as file:
            plain = byte_level_ranks(json.load(file))
        if plain:
            import tiktoken

            encoding = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=plain[0], special_tokens=plain[1])
            whole = _library_counter(path)

            def count(text: str) -> int:
                try:
                    return len(encoding.encode(text, allowed_special="all"))
                except ValueError:  # a run that its splitting pattern cannot hold, such as a million spaces
                    return whole()([text])[0]

            return lambda texts: [count(t) for t in texts]
    return _library_counter(path)()


def _library_counter(path: str):
    """A function that gives the counter by tokenizers, made when first asked for."""
    made = []

    def get():
        if not made:
            made.append(_load_library_counter(path))
        return made[0]

    return get


def _load_library_counter(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Digest and count of each known content; a digest appended twice (a repeated run) counts once."""
    spark = docs.sparkSession
    found = finished_folders(spark, cache)
    table = spark.read.schema(CACHE_SCHEMA).parquet(cache) if found else spark.createDataFrame([], CACHE_SCHEMA)
    return table.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, keep: list[str], text: str = "text", pattern: str | None = None, limit: int = 512) -> DataFrame:
    """``keep``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) for each row of ``docs``.

    Null and empty texts have no bytes and no tokens. Repeated rows keep their number. A kept column named as one of the
    results gives way to it. ``cache`` is a
    folder of the shared store, made on first use; it only grows. The tokenizer's file must be at the
    same path on every machine, as installed packages are.
    """
    version = tokenizer_version(tokenizer)
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], content.alias("__text")).withColumn("__content", F.sha2("__text", 256))

    cached = read_cache(docs, cache, version).select(F.col("content").alias("__known"), F.col("n_tokens").alias("__tokens"))
    texts = rows.select("__content", "__text").join(cached, F.col("__known") == F.col("__content"), "left_anti")
    misses = texts.groupBy("__content").agg(F.first("__text").alias("text"))

    def make():
        count = make_counter(tokenizer, pattern)
        return lambda values: {"n_tokens": count(values)}

    counted = per_text(misses, ["__content"], "text", make, "n_tokens long")
    counted.select(F.col("__content").alias("content"), F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)

    others = [c for c in keep if c not in ("n_bytes", "n_tokens", "over_limit")]
    sizes = rows.select(*[F.col(f"`{c}`") for c in others], "__content", F.octet_length("__text").cast("long").alias("__bytes"))
    known = read_cache(docs, cache, version).select(F.col("content").alias("__known"), F.col("n_tokens").alias("__tokens"))
    held = sizes.join(known, F.col("__content") == F.col("__known"))
    return held.select(*[F.col(f"`{c}`") for c in others], F.col("__bytes").alias("n_bytes"), F.col("__tokens").alias("n_tokens"), (F.col("__tokens") > limit).alias("over_limit"))
