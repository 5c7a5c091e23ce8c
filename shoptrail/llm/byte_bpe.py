"""Byte-level BPE: texts to token ids and back, by a two-tier lookup.

Tier one is a minimal perfect hash of the vocabulary: a pre-token that is a whole entry gets its id
from one slot. Tier two merges the bytes of the other pre-tokens, linked to their neighbours, in the
order a heap of pairs gives (lowest rank first, leftmost among equals).

Texts are split at single spaces first. The pre-tokens of " word" do not depend on what stands
around it as long as no run of white space holds two spaces, so ids of such chunks are kept in a
bounded dictionary; other texts are split whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame

from shoptrail.llm.common import per_text

#: Entries of the dictionaries of known pre-tokens and chunks before they start again.
KNOWN_PIECES, KNOWN_CHUNKS = 700_000, 300_000
_TWO_SPACES = re.compile(r" \s* ")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PerfectHash:
    """Minimal perfect hash of byte strings to their ranks, by hash and displace.

    Keys fall into buckets; the largest bucket first, each bucket gets the smallest seed that sends
    all its keys to free slots. A look-up costs two hashes, and one comparison rejects other keys.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = len(ranks)
        self.buckets = max(1, self.size // 4)
        self.seeds = array("q", [0] * self.buckets)
        self.keys: list[bytes | None] = [None] * self.size
        self.ranks = array("q", [-1] * self.size)
        groups: dict[int, list[bytes]] = {}
        for key in ranks:
            groups.setdefault(xxhash.xxh64_intdigest(key) % self.buckets, []).append(key)
        free = self.size and iter(range(self.size))
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:  # any free slot serves; a negative seed names it
                slot = next(i for i in free if self.keys[i] is None)
                self.seeds[bucket] = -slot - 1
                slots = [slot]
            else:
                seed = 1
                while True:
                    slots = [xxhash.xxh64_intdigest(key, seed) % self.size for key in members]
                    if len({*slots}) == len(slots) and all(self.keys[s] is None for s in slots):
                        break
                    seed += 1
                self.seeds[bucket] = seed
            for key, slot in zip(members, slots, strict=True):
                self.keys[slot], self.ranks[slot] = key, ranks[key]

    def get(self, key: bytes) -> int:
        """The rank of ``key``, or -1."""
        if not self.size:
            return -1
        seed = self.seeds[xxhash.xxh64_intdigest(key) % self.buckets]
        slot = -seed - 1 if seed < 0 else xxhash.xxh64_intdigest(key, seed) % self.size
        return self.ranks[slot] if self.keys[slot] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a pre-token: pairs leave a heap by rank and place; links join what is left."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts here ends; also the link to the next part
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, left, stop = heappop(heap)
        middle = end[left]
        if middle <= left or middle >= n or end[middle] != stop:  # a part has changed meanwhile
            continue
        end[left], end[middle] = stop, -1
        if stop < n:
            before[stop] = left
            if (rank := ranks.get(piece[left : end[stop]])) is not None:
                heappush(heap, (rank, left, end[stop]))
        if (start := before[left]) >= 0 and (rank := ranks.get(piece[start:stop])) is not None:
            heappush(heap, (rank, start, stop))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class _Known(dict):
    """Ids, as little-endian bytes, of strings; computed on demand and forgotten when too many."""

    def __init__(self, compute, most: int):
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = found = self.compute(key)
        return found


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks single bytes, as {missing[0]}")
        self.ranks, self.pattern = ranks, pattern
        self.table = PerfectHash(ranks)
        self._prepare()

    def _prepare(self) -> None:
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(self.pattern).findall
        self.pieces = _Known(self._piece, KNOWN_PIECES)
        self.chunks = _Known(lambda chunk: self._pieces_of(" " + chunk), KNOWN_CHUNKS)

    def __getstate__(self):
        return self.ranks, self.pattern, self.table

    def __setstate__(self, state):
        self.ranks, self.pattern, self.table = state
        self._prepare()

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.table.get(raw)
        return np.array([rank] if rank >= 0 else merge_bytes(raw, self.ranks), "<u4").tobytes()

    def _pieces_of(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if _TWO_SPACES.search(text):
            return self._pieces_of(text)
        first, *rest = text.split(" ")
        return self._pieces_of(first) + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, codec: Codec, keep: list[str], text: str = "text", ids: bool = False) -> DataFrame:
    """Token count and digests of ids and of decoded bytes for each row; ``ids`` adds the ids.

    A null or empty text has no tokens and the digests of nothing. Repeated rows and extra columns
    pass through (``keep`` names those to carry); an empty table gives an empty result. The codec is
    broadcast: its size is that of the vocabulary, whatever the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def make():
        own = shared.value

        def step(texts: list[str]) -> dict[str, list]:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for value in texts:
                raw = own.encode(value)
                out["n_tokens"].append(len(raw) // 4)
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(own.decode(raw)).hexdigest())
                if ids:
                    out["ids"].append(np.frombuffer(raw, "<i4"))
            return out

        return step

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return per_text(docs, keep, text, make, fields)
