"""MinHash near-duplicates, ranked search and conversation repair, against plain versions."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import groups_of

from checks.compare import differences
from shoptrail.llm import conversation_repair, minhash_dedup, ranked_search
from shoptrail.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- near-duplicates ------------------------------------------------------------------------


def plain_sets(texts):
    sets = []
    for text in texts:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set()))
    return sets


def plain_components(ids, sets):
    """Pairs that share a shingle are compared, all of them."""
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    common = Counter()
    for held in holders.values():
        common.update(combinations(held, 2))
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    return [ids[r] for r in groups_of(len(ids), links)]


def check_near_duplicates(docs, rows):
    rows = sorted(rows)  # so that the smallest index is the smallest id
    sets = plain_sets([t for _, t in rows])
    want = {(i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, plain_components([i for i, _ in rows], sets), strict=True)}
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_minhash_equals_all_pairs_on_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check_near_duplicates(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def a_family(rng, n, shared, own):
    """Texts that share a passage and are otherwise unlike, in which a few have a near copy."""
    passage = [f"p{i}" for i in range(shared)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(own)]) for _ in range(n)]
    copies = [t.replace(f"p{rng.randrange(shared)} ", "changed ", 1) for t in texts[: n // 8]]
    return texts + copies


@pytest.mark.parametrize("seed", [2, 64])
def test_minhash_tells_hot_buckets_apart(spark, seed):
    """A passage shared by unlike texts, a group of near copies of one text, a chain of copies of copies, and exact copies."""
    rng = random.Random(seed)
    texts = a_family(rng, 160, 90, 60)
    base = [f"b{i}" for i in range(120)]
    for _ in range(80):
        near = list(base)
        for _ in range(rng.randrange(1, 9)):
            near[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    chain = list(base)
    for i in range(30):  # each near the one before, the ends far from each other
        chain[4 * i] = f"c{i}"
        texts.append("chain " + " ".join(chain))
    texts += ["The same\ttext  again and again"] * 40 + ["the SAME text again and again", "one", "One", "two words", "", " \n", None]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    check_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows)


def test_minhash_nulls_clashing_names_and_nothing(spark):
    data = [(1, "a b c d e f", 5), (2, "a b c d e f", 6), (None, "a b c d e f", 7), (None, None, 8), (3, None, 9), (1, "quite another text it is", 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, component_id long").withColumns({"keys": F.lit(1), "lid": F.lit(2), "__id": F.lit(0), "doc": F.lit("x")})
    got = sorted((tuple(r) for r in minhash_dedup.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (None, 3, None, True), (None, 0, None, True), (3, 0, 3, True), (1, 2, 1, True)], key=repr)
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0
    named = docs.where("doc_id < 3").select(F.col("text").alias("body"), F.concat(F.lit("d"), "doc_id").alias("name"))
    assert {r.component_id for r in minhash_dedup.near_duplicates(named, "name", "body").collect()} == {"d1"}


def test_minhash_of_a_very_long_text(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    near = list(words)
    for i in range(0, 60_000, 100):
        near[i] = "new"
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:30_000]))]
    check_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_signatures_follow_the_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    for shared in (1000, 889, 500):  # of 1000 each: similarity s / (2000 - s)
        other = np.concatenate([base[:shared], rng.integers(0, 2**63, 1000 - shared, dtype=np.uint64)])
        a, b = minhash_dedup.minima(base), minhash_dedup.minima(other)
        similarity = shared / (2000 - shared)
        assert abs((a == b).mean() - similarity) < 0.13
        equal = sum(
            (int(x) >> s & 15) == (int(y) >> s & 15)
            for x, y in zip(minhash_dedup.signature(a).view("u8"), minhash_dedup.signature(b).view("u8"), strict=True)
            for s in range(0, 64, 4)
        )
        assert (equal >= minhash_dedup.LEAST_EQUAL) == (similarity >= 0.8)


# --- ranked search --------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_ranking(docs, items, k=10):
    """Every document scored for every item."""
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = set()
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in asked.items() if c[t])
            if score > 0:
                scores.append((-score, i))
        out |= {(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("shard_bytes", [2_000, 60_000, 1 << 24])
def test_search_equals_scoring_every_document(spark, tmp_path, shard_bytes):
    """Common and rare terms, ties by repeated texts, blocks of many postings, and shards small and large."""
    rng = random.Random(3)
    frequent, rare = [f"f{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    docs = []
    for i in range(1500):
        words = rng.choices(frequent, k=rng.randrange(1, 30)) + rng.choices(rare, k=rng.randrange(0, 6))
        docs.append((i, " ".join(words)))
    docs += [(5000 + i, "f1 R7 r7, tie-break ünïcode 中文 f1") for i in range(30)] + [(9000, None), (9001, ""), (9002, "?! --"), (9003, "r1 " * 5000)]
    items = [(q, " ".join(rng.choices(frequent, k=5) + rng.choices(rare, k=4))) for q in range(25)]
    items += [(100, "f1 f1 f1 r7"), (101, "tie BREAK 中文"), (102, "nothing_here zzz"), (103, ""), (104, None), (105, "f1 f2 f3")]
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    index, n, total = ranked_search.build_index(given, str(tmp_path / "index"), shard_bytes=shard_bytes)
    got = ranked_search.search(index, n, total, ranked_search.query_terms(asked))
    assert {tuple(r) for r in got.collect()} == plain_ranking(docs, items)


def test_search_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERIES_AT_ONCE", 3)
    docs = [(i, f"a{i % 7} b{i % 5} c{i % 11}") for i in range(200)]
    items = [(q, f"a{q} b{q} c{q}") for q in range(8)]
    got = ranked_search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == plain_ranking(docs, items)


def test_block_maxima_keep_blocks_packed():
    """With a high tenth best score, blocks of non-essential lists that cannot matter are not unpacked."""
    shard = ranked_search._Shard(4000, 4000 * 12)
    rng = random.Random(1)
    for i in range(4000):
        shard.add(i, " ".join(["often"] * (9 if i == 3900 else 1) + ["rare"] * (i == 3900) + [f"w{rng.randrange(3000)}" for _ in range(10)]))
    batch = pa.Table.from_batches(shard.rows(0))
    rows = {r["term"]: tuple(r[c] for c in ("top", "lasts", "tops", "ends", "postings", "n_docs")) for r in batch.to_pylist()}
    m = np.full(4000, 100)
    often, rare = ranked_search._List(rows["often"], m), ranked_search._List(rows["rare"], m)
    docs, scores = ranked_search.search_shard([(3, often), (5000, rare)], 4000, 3_000_000)
    assert docs.tolist() == [3900] and len(often.lasts) == 32 and list(often.unpacked) == [3900 // 128]
    assert ranked_search.search_shard([(3, often)], 4000, 10**9)[0].tolist() == []


def test_search_nulls_clashing_names_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(None, "alpha beta"), (2, "alpha"), (2, "alpha"), (1, "Alpha"), (7, None)], "doc_id int, text string").withColumns({"term": F.lit(1), "score": F.lit(2), "item_id": F.lit(3)})
    items = spark.createDataFrame([("x", "alpha"), ("x", "alpha"), ("y", None), (None, "alpha"), ("z", "beta")], "item_id string, text string").withColumns({"rank": F.lit(1), "doc_id": F.lit(4)})
    got = sorted(tuple(r) for r in ranked_search.rank_documents(docs, items).select("item_id", "rank", "doc_id").collect())
    assert got == [("x", 1, 1), ("x", 2, 2), ("x", 3, 2), ("x", 4, None), ("z", 1, None)]
    assert ranked_search.rank_documents(docs.limit(0), items).count() == 0
    assert ranked_search.rank_documents(docs, items.limit(0)).count() == 0


# --- conversation repair --------------------------------------------------------------------


def plain_damage(rows):
    out = defaultdict(list)
    shown = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        role, text = shown(role), shown(text)
        held = out[conv]
        action = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if action == 0:
            continue
        text = "" if action == 1 else re.sub("[.!?]", "", text) if action == 2 else text
        role = "user" if action == 4 else role
        held += [(turn, role, text)] * (2 if action == 3 else 1)
    return out


def plain_repair(rows):
    """Dijkstra over (rows done, grammar state), least cost and then least audit, edits spelled out."""
    faults, seen = [], set()
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "su", ("s", "u"): "su", ("su", "a"): "sua", ("sua", "u"): "su"}  # what has been read, as far as it matters
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "sua"):
            break
        for role in ("user", "assistant"):
            if (state, role[0]) in after:
                heapq.heappush(heap, (cost + 2, audit + "I", at, after[state, role[0]], out + ((role, ""),)))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, out))
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                if (state, role[:1]) in after:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, after[state, role[:1]], out + ((role, text),)))
                for new in ("user", "assistant"):
                    if (state, new[0]) in after:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, after[state, new[0]], out + ((new, text),)))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def by_turn(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_repair_equals_a_shortest_path_on_the_given_conversations(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    damaged = plain_damage(tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect())
    want = {(conv, *plain_repair(by_turn(rows))) for conv, rows in damaged.items()}
    assert {tuple(r) for r in QUERIES["op13_conversation_repair"](spark, folder).collect()} == want


def some_turns(rng, n):
    texts = ["Yes.", "No", "Why?", " ", "", "Oh!\n", "yes.", None, "Straße…", "a.b"]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, "", "User"]
    return [(conv, None if rng.random() < 0.05 else rng.randrange(12), rng.choice(roles), rng.choice(texts)) for conv in [*range(n), None] for _ in range(rng.randrange(1, 9))]


def test_repair_equals_a_shortest_path_on_odd_conversations(spark):
    """Nulls everywhere, unknown and empty roles, turns given twice, rows given twice."""
    rng = random.Random(4)
    rows = some_turns(rng, 300)
    rows += rows[:40]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumns({"copy": F.lit(1), "at": F.lit("x"), "symbol": F.lit(2)})
    want = {(conv, *plain_repair(by_turn(held))) for conv, held in plain_damage(rows).items()}
    got = [tuple(r) for r in conversation_repair.repair_damaged(given).collect()]
    assert len(got) == 301 and set(got) == want


def test_conversations_without_rows_and_no_conversations(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    given = spark.createDataFrame([(7, turn, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in conversation_repair.repair_damaged(given).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert conversation_repair.repair_damaged(given.limit(0)).count() == 0


def test_a_very_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"Turn {i}.") for i in range(20_000)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (got,) = conversation_repair.repair_damaged(given).collect()
    held = by_turn(plain_damage(rows)[1])
    assert got.blank == sum(not t for _, _, t in held) and len(got.audit.replace("I", "")) == len(held)


def test_the_automaton_makes_each_suffix_once():
    signatures = sorted(("suaua", "ua", "uaua", "xaua", "Oaua", "", "ua"), key=lambda s: s[::-1])
    automaton = conversation_repair.Automaton()
    found = {s: automaton.walk(s) for s in signatures}
    assert found["suaua"] == (0, "KKKKK") and found[""] == (0, "") and found["xaua"] == (5, "DIKKK")
    assert automaton.made == len({s[i:] for s in signatures for i in range(len(s))})
