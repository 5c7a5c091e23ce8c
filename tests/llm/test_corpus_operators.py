"""Operators that compare texts with each other, the classifier and the pipeline, against plain versions."""

import random
import re
import sys

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from checks.compare import differences
from shoptrail.llm import decontaminate, line_dedup, quality_classifier, simhash
from shoptrail.llm.components import components
from shoptrail.llm.queries import ORACLES, QUERIES


def groups_of(n, links):
    """The smallest member of each one's group."""
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return [root(i) for i in range(n)]


def words(rng, n, some=3000):
    return [f"w{rng.randrange(some)}" for _ in range(n)]


def changed(rng, text, share):
    return " ".join(f"new{rng.randrange(9999)}" if rng.random() < share else w for w in text.split(" "))


def test_all_queries_are_registered():
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys() and "pipeline" in queries()
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, sql, name):
    assert differences(QUERIES[name](spark, folder), sql, ORACLES[name]) == ""


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    rng.shuffle(links)
    given = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links] + [(5, 5), (None, 3), (0, 1), (1, 0)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(given, "x long, y long"), "x", "y").collect())
    want = groups_of(400, links)
    assert got == {n: want[n] for n in {n for link in links if link[0] != link[1] for n in link}}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def plain_fingerprint(text):
    shingled = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not shingled:
        return 0
    shingles = [" ".join(shingled[i : i + 3]) for i in range(max(1, len(shingled) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(words(rng, rng.randrange(40))) for _ in range(60)]
    texts += [changed(rng, t, 0.01) for t in texts] + texts[:9] + [None, "", " \t", "A b", "a  B", "x" * 9000]
    for _ in range(12):  # long texts with few changes have near fingerprints
        base = " ".join(words(rng, 1500))
        texts += [base, changed(rng, base, 0.003), changed(rng, base, 0.006)]
    ids = list(range(len(texts)))
    prints = [plain_fingerprint(t or "") for t in texts]
    links = [(i, j) for i in ids for j in ids[:i] if (prints[i] ^ prints[j]).bit_count() <= 2]
    assert any(prints[i] != prints[j] for i, j in links)
    want = groups_of(len(texts), links)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "again")], "doc_id long, text string, fp string")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 1
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{prints[i]:016x}", want[i]) for i in ids}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({*want})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "a"), (None, "a"), (4, "a")], "doc_id long, text string")
    assert sorted(simhash.keep_one(nameless).collect(), key=str) == sorted(nameless.collect(), key=str)
    assert {r.component_id for r in simhash.near_duplicates(nameless).collect()} == {4}


def test_pivot_keys_find_every_near_pair(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)}
    prints |= {p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in prints}
    prints |= {0, 2**64 - 1, 1, 3, 7}
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    got = {tuple(r) for r in simhash.links(df, 2).collect()}
    want = {tuple(sorted((simhash._signed(a), simhash._signed(b)))) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 2}
    assert got == want


def test_pipeline_stage_keeps_one_of_each_simhash_group(spark):
    """Three-word shingles and two bits, against all pairs; texts without words are one group."""
    rng = random.Random(12)
    texts = [" ".join(words(rng, n)) for n in [4, 30, 400, 1500] * 8]
    texts += [changed(rng, t, s) for t in texts for s in (0.002, 0.1)] + texts[:5] + ["", " ", None]
    prints = [plain_fingerprint(t or "") for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    docs = spark.createDataFrame([*enumerate(texts), (None, "x"), (None, "x")], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(None) == 2
    assert sorted(i for i in ids if i is not None) == sorted({*groups_of(len(texts), links)})


def line_sets(line):
    return {line[i : i + 8] for i in range(len(line) - 7)} or {line}


@pytest.mark.parametrize("direct", [1, 32])
def test_line_dedup_equals_brute_force(spark, monkeypatch, direct):
    monkeypatch.setattr(line_dedup, "DIRECT", direct)  # with 1, all bands that stay split go through the prefix filter
    rng = random.Random(4)
    base = [" ".join(words(rng, rng.randrange(3, 60))) for _ in range(50)]
    pool = base + [changed(rng, b, s) for b in base for s in (0.02, 0.05, 0.2)] + ["Short.", "x", "日本語の行です、とても長い行です", "日本語の行です、とても長い行でず"]
    texts = ["\n".join(rng.choices(pool, k=rng.randrange(1, 9))) for _ in range(60)]
    texts += [None, "", "\n\n", "  SHORT. \n\nx\nx", "y" * 70_000, "a\r\nb\r\n"]
    docs = spark.createDataFrame([(i, t, "e", 1) for i, t in enumerate(texts)], "doc_id long, text string, line string, n_removed int")
    places: dict[str, list] = {}
    for i, text in enumerate(texts):
        for at, line in enumerate((text or "").split("\n")):
            if shown := line.strip(" \t\r\x0b\x0c").lower():
                places.setdefault(shown, []).append((i, at))
    lines = list(places)
    sets = [line_sets(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    first: dict[int, tuple] = {}
    group = groups_of(len(lines), links)
    for i, line in enumerate(lines):
        first[group[i]] = min([*places[line], *([first[group[i]]] if group[i] in first else [])])
    gone = {p for i, line in enumerate(lines) for p in places[line] if p != first[group[i]]}
    want = {i: None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if (i, at) not in gone) for i, t in enumerate(texts)}
    assert links and {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, count="n").collect()} == want
    twice = docs.unionByName(docs)
    assert sorted(map(str, line_dedup.dedup_lines(twice, count=None).collect())) == sorted(map(str, [*line_dedup.dedup_lines(docs, count=None).collect()] * 2))
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "x\nx"), (1, "x")], "doc_id long, text string")
    assert sorted((r.text, r.n_removed) for r in line_dedup.dedup_lines(nameless).collect()) == [("x", 0), ("x\nx", 0)]


def test_bands_of_unlike_lines_lose_no_link(spark):
    """Lines that share a long passage meet in one band but are alike only in pairs."""
    rng = random.Random(6)
    shared = " ".join(words(rng, 60))
    lines = []
    for _ in range(25):
        own = " ".join(words(rng, 60))
        lines += [f"{shared} {own}", f"{shared} {changed(rng, own, 0.02)}"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    sets = [line_sets(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.text}
    assert len(kept ^ {*groups_of(len(lines), links)}) <= 2


def test_near_copies_below_the_bound_do_not_become_pairs(spark, monkeypatch):
    """A crowded band of near copies, most of them too far apart for a link: only pairs that are about similar are joined."""
    rng = random.Random(8)
    base = words(rng, 40)
    lines = {" ".join(rng.choice(words(rng, 1)) if rng.random() < 0.06 else w for w in base) for _ in range(150)}
    sets = [line_sets(x) for x in lines]
    similarity = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i)]
    joined, prefix_pairs = [], line_dedup.prefix_pairs

    def counted(*args):
        pairs = prefix_pairs(*args)
        joined.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(line_dedup, "prefix_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.text}
    links = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert kept == {*groups_of(len(sets), links)}
    assert 0 < len(links) < len(similarity) / 4 and len(kept) > 10
    assert joined[0][1] <= sum(s >= 0.7 for s in similarity)


def test_small_bands_are_settled_without_union_find_and_unlike_pairs_without_texts(spark, monkeypatch):
    """One union-find for the result, and only pairs that are about similar are compared in full."""
    rng = random.Random(14)
    lines = []
    for _ in range(8):
        shared = " ".join(words(rng, 60))
        for _ in range(3):
            own = " ".join(words(rng, 50))
            lines += [f"{shared} {own}", f"{shared} {changed(rng, own, 0.03)}"]
    sets = [line_sets(x) for x in lines]
    similarity = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i)}
    links = [pair for pair, s in similarity.items() if s >= 0.8]
    rounds, compared, similar = [], [], line_dedup.similar

    def counted(pairs, texts):
        compared.append(pairs.distinct().count())
        return similar(pairs, texts)

    monkeypatch.setattr(line_dedup, "similar", counted)
    monkeypatch.setattr(line_dedup, "components", lambda *args: rounds.append(1) or components(*args))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.text}
    assert links and kept == {*groups_of(len(lines), links)}
    assert len(rounds) == 1 and max(compared) <= sum(s >= 0.7 for s in similarity.values())


def test_line_signatures_need_no_sorting_and_shuffle_no_text(spark, monkeypatch):
    """All lines' shingles and the union-find go through hash aggregations of numbers, the former in generated code."""
    plans, write = {}, line_dedup.stage

    def planned(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return write(df, label)

    for module in (line_dedup, sys.modules[components.__module__]):
        monkeypatch.setattr(module, "stage", planned)
    rng = random.Random(15)
    lines = [" ".join(words(rng, 30)) for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate([*lines, *(f"{x} end" for x in lines), "-" * 30, "-" * 900])), "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.text}
    assert kept == {0, 1, 2, 3, 8}  # the last two have one and the same shingle
    assert {"lines", "edges"} <= plans.keys()
    assert all("SortAggregate" not in plans[label] and "HashAggregate" in plans[label] for label in ("lines", "edges"))
    first = next(x for x in plans["lines"].split("\n") if "HashAggregate" in x and "partial_min" in x)
    assert "first(" not in plans["lines"] and "line#" not in first and "transform(" not in plans["lines"][plans["lines"].index(first) :]


def pair_recall(spark, pairs):
    """The part of the pairs of lines, each of similarity 0.8 or more, of which line dedup leaves one."""
    for a, b in pairs:
        assert a != b and len(line_sets(a) & line_sets(b)) >= 0.8 * len(line_sets(a) | line_sets(b))
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(x for pair in pairs for x in pair)], "doc_id long, text string")
    return sum(r.n_removed for r in line_dedup.dedup_lines(docs).collect()) / len(pairs)


def test_near_copies_of_short_lines_are_found(spark):
    """Lines of 12 to 60 characters, most without d, i, n, s, x and digits, that differ at an end."""
    rng = random.Random(8)
    for letters in ("abcefghjklmopqrtuvwyz ", "abcdefghijklmnopqrstuvwxyz 0123456789"):
        lines = ["a" + "".join(rng.choices(letters, k=n - 2)) + "b" for n in range(12, 60) for _ in range(6)]
        assert pair_recall(spark, [(x, x + rng.choice("bcn")) if rng.random() < 0.5 else (rng.choice("acs") + x, x) for x in lines]) >= 0.98


def test_similar_lines_with_a_passage_in_another_script_are_found(spark):
    rng = random.Random(9)
    pairs = []
    for n in [200, 400, 800, 1600] * 15:
        line = "a" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) + "b"
        at = rng.randrange(n)
        pairs.append((line, line[:at] + "".join(rng.choices("абвгдежзиклмнопрст", k=n // 8)) + line[at:]))
    assert pair_recall(spark, pairs) >= 0.98


def best_stretch(text, item):
    """The best score of the item beside the text, over all places."""
    a, b = (re.findall(r"[^\W_]+", t.lower()) for t in (text, item))
    best = 0
    for shift in range(1 - len(b), len(a)):
        now = 0
        for j, word in enumerate(b):
            same = 0 <= shift + j < len(a) and a[shift + j] == word
            now = max(0, now + (1 if same else -decontaminate.MISMATCH))
            best = max(best, now)
    return best >= min(decontaminate.LEAST, -(-len(b) * 4 // 5))


def test_decontamination_finds_planted_passages(spark):
    rng = random.Random(5)
    items = [" ".join(words(rng, n)) for n in (15, 25, 40, 60, 5, 11, 1)]
    filler = lambda n: " ".join(f"f{rng.randrange(5000)}" for _ in range(n))
    planted = {}
    texts = [None, "", filler(5), filler(20_000), ". , !"]
    for n, item in enumerate(items):
        for share in (0.0, 0.08) if n < 4 else (0.0,):
            planted[len(texts)] = n
            texts.append(f"{filler(30)} {changed(rng, item, share).upper().replace(' ', ', ')}\n{filler(30)}")
    planted[len(texts)] = 3
    texts.append(" ".join(items[3].split()[20:]) + " " + filler(9))
    clean = [len(texts) + i for i in range(2)]
    texts += [" ".join(items[3].split()[:7]) + " " + filler(40), " ".join(sorted(items[2].split()))]
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    tests = spark.createDataFrame([*enumerate(items), (2, items[2]), (90, None), (91, ""), (None, "a b c")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_overlaps(docs, tests).collect()}
    exact = {(i, n) for i, n in planted.items() if items[n] in texts[i].lower().replace(", ", " ")}
    every = {(i, n) for i, t in enumerate(texts) if t and len(t) < 9999 for n, item in enumerate(items) if best_stretch(t, item)}
    assert exact <= found.keys() <= every and len(every - found.keys()) <= 1 and {*planted.items()} - every <= {(6, 0)}
    whole = found[5, 0]
    assert (whole.score, whole.n_equal, whole.n_item_words, whole.first_word) == (15, 15, 15, 30)
    rest = decontaminate.drop_contaminated(docs.unionByName(docs), tests)
    assert rest.columns == docs.columns and sorted({r.doc_id for r in rest.collect()}) == sorted({*range(len(texts))} - {i for i, _ in found})
    assert {*clean} <= {r.doc_id for r in rest.collect()}
    assert decontaminate.find_overlaps(docs.limit(0), tests).count() == 0
    assert decontaminate.find_overlaps(docs, tests.limit(0)).count() == 0


def test_decontamination_without_broadcasts_is_the_same(spark, folder, monkeypatch):
    docs, tests = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    few = sorted(map(tuple, decontaminate.find_overlaps(docs, tests).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, decontaminate.find_overlaps(docs, tests).collect())) == few and few
    exact = {(d.doc_id, t.item_id) for d in docs.collect() for t in tests.collect() if t.text in d.text}
    assert exact <= {r[:2] for r in few}


def test_classifier_on_rows_held_out(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES["op8_quality_classifier"](spark, folder)
    found = rows.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) >= 0.95
    assert min(np.mean([r.predicted == r.quality for r in found if r.quality == q]) for q in (0, 1)) >= 0.8
    assert rows.count() == docs.count() and rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_classifier_of_odd_tables(spark):
    texts = [None, "", "a", "b " * 90_000, "good words here and there"]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(None, "x", 0.1), (4, "again", 0.1)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(i, 1) for i in range(5)] + [(None, 0), (3, None), (2, 7)], "doc_id long, quality int")
    both = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    for labels in (none, one, both):
        model = quality_classifier.fit(docs, labels)
        rows = quality_classifier.score(docs, model, ["doc_id", "score"], name="found").collect()
        assert len(rows) == 7 and all(0 <= r.found <= 1 for r in rows)
    assert quality_classifier.score(docs.limit(0), model, ["doc_id"]).count() == 0
    assert quality_classifier.fit(docs.limit(0), both).temperature == 1.0


def test_pipeline_keeps_what_it_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    now = docs.withColumns({"score": F.lit(1), "n_removed": F.lit("x"), "fp": F.lit(2)})
    columns = now.columns
    after = stages["quality classifier"](spark, now, folder)
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    assert after.columns == columns and np.mean([(i in kept) == (q == 1) for i, q in labels.items()]) > 0.97
    path = f"{spark.conf.get('spark.checkpoint.dir')}/after-quality"
    after.write.mode("overwrite").parquet(path)
    after = spark.read.parquet(path)
    lines = stages["line dedup"](spark, after, folder)
    assert lines.columns == columns and lines.count() == after.count()
    for name in ("SimHash near-dedup", "benchmark decontamination"):
        assert stages[name](spark, after, folder).columns == columns
    result = corpus_pipeline.run(spark, folder)
    rows = result.collect()
    assert 0 < len(rows) < docs.count() and len({r.doc_id for r in rows}) == len(rows)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        empty = step(spark, empty, folder)
    assert empty.count() == 0
