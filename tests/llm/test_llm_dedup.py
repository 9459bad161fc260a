"""Exact, near and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import plan, rows
from llm_data import no_documents, odd_documents

import corpus_pipeline
from feedloom.llm import common
from feedloom.llm import exact_dedup as exact
from feedloom.llm import jaccard as similar
from feedloom.llm import simhash_dedup as near
from feedloom.llm import suffix_dedup as suffix
from feedloom.llm.graph import components


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("counters", [1, 3, 1023])
def test_exact_groups(spark, counters):
    rng = random.Random(counters)
    texts = ["A", "b", "B", "é", "É", "", None] + ["hot"] * 20
    data = [(i, rng.choice(texts)) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    groups = {}
    for i, t in data:
        groups.setdefault(lower(t), []).append(i)
    got = exact.exact_dedup(docs, counters=counters).collect()
    assert len(got) == 300
    for r in got:
        mine = groups[lower(dict(data)[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"]) == (max(mine), len(mine))
        assert r["kept"] == (r["doc_id"] == max(mine))
        assert r["text_sha256"] == hashlib.sha256(lower(dict(data)[r["doc_id"]])).hexdigest()


def test_exact_odd_rows(spark):
    docs = odd_documents(spark)
    got = exact.exact_dedup(docs).collect()
    assert len(got) == docs.count()
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in got})
    stay = exact.distinct_documents(docs)
    assert stay.columns == docs.columns and stay.count() == len(kept)
    assert exact.exact_dedup(no_documents(spark)).count() == 0
    assert exact.distinct_documents(no_documents(spark)).count() == 0


def test_one_of_many_rows_with_one_id_and_text_stays(spark):
    """Repeated rows are a third of all, differ in case or a further column, or have no id."""
    data = [(i, f"text {i}", i) for i in range(200)]
    data += [(7, "HOT" if i % 2 else "hot", i % 5) for i in range(100)]
    data += [(None, None, i % 3) for i in range(50)] + [(None, "", 9)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, extra bigint")
    first = rows(exact.distinct_documents(docs.repartition(7)))
    assert first == rows(exact.distinct_documents(docs.repartition(3)))
    ids = Counter(r[0] for r in first)
    assert len(first) == 202 and set(first) <= set(data)
    assert ids[7] == 2 and ids[None] == 1
    assert "partial_min_by" in plan(exact.distinct_documents(docs))


def test_frequent_digests_are_found(spark):
    data = [(i, str(i) if i % 3 else "hot") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(7)
    found = exact.frequent(exact.text_digests(docs), counters=10).collect()
    assert [bytes(r["digest"]) for r in found] == [hashlib.sha256(b"hot").digest()]


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (7, 7), (None, 3)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert {n: got.get(n, n) for n in parent} == {n: find(n) for n in parent}
    assert components(edges.where("false")).count() == 0


def fingerprint(text):
    words = lower(text).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("most", [1, 32])
def test_near_groups(spark, monkeypatch, most):
    """With ``LIST`` = 1 all posting lists go the way of crowded ones."""
    monkeypatch.setattr(near, "LIST", most)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(400)] for _ in range(4)]
    data = []
    for i in range(160):
        text = list(rng.choice(base)) if i % 8 else [rng.choice(words) for _ in range(i % 5)]
        for _ in range(i % 4 if text else 0):
            text[rng.randrange(len(text))] = rng.choice(words)
        data.append((1000 - i, " ".join(text) or None))
    fps = {i: fingerprint(t) for i, t in data}
    ids = sorted(fps)
    component = {}
    for i in ids:
        todo = [] if i in component else [i]
        while todo:
            j = todo.pop()
            component[j] = i
            todo += [k for k in ids if k not in component and (fps[j] ^ fps[k]).bit_count() <= 2]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = near.simhash_dedup(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == component
    assert {r["doc_id"] for r in near.one_of_each(docs).collect()} == set(component.values())
    assert len(set(component.values())) < 100


def test_near_odd_rows(spark):
    docs = odd_documents(spark)
    got = near.simhash_dedup(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert {c for _, c in by_id[None]} == {None} and by_id[2][0] == (by_id[1][0][0], 1)
    assert [by_id[i] for i in (3, 4, 5)] == [[("0" * 16, 3)]] * 3
    assert len(by_id[8]) == 2 and {c for _, c in by_id[8]} == {7}
    stay = near.one_of_each(docs)
    ids = Counter(r["doc_id"] for r in stay.collect())
    assert stay.columns == docs.columns and ids[None] == 2
    assert set(ids) - {None} == {c for _, c in sum(by_id.values(), []) if c}
    assert near.simhash_dedup(no_documents(spark)).count() == 0


def test_an_id_with_two_texts_is_one_document(spark):
    data = [(5, "a b c d"), (2, "a b c d"), (5, "x y z"), (9, "x y z")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert {r["component_id"] for r in near.simhash_dedup(docs).collect()} == {2}


def test_near_stage_keeps_unrelated_texts_of_one_id(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(50)) for c in "abc")
    data = [(5, one), (2, one), (5, two), (9, two), (5, three), (5, three), (None, one)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    stay = corpus_pipeline.near_stage(spark, docs, "").collect()
    expected = {(2, one): 1, (5, two): 1, (5, three): 1, (None, one): 1}
    assert Counter(map(tuple, stay)) == expected


def jaccard(a, b):
    a, b = ({tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("most", [1, 8])
def test_near_stage_links_similar_texts(spark, monkeypatch, most):
    """Planted copies of 0.8 and more go, others stay; with ``LIST`` = 1 all lists are long."""
    monkeypatch.setattr(similar, "LIST", most)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(800)]
    data, expected = {}, set()
    for i in range(0, 600, 3):
        base = [rng.choice(words) for _ in range(rng.choice([100, 200, 500]))]
        data[i] = base
        for j in (i + 1, i + 2):
            copy = list(base)
            for _ in range(rng.randrange(1, len(base) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            data[j] = copy
            if jaccard(base, copy) >= 0.8:
                expected.add((j, i))
    rows = [(i, " ".join(t)) for i, t in data.items()]
    docs = spark.createDataFrame(rows, "node bigint, text string")
    links = {(r["a"], r["b"]) for r in similar.similar_links(docs).collect()}
    assert all(jaccard(data[a], data[b]) >= 0.8 for a, b in links)
    assert len(links & expected) / len(expected) > 0.99
    docs = docs.withColumnRenamed("node", "doc_id")
    stay = {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    gone = {j for j, _ in links & expected}
    assert not stay & gone and {i for i in data if i % 3 == 0} <= stay
    assert len(gone) > 150


def test_a_large_group_of_similar_texts(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(800)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for i in range(200):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(300)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()] == [0]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_rows_among_nodes(spark, monkeypatch, most):
    """Also nodes far apart, below 0 and repeated; with no word broadcast Spark joins as it likes."""
    monkeypatch.setattr(common, "MARKS", most)
    nodes = [0, 1, 63, 64, 127, 130, -1, -64, -65, 7 << 33, (7 << 33) + 1, 2**63 - 1, -(2**63)]
    data = [(n, f"{i}") for i in range(2) for n in [*nodes, 2, 65, None]]
    texts = spark.createDataFrame(data, "node bigint, text string")
    wanted = [*nodes[::2], *nodes[::4], None, 1000]
    found = common.among(texts, spark.createDataFrame([(n,) for n in wanted], "node bigint"))
    assert found.columns == texts.columns
    assert rows(found) == sorted(((n, t) for n, t in data if n in nodes[::2]), key=repr)
    none = common.among(texts, spark.createDataFrame([], "node bigint"))
    assert none.count() == 0


def test_near_stage_shuffles_no_texts(spark, monkeypatch):
    """Neither those whose sets are compared nor those that stay, also where nothing is small."""
    plans = []

    def seen(df, purpose, stored=similar.stored):
        plans.extend([plan(df)] * (purpose == "sets"))
        return stored(df, purpose)

    monkeypatch.setattr(similar, "stored", seen)
    data = [(i, " ".join(f"w{i % 7}x{j}" for j in range(20))) for i in range(30)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        stay = corpus_pipeline.near_stage(spark, docs, "")
        plans.append(plan(stay))
        assert {r["doc_id"] for r in stay.collect()} == set(range(7))
    finally:
        spark.conf.set(threshold, before)
    assert len(plans) == 2
    for found in plans:
        assert "BroadcastHashJoin" in found and "Exchange hashpartitioning" not in found


def templates(n, words_changed, seed):
    """Texts made from one by changing so many words in each."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(500)]
    found = {}
    for i in range(n):
        found[i] = list(base)
        for at in rng.sample(range(500), words_changed):
            found[i][at] = f"x{rng.randrange(10**9)}"
    return found


def exact_components(data, linked):
    found = {}
    for i in sorted(data):
        todo = [] if i in found else [i]
        while todo:
            j = todo.pop()
            found[j] = i
            todo += [k for k in data if k not in found and linked(data[j], data[k])]
    return found


@pytest.mark.parametrize(
    "words_changed, most, block",
    [(5, 8, 256), (6, 8, 256), (7, 8, 256), (8, 8, 256), (7, 1, 256), (7, 8, 20)],
)
def test_no_link_is_lost_in_a_crowded_band(spark, monkeypatch, words_changed, most, block):
    """One template gives lists of 300 texts, whose pairs are just above 0.8 or just below."""
    monkeypatch.setattr(similar, "LIST", most)
    monkeypatch.setattr(similar, "BLOCK", block)
    data = templates(300, words_changed, words_changed)
    sets = {i: {tuple(t[j : j + 5]) for j in range(len(t) - 4)} for i, t in data.items()}

    def near_enough(a, b):
        common = len(a & b)
        return common >= 0.8 * (len(a) + len(b) - common)

    expected = exact_components(sets, near_enough)
    rows = [(i, " ".join(t)) for i, t in data.items()]
    links = similar.similar_links(spark.createDataFrame(rows, "node bigint, text string"))
    links = {(r["a"], r["b"]) for r in links.collect()}
    assert all(near_enough(sets[a], sets[b]) for a, b in links)
    # a list gives no more links than it has texts where these are in one block
    assert block < 256 or len(links) <= similar.BANDS * len(data)
    neighbours = {i: set() for i in data}
    for a, b in links:
        neighbours[a].add(b)
        neighbours[b].add(a)
    assert exact_components({i: i for i in data}, lambda a, b: b in neighbours[a]) == expected
    if words_changed == 7:
        assert 1 < len(set(expected.values())) < 300


def test_blocks_of_few_shingles(spark, monkeypatch):
    """Also with blocks of one text, and among texts without words."""
    monkeypatch.setattr(similar, "LIST", 1)
    monkeypatch.setattr(similar, "BLOCK_SHINGLES", 1)
    data = templates(12, 6, 1)
    rows = [(i, " ".join(t)) for i, t in data.items()] + [(100, ""), (101, None), (102, "a b")]
    docs = spark.createDataFrame(rows, "node bigint, text string")
    links = {(r["a"], r["b"]) for r in similar.similar_links(docs).collect()}
    both = {frozenset((a, b)) for a, b in links}
    every = {i: {j for j in data if jaccard(data[i], data[j]) >= 0.8} for i in data}
    for i in data:  # connected as they should be
        seen, todo = {i}, [i]
        while todo:
            j = todo.pop()
            more = {k for k in data if frozenset((j, k)) in both} - seen
            seen |= more
            todo += more
        assert every[i] <= seen


def without_repeats(texts, n):
    count = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        yield len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept


def repeating_texts(seed, count=120):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdé", k=rng.randrange(150))) for _ in range(5)]
    for _ in range(count):
        t = rng.choice(base)[rng.randrange(40) :]
        t = t + "".join(rng.choices("ab", k=5)) if rng.random() < 0.5 else t
        if t and rng.random() < 0.5:
            k = rng.randrange(len(t))
            t = t[:k] + rng.choice("xyz") + t[k + 1 :]
        yield t * rng.choice([1, 1, 1, 2]) if rng.random() < 0.9 else t[:3] * 30


@pytest.mark.parametrize("group", [1, 4096])
def test_repeated_bytes(spark, group):
    """With ``group`` = 1 all anchors with several contexts are taken string by string."""
    texts = [*repeating_texts(group), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = suffix.without_repeats(docs.repartition(3), length=24, gram=8, group=group).collect()
    expected = list(without_repeats([(t or "").encode() for t in texts], 24))
    assert sum(e[1] for e in expected) > 1000 and sum(len(e[3]) for e in expected) > 200
    assert {r[0]: (*r[1:4], bytes(r[4])) for r in got} == dict(enumerate(expected))


def test_verdict_on_repeats(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefgh ", k=1000)) for _ in range(4)]
    passage = "".join(rng.choices("xyz ", k=450))
    texts += [texts[0][:50] + passage, passage + "!" * 30, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in suffix.suffix_dedup(docs).collect()}
    assert {i for i, r in got.items() if r["predicted"]} == {4, 5}
    for r in got.values():
        share = r["n_removed"] / r["n_bytes"] if r["n_bytes"] else 0
        assert r["score"] == share and r["predicted"] == (r["n_removed"] > 0)


def test_maximal_groups_of_one_anchor():
    rng = random.Random(1)
    for _ in range(100):
        rows = [
            (bytes(rng.choices(b"ab", k=rng.randrange(6))), bytes(rng.choices(b"ab", k=6)))
            for _ in range(rng.randrange(2, 9))
        ]
        rows = list(dict.fromkeys(rows))
        before, after = [r[0] for r in rows], [r[1] for r in rows]

        def common(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y),
                        min(len(a), len(b)))

        expected = set()
        for i in range(len(rows)):
            for j in range(i):
                pair = common(before[i], before[j]), common(after[i], after[j])
                if sum(pair) >= 4 and pair[1]:
                    expected.add((*pair, i, j))
        found = list(suffix.repeat_groups(before, after, 4))
        for left, right, i, j in expected:  # each pair is in a group that says as much
            assert any(a >= left and b >= right and {i, j} <= set(m) for a, b, m in found)
        for left, right, members in found:
            assert all(common(before[i], before[j]) >= left for i in members for j in members)
            assert all(common(after[i], after[j]) >= right for i in members for j in members)


def test_suffix_odd_rows(spark):
    docs = odd_documents(spark)
    got = suffix.suffix_dedup(docs).collect()
    assert len(got) == docs.count()
    removed = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got}
    assert removed[7] == removed[8] == (108_000, 108_000, 1)
    assert removed[3] == (0, 0, 0) and removed[1][1] == 0
    assert suffix.suffix_dedup(no_documents(spark)).count() == 0
