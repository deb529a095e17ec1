"""Periodic runs, best-position search and MinHash groups against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from compare import compare, connect
from conftest import SF
from pyspark.sql import functions as F
from test_against_brute_force import classes_by_hand

from tellerscope.llm import best_position, minhash, periodic_runs, queries


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


# --- periodic runs


def runs_by_hand(codes, min_length, min_exponent):
    """Of each period the longest stretches that keep it, unless a smaller period does so too."""
    codes, out, n = np.asarray(codes), [], len(codes)
    for q in range(1, n // min_exponent + 1):
        same = np.concatenate([[0], (codes[:-q] == codes[q:]).astype(np.int8), [0]])
        for start, stop in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            length = int(stop - start) + q
            own = codes[start : start + length]
            if length >= max(min_length, min_exponent * q) and not any((own[:-p] == own[p:]).all() for p in range(1, q)):
                out.append((int(start), length, q))
    return sorted(out)


def test_runs_of_random_words():
    r = random.Random(1)
    found = 0
    for _ in range(1200):
        codes = [r.randrange(r.choice([1, 2, 3, 5])) for _ in range(r.randrange(60))]
        if r.random() < 0.6:
            middle = [r.randrange(4) for _ in range(r.randrange(1, 7))] * r.randrange(2, 9)
            codes = codes[: len(codes) // 2] + middle + codes[len(codes) // 2 :]
        for bounds in ((6, 4), (2, 2), (5, 3)):
            got = [tuple(map(int, x)) for x in periodic_runs.runs(np.array(codes, np.int64), *bounds)]
            assert got == runs_by_hand(codes, *bounds)
            found += len(got)
    assert found > 5000
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(9, np.int64), 2, 1)


def test_suffix_tree_gives_ranks_and_extensions():
    r = random.Random(2)
    for n in (1, 2, 9, 60):
        word = [r.randrange(1, 4) for _ in range(n)]
        tree = periodic_runs.SuffixTree([*word, 0], 4)
        depths, place, ranks = tree.tour()
        assert sorted(range(n + 1), key=lambda i: [*word, 0][i:]) == np.argsort(ranks).tolist()
        turned = [4 - w for w in word]
        assert sorted(range(n + 1), key=lambda i: [*turned, 0][i:]) == np.argsort(tree.opposite_ranks()).tolist()
        pairs = np.array([(i, j) for i in range(n) for j in range(n) if i != j], np.int64).reshape(-1, 2)
        got = periodic_runs.least_between(depths, place[pairs[:, 0]], place[pairs[:, 1]])
        for (i, j), shared in zip(pairs.tolist(), got.tolist()):
            k = 0
            while max(i, j) + k < n and word[i + k] == word[j + k]:
                k += 1
            assert shared == k


def expected_runs(doc_id, text):
    words = text.encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    numbers = {}
    found = runs_by_hand([numbers.setdefault(w, len(numbers)) for w in words], 6, 4)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = math.floor(1000 * Fraction(best[1], best[2])) if found else None
    return (len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_periodic_runs_query(spark, texts):
    rows = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert rows == {i: expected_runs(i, t) for i, t in texts.items()}
    assert sum(r[0] for r in rows.values()) > 5


def test_periodic_runs_of_odd_rows(spark):
    same = "ab " * 9
    rows = [(1, None), (2, ""), (3, " \n\x0b "), (4, same), (4, same), (None, "x y " * 5 + "x"), (5, "q " * 5), (6, "é é " * 8), (7, "a b c d e f g " * 9000), (8, "c c c c c c d d d d d d")]
    docs = spark.createDataFrame([(*r, "r", 1) for r in rows], "doc_id long, text string, runs string, n long")
    got = sorted(((r.doc_id or 0), r.n_words, [tuple(x) for x in r.runs], r.collapsed[:20]) for r in periodic_runs.periodic_runs(docs).collect())
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 9, [(0, 9, 1)], "ab"), (4, 9, [(0, 9, 1)], "ab"), (0, 11, [(0, 11, 2)], "x y"), (5, 5, [], "q q q q q"), (6, 8, [(0, 8, 1)], "é é"), (7, 63000, [(0, 63000, 7)], "a b c d e f g"), (8, 12, [(0, 6, 1), (6, 6, 1)], "c d")])
    best = periodic_runs.periodic_runs(docs).select("doc_id", periodic_runs.longest(F.col("runs")).alias("best")).filter("doc_id = 8").first().best
    assert tuple(best) == (0, 6, 1)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    planted = periodic_runs.with_planted_repeats(docs)
    assert planted.count() == len(rows) and planted.filter("text IS NULL").count() == 1


# --- best-position search


def test_search_query(spark):
    with connect(SF) as con:
        assert compare(spark, con, "op12", queries.op12_best_position, queries.OP12_SQL, SF)[0] == "ok"


def test_terms():
    text = "Ünï-CODE x_y 9a b\x7f!" + "".join(map(chr, range(128)))
    want = [w.translate({c: c + 32 for c in range(65, 91)}).encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    assert best_position.terms(text) == want


def test_best_positions_lose_nothing():
    """Random lists with many equal impacts, small steps, several shards, against full scoring."""
    r = np.random.default_rng(4)
    spared = 0
    for trial in range(150):
        n, m, k = int(r.integers(1, 400)), int(r.integers(1, 9)), int(r.integers(1, 12))
        held = r.random((n, m)) < r.choice([0.05, 0.4, 0.9])
        impact = np.where(held, np.floor(1000 * r.pareto(1 + trial % 3, (n, m))).astype(np.int64) * (trial % 4 > 0) + r.integers(0, 3, (n, m)), 0)
        ids = r.permutation(3 * n)[:n]
        nulls = r.random(n) < 0.03
        asked = r.permutation(m + 2)[: int(r.integers(1, m + 2))]
        best = best_position.Best(k)
        for own in np.array_split(np.arange(n), int(r.integers(1, 4))):
            order = own[np.lexsort((ids[own], nulls[own]))]
            docs, terms = np.nonzero(held[order])
            shard = best_position.ShardLists(ids[order], nulls[order], docs, terms, impact[order][docs, terms])
            spared += len(order) - shard.search(np.sort(asked), best, step=1)
        scores = impact[:, asked[asked < m]].sum(axis=1)
        want = sorted((-s, x, 0 if x else i) for s, i, x in zip(scores.tolist(), ids.tolist(), nulls.tolist()) if s > 0)[:k]
        got = [(-s, x, 0 if x else i) for s, i, x in zip(best.scores.tolist(), best.ids.tolist(), best.nulls.tolist())]
        assert got == want
    assert spared > 1000


def test_search_of_odd_rows_in_blocks(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "--- ..."), (4, "apple pear"), (5, "apple pear"), (5, "apple pear"), (None, "apple"), (6, "Apple, PEAR! plum"), (7, "word " * 50_000 + "plum")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, terms string")
    asked = spark.createDataFrame([(10, "apple apple", 1), (11, None, 1), (12, "plum?", 1), (12, "plum?", 1), (None, "nowhere pear", 1)], "item_id long, text string, query int")
    whole = sorted(best_position.lexical_search(docs, asked, 3).collect(), key=str)
    for item, want in ((10, [(1, 4), (2, 5), (3, 5)]), (12, [(1, 6), (1, 6), (2, 7), (2, 7)]), (None, [(1, 4), (2, 5), (3, 5)])):
        assert sorted((r.rank, r.doc_id) for r in whole if r.item_id == item) == want
    assert all(r.score > 0 for r in whole) and len(whole) == 10
    monkeypatch.setattr(best_position, "BLOCK_TERMS", 1)
    assert sorted(best_position.lexical_search(docs, asked, 3).collect(), key=str) == whole
    assert best_position.lexical_search(docs.limit(0), asked).count() == 0
    assert best_position.lexical_search(docs, asked.limit(0)).count() == 0
    null_last = best_position.lexical_search(docs.filter("doc_id IS NULL OR doc_id = 5"), asked.filter("item_id = 10"), 9).collect()
    assert sorted((r.rank, r.doc_id or 0) for r in null_last)[-1][1] in (0, 5) and len(null_last) == 3


# --- MinHash groups


def test_signatures_agree_as_sets_do():
    """The share of equal bins estimates the similarity, for sets smaller and larger than the bins."""
    r = np.random.default_rng(5)
    for size in (5, 40, 300, 3000):
        agree = []
        for _ in range(40):
            both = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
            cut = len(both) // 10
            a, b = both[cut:], both[: len(both) - cut]
            similarity = (len(both) - 2 * cut) / len(both)
            agree.append((minhash.signature(a) == minhash.signature(b)).mean() - similarity)
        assert abs(np.mean(agree)) < 0.03
    one = minhash.bands(np.array([7], np.uint64))
    assert len(set(one.tolist())) == minhash.BANDS and (one == minhash.bands(np.array([7], np.uint64))).all()
    assert not (one == minhash.bands(np.array([7], np.uint64), 1)).any()


def test_minhash_query(spark, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op13_minhash(spark, SF).collect()}
    assert found == classes_by_hand(texts, 4, 80, 100)


def groups():
    """Near copies of one text, a chain that drifts away, and texts that share most of their words."""
    r = random.Random(3)
    base = [f"w{r.randrange(5000)}" for _ in range(60)]
    texts = {}
    for i in range(120):
        words = list(base)
        for _ in range(1 + i % 2):
            words[r.randrange(60)] = f"x{i}-{r.random()}"
        texts[1000 - i] = " ".join(words)
    words = [f"c{j}" for j in range(80)]
    for i in range(40):
        words[i] = f"d{i}"
        texts[2000 + i] = " ".join(words)
    for i in range(60):
        texts[3000 + i] = " ".join([*[f"t{j}" for j in range(70)], *[f"own{i // 2}-{j}-{i % 2 if j == 11 else 0}" for j in range(12)]])
    return texts


@pytest.mark.parametrize("way", ["outsiders", "blocks", "anew"])
def test_links_inside_buckets_of_several_components(spark, monkeypatch, way):
    monkeypatch.setattr(minhash, "PAIRS_PER_CLASS", 1000 if way == "outsiders" else 0)
    monkeypatch.setattr(minhash, "MOST_DEALT", 2 if way == "anew" else 10_000)
    monkeypatch.setattr(minhash, "HOT_SHARE", 1 << 40)  # all buckets of over WAYS classes are dealt out
    texts = groups()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dedup(docs).collect()}
    want = classes_by_hand(texts, 4, 80, 100)
    assert found == want
    assert 30 < len({c for _, c in want.values()}) < 150


def test_minhash_of_odd_rows(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (5, "one"), (6, long), (7, long), (None, "no id at all"), (None, None), (8, "no id at ALL"), (6, "other text of a repeated id")]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id long, text string, n long, signature string, key int, root int")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_dedup(docs).collect())
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (6, 977, 6, True), (7, 977, 6, False), (0, 1, 8, False), (0, 0, 0, True), (8, 1, 8, True), (6, 3, 6, True)])
    assert minhash.near_dedup(docs.limit(0)).count() == 0
    assert collections.Counter(r.kept for r in minhash.near_dedup(docs.filter("doc_id IS NULL")).collect()) == {True: 2}
