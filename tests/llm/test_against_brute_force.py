"""Operators against plain Python, library or SQL results on the small tables."""

import base64
import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerscope.llm import exact_dedup as exact_module
from tellerscope.llm import library_tokens, maxscore, ngram_join, queries
from tellerscope.llm.byte_bpe import Encoder
from tellerscope.llm.components import components
from tellerscope.llm.exact_dedup import PerfectHash, Shard, exact_dedup, shard_blob
from tellerscope.llm.language_id import LEAST_SCORE, fit, held_out, identify, with_language
from tellerscope.llm.library_tokens import LibraryEncoder
from tellerscope.llm.line_dedup import line_dedup
from tellerscope.llm.packing import combinations, least_squares, plan
from tellerscope.llm.tool_calls import link_tool_calls
from tellerscope.llm.warc import LoserTree
from tellerscope.llm.wavelet import WaveletMatrix, dump_shard, load_shard

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(n, alphabet, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(14))) for _ in range(n)]


# --- n-gram join


def classes_by_hand(texts, k, num, den):
    sets = {i: frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if (w := t.encode().lower().split()) else frozenset() for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k,similarity", [(3, (90, 100)), (5, (8, 10))])
def test_ngram_join_of_documents(docs, texts, k, similarity):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs, k, similarity)[0].collect()}
    assert found == classes_by_hand(texts, k, *similarity)


def test_ngram_join_of_chains_and_groups(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(5000)}" for _ in range(60)]
    texts = {}
    for i in range(150):  # a group of near copies, a chain that drifts away, and templates
        words = list(base)
        words[r.randrange(60)] = f"x{i}"
        texts[1000 - i] = " ".join(words)
    words = [f"c{j}" for j in range(80)]
    for i in range(40):
        words[i] = f"d{i}"
        texts[2000 + i] = " ".join(words)
    for i in range(60):
        texts[3000 + i] = " ".join([*[f"t{j}" for j in range(30)], *[f"own{i}-{j}" for j in range(20)]])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for k, similarity in ((3, (85, 100)), (2, (9, 10)), (1, (5, 10))):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs, k, similarity)[0].collect()}
        assert found == classes_by_hand(texts, k, *similarity)


def test_families_of_several_blocks(spark, monkeypatch):
    """Long lists are compared by blocks of a few sets, and give no other groups."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(ngram_join, "LONG_LIST", 0.4)
    r = random.Random(8)
    texts = {}
    for i in range(90):  # templates, half of them in near pairs
        words = [*[f"t{j}" for j in range(40)], *[f"own{i // 2}-{j}" for j in range(24)]]
        words[50 + i % 10] = f"x{r.random() if i % 4 < 2 else i // 2}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for k, similarity in ((3, (90, 100)), (2, (8, 10)), (1, (7, 10))):
        found = {row.doc_id: (row.n_shingles, row.component_id) for row in ngram_join.ngram_join(docs, k, similarity)[0].collect()}
        assert found == classes_by_hand(texts, k, *similarity)


def test_links_are_similar(docs, texts):
    _, links = ngram_join.ngram_join(docs, 5, (8, 10))
    for a, b, shared in links.collect():
        x, y = (set(ngram_join.shingles(texts[i], 5).tolist()) for i in (a, b))
        assert len(x & y) == shared and 10 * shared >= 8 * len(x | y)


def test_prefixes_share_what_they_ask_for():
    r = np.random.default_rng(0)
    costs = r.integers(0, 60, 1 << 12).astype(np.uint8)
    for _ in range(300):
        n = int(r.integers(1, 120))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.append(a[r.random(len(a)) < 0.92], r.integers(0, 2**63, int(r.integers(0, 6)), dtype=np.uint64)))
        shared = len(np.intersect1d(a, b))
        if not len(b) or 10 * shared < 8 * len(np.union1d(a, b)):
            continue
        (x, p), (y, q) = (ngram_join.prefix(s, costs, (8, 10)) for s in (a, b))
        assert len(np.intersect1d(x, y)) >= min(p, q)


def test_components(spark):
    r = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(150)]
    root = {}
    for a, b in links:
        if a != b:
            x, y = root.setdefault(a, {a}), root.setdefault(b, {b})
            if x is not y:
                x |= y
                for i in y:
                    root[i] = x
    found = collections.defaultdict(set)
    for node, name in components(spark.createDataFrame(links, "a long, b long")).collect():
        found[name].add(node)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, {id(s): s for s in root.values()}.values()))


# --- exact dedup


def test_perfect_hash():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), "V32")
    mph, _ = PerfectHash.load(PerfectHash.build(keys).dump())
    assert sorted(mph.slots(keys)) == list(range(5000))
    rows = np.zeros(3000, [("digest", "V32"), ("winner", "<i8"), ("size", "<i8")])
    rows["digest"], rows["winner"] = keys[:3000], np.arange(3000)
    shard = Shard(shard_blob(rows))
    at, member = shard.find(keys)
    assert member.tolist() == [True] * 3000 + [False] * 2000
    assert (shard.slots["winner"][at[:3000]] == np.arange(3000)).all()


def test_exact_dedup_with_hot_group(spark, monkeypatch):
    monkeypatch.setattr(exact_module, "KEYS_PER_SHARD", 16)
    rows = [(i, "hot" if i % 3 else f"t{i // 6}") for i in range(900)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).drop("text_hash").collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = sorted((i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert sorted(map(tuple, found)) == want


def test_exact_dedup_with_history(spark):
    history = spark.createDataFrame([(100, "old"), (101, "old"), (102, "gone")], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "old"), (2, "new"), (3, "new"), (4, "own")], "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs, history).collect()}
    assert found == {1: (101, 2, False), 2: (3, 2, False), 3: (3, 2, True), 4: (4, 1, True)}


# --- tokens


def test_library_pieces():
    odd = ["", "a  b", " lead", "x\n\ny", "a \n b", "|", "a|b | c", "<|endoftext|> hi", "a <|endoftext|> b", "x<|startoftext|>y <|endoftext|>\n  <|endoftext|>", "<|ENDOFTEXT|> c", "<|endoftext", "é ΑΣ Σ", "a\x1cb", "İ Ǆ", "İ. x. Ю. ᾳ, e\u0301.", *noise(2000, " \n\t|'slredvé1Aa.,<Σ")]
    for name, blanks in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        want = [e.ids for e in library.encode_batch(odd, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u2").tolist() for x in LibraryEncoder(path, blanks).encode(odd)] == want


def test_token_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_files(spark, SF).collect()}
    at = 0
    for i in sorted(texts):
        ids = [*library.encode(texts[i], add_special_tokens=False).ids, 2]
        assert found[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_wavelet_matrix():
    r = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = (r.zipf(1.3, n) % 50257).astype("<u2")
        doc_ids, lengths, matrix = load_shard(dump_shard([None, 5], [n // 2, n - n // 2], ids))
        assert doc_ids == [None, 5] and lengths.tolist() == [n // 2, n - n // 2]
        assert (matrix.decode() == ids).all() and (matrix.access(np.arange(n)) == ids).all()
        for token in {*ids[:9].tolist(), 77}:
            at = np.flatnonzero(ids == token)
            assert matrix.count(token) == len(at) and matrix.count(token, 3, n // 2) == ((at >= 3) & (at < n // 2)).sum()
            assert [matrix.locate(token, k) for k in range(min(3, len(at)))] == at[:3].tolist()
            assert matrix.locate(token, len(at)) == -1
    assert WaveletMatrix.build(np.array([5], "<u2")).count(1 << 20) == 0


def test_pieces_with_a_small_cache(monkeypatch):
    monkeypatch.setattr(library_tokens, "MOST_BYTES", 500)
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), LibraryEncoder(path, False)
    for text in noise(200, " aeiou.,|"):
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.first.bytes < 3000


def test_byte_pairs(tiktoken_encoding):
    odd = ["", "'", "x's're'll y'all 'sa 'rex  \n 've\n'd", "a" * 500, "ab" * 300, " " * 50 + "x", "<|endoftext|>", "!!" * 100 + "'s", *noise(5000, " \n\t|'slredvmté1.,!\xa0　\x1c\x85中½²Ⅷ")]
    encoder = Encoder(RANKS)
    for text, ids in zip(odd, encoder.encode(odd)):
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
        assert encoder.pairs.decode(ids, encoder.pairs.offsets(ids)) == text.encode()


def test_every_seventh_code_point(tiktoken_encoding):
    encoder = Encoder(RANKS)
    odd = [f"a{chr(c)}a1{chr(c)}1" for c in range(0, 0x110000, 7) if not 0xD800 <= c <= 0xDFFF]
    for a in range(0, len(odd), 5000):
        for text, ids in zip(odd[a : a + 5000], encoder.encode(odd[a : a + 5000])):
            assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)


def test_byte_bpe_query(spark, texts, tiktoken_encoding):
    for r in queries.op7_byte_bpe(spark, SF).collect():
        ids = tiktoken_encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# --- packing


def test_packing(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op6_packing(spark, SF).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in texts.items():
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            own = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(own, "<u4").tobytes()))
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048
    tokens = sum(r.length for r in rows)
    assert len(by_sequence) * 2048 <= 1.03 * tokens + 2048


def test_plan_uses_each_piece_once():
    r = np.random.default_rng(1)
    for bins in (1, 7, 64):
        histogram = np.append(0, r.integers(0, 500, bins))
        used = np.zeros(bins + 1, int)
        for parts, times in plan(histogram):
            assert sum(parts) <= bins and times > 0
            np.add.at(used, list(parts), times)
        assert (used == histogram).all()
    assert plan(np.zeros(9, int)) == []


def test_least_squares_finds_exact_covers():
    parts = combinations(12)
    assert (parts.sum(axis=1) == 12).all() and len({tuple(p) for p in parts}) == len(parts)
    x = np.zeros(len(parts))
    x[::3] = 100
    histogram = np.bincount(parts.ravel(), weights=np.repeat(x, 3), minlength=13)
    histogram[0] = 0
    found = np.bincount(parts.ravel(), weights=np.repeat(least_squares(parts, histogram, 4000), 3), minlength=13)
    assert np.abs(found - histogram)[1:].max() < 0.01 * histogram.max()


# --- the others


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    known = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op8_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(known) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_unlearned_languages_are_rejected(spark):
    """Texts of other scripts, junk with one letter, and rows of a language that was left out."""
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = fit(known)
    odd = ["кошка сидела на ковре и смотрела в окно, потому что шел дождь", "这是一个中文句子没有学过的语言", "1234 5678 a 0000 ----"]
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(odd)], known.schema)
    assert with_language(rows, model).count() == 0
    assert all(r.score < LEAST_SCORE for r in identify(rows, model).collect())
    clean = known.filter(held_out() & F.col("text").rlike("[A-Za-z]"))
    assert with_language(clean, model).count() == clean.count() > 100
    left_out, english = fit(known.filter("lang <> 'en'")), known.filter("lang = 'en'")
    assert with_language(english, left_out).count() < 0.9 * english.count()


def test_top_k_prunes_without_loss(monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK", 32)
    r = np.random.default_rng(2)
    for scale in (40, 1 << 40):
        rows = np.floor(r.normal(size=(500, 24)) * scale).astype(np.int64) + (scale if scale > 40 else 0)
        rows[100:120] = rows[7]
        ids = r.permutation(500)
        index = maxscore.ShardIndex(ids, rows) if scale == 40 else maxscore.ShardIndex(ids, rows >> 20)
        table = rows if scale == 40 else rows >> 20
        for i in range(0, 500, 37):
            scores = table @ table[i]
            want = sorted(((-s, d) for s, d in zip(scores.tolist(), ids.tolist()) if d != ids[i]))[:5]
            assert [(-s, d) for d, s in zip(*(x.tolist() for x in index.search(ids[i], table[i], 5)))] == want


def test_loser_tree():
    r = random.Random(4)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((r.randrange(50), i) for _ in range(r.randrange(30))) for i in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_order_and_schema_of_calls(spark):
    calls = [
        (1, 5, "a", "add", '{"y":2,"x":1.50}', ["b", "gone"]), (1, 6, "b", "add", '{"x":"1"}', ["c"]), (1, 7, "c", "add", "no json", []),
        (1, 8, "d", "add", '{"x":1,"z":[1]}', ["e"]), (1, 9, "e", "other", "{}", ["d"]), (2, 1, "a", "add", '{"x":3}', None), (2, 2, "b", "add", "[1]", ["a"]),
    ]
    frame = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([(1, 9, "a", "3.5"), (2, 3, "zz", "?")], "conv_id long, turn long, call_id string, content string")
    schemas = {"add": {"x": ("number", True), "y": ("integer", False)}}
    found = {(r.conv_id, r.call_id): r for r in link_tool_calls(frame, results, schemas).collect()}
    assert {k: r.level for k, r in found.items() if k[0] == 1} == {(1, "a"): 2, (1, "b"): 1, (1, "c"): 0, (1, "d"): None, (1, "e"): None}
    assert {k: r.level for k, r in found.items() if k[0] == 2} == {(2, "a"): 0, (2, "b"): 0, (2, "zz"): 0}
    assert {k[1]: r.errors for k, r in found.items() if k[0] == 1} == {"a": "", "b": "x is no number", "c": "arguments are no object", "d": "unknown z", "e": "unknown tool"}
    assert found[(2, "zz")].status == "orphan" and found[(2, "b")].errors == "arguments are no object"
    assert found[(1, "a")].json == '{"arguments":{"x":1.5,"y":2},"call_id":"a","content":"3.5","conv_id":1,"errors":[],"level":2,"name":"add","status":"answered","turn":5}'


def test_runs_of_short_sentences_go(spark):
    """A passage of over 50 words in sentences of 4, at other places of other lines; short lines; overlaps."""
    passage = "".join(f"Kemo{i} lat{i} sor{i} vim{i}. " for i in range(14))
    line = "Dorea nem tal osk. Ilva ret sum ped nar.\n"
    docs = [(1, f"One host line before it. {passage}And more words.\n" + line), (2, f"Other words. Before.\n\n{passage}Not the same end here.\n"), (3, "Its own.\n" + line + "Dorea nem tal osk. Alone.\n"), (4, "Ha ho. " * 12)]
    found = {r.doc_id: (r.text, [tuple(x) for x in r.removed]) for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), "run").collect()}
    assert found[1] == (docs[0][1], [])
    start = len("Other words. Before.\n\n")
    assert found[2] == ("Other words. Before.\n\nNot the same end here.\n", [(start, start + len(passage))])
    assert found[3] == ("Its own.\nDorea nem tal osk. Alone.\n", [(9, 9 + len(line))])
    assert found[4] == ("Ha ho. " * 4, [(28, 84)])


def test_cutting_many_units_is_linear(spark):
    """40,000 repeated sentences of one text and another, and clashing columns."""
    text = "".join(f"One sentence number {i} that has eight words. " for i in range(40_000))
    rows = [(1, text, 7, 1, "a", 2), (2, "Its own. " + text + "End", 8, 2, "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed int, cut int, row string, hash int")
    start = time.time()
    found = {r.doc_id: r for r in line_dedup(docs.withColumnRenamed("removed", "was")).collect()}
    assert time.time() - start < 60
    assert found[1].text == text and found[2].text == "Its own. End" and [tuple(x) for x in found[2].removed] == [(9, 9 + len(text))]
    assert (found[2].was, found[2].cut, found[2].row, found[2].hash) == (8, 2, "b", 3)


def test_runs_leave_no_line(spark, docs):
    """On real rows, no line of eight words stays twice in what was not cut."""
    seen = collections.Counter()
    for r in line_dedup(docs.withColumn("text_before", F.col("text")), "run").collect():
        gone = {i for a, b in r.removed for i in range(a, b)}
        place = 0
        for line in re.split(r"(?<=\n)", r.text_before or ""):
            seen[" ".join(line.lower().split())] += not gone.issuperset(range(place, place + len(line))) and len(line.split()) >= 8
            place += len(line)
    assert max(seen.values()) == 1
