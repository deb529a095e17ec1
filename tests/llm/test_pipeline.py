"""Each stage of the pipeline against plain Python, on what the stage before it kept."""

import collections
import os
import re

import public_tokenizers
import pytest
from conftest import SF
from test_against_brute_force import classes_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from tellerscope.llm import line_dedup
from tellerscope.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, text_hash string"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, documents before, rows after) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), name)
        out.append((name, {r.doc_id: r for r in docs.collect()}, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def kept(stages, name):
    before, after = stages[name]
    rows = after.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return before, {r.doc_id: r for r in rows}


def test_order_and_columns(stages, spark):
    assert list(stages) == ["language_id", "exact_dedup", "ngram_join", "line_dedup", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_language_keeps_what_has_letters(stages):
    before, after = kept(stages, "language_id")
    assert set(after) == {i for i, r in before.items() if r.text and any(map(str.isalpha, r.text))}


def test_exact_keeps_the_largest_id(stages):
    before, after = kept(stages, "exact_dedup")
    best = {}
    for i, r in before.items():
        best[r.text] = max(i, best.get(r.text, i))
    assert set(after) == set(best.values())


def test_near_keeps_the_smallest_id(stages):
    before, after = kept(stages, "ngram_join")
    groups = classes_by_hand({i: r.text for i, r in before.items()}, 5, 8, 10)
    assert set(after) == {i for i, (_, first) in groups.items() if i == first}
    assert all(after[i].text == before[i].text for i in after)


def units_by_hand(text):
    """(start, stop, words) of the units of unit "run": by trying out, for each sentence, all ends and all beginnings."""
    parts = re.split(r"(?<=\n)|(?<=[.!?] )", text)
    words = [part.lower().split() for part in parts]
    full = [i for i, w in enumerate(words) if w]
    size = lambda a, b: sum(map(len, words[a : b + 1]))
    found = set()
    for x, a in enumerate(full):
        found |= {(a, b) for b in [b for b in full[x : x + 9] if size(a, b) >= line_dedup.MIN_WORDS][:1]}
        found |= {(b, a) for b in [b for b in full[max(0, x - 8) : x + 1] if size(b, a) >= line_dedup.MIN_WORDS][-1:]}
    for split in (r"(?<=\n)", r"(?<=\n\n)"):
        at = 0
        for block in re.split(split, text):
            n = len([part for part in re.split(r"(?<=\n)|(?<=[.!?] )", block) if part])
            own = [i for i in full if at <= i < at + n]
            if own and size(own[0], own[-1]) >= line_dedup.MIN_WORDS:
                found.add((own[0], own[-1]))
            at += n
    starts = [0]
    for part in parts:
        starts.append(starts[-1] + len(part))
    for a, b in found:
        c = b
        while c + 1 < len(parts) and not words[c + 1] and not parts[c].endswith("\n"):
            c += 1
        yield starts[a], starts[c + 1], " ".join(w for part in words[a : b + 1] for w in part)


def test_lines_keep_the_first(stages):
    before, after = kept(stages, "line_dedup")
    seen, cut = {}, 0
    for i in sorted(before):
        text = before[i].text
        gone = set()
        for start, stop, key in sorted(units_by_hand(text)):
            first = seen.setdefault(key, (i, stop))
            if first[0] != i or start >= first[1]:
                gone.update(range(start, stop))
        left = "".join(c for j, c in enumerate(text) if j not in gone)
        cut += len(text) - len(left)
        assert after[i].text == left and after[i].n_chars == len(left)
    assert cut > 1000


def test_packing_holds_every_token(stages):
    before, after = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    held = collections.Counter()
    for r in after.collect():
        held[r.doc_id] += r.length
    assert held == {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in before.items()}


def test_odd_rows_and_columns(spark):
    text = "a plain line of english text that is long enough to be told by the machines\nand another one"
    rows = [(1, None), (2, ""), (3, text), (3, text), (3, text + " more"), (4, text), (None, text), (None, None), (5, "..."), (6, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), True, "x") for i, t in rows], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), name)
        if name == "exact_dedup":
            got = sorted((r.doc_id, r.text) for r in after.collect())
            assert got == [(3, text + " more"), (4, text), (6, "word " * 30_000)]
        if name == "ngram_join":
            assert sorted(r.doc_id for r in after.collect()) == [3, 6]
        docs = after
    assert docs.count() > 0


def test_clashing_columns_pass_through(spark):
    names = ["removed", "__id", "__hash", "__cut", "__way", "row", "cut", "id", "hash", "start", "runs", "n", "key", "removed before"]
    line = "a plain line of english text that is long enough to be told by the machines\n"
    rows = [(i, f"document {i} has words of its own, this one is number {i}\n{line}", "en", *[f"{name} {i}" for name in names]) for i in (1, 2)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", *names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", *names]
    found = {r.doc_id: r for r in docs.collect()}
    assert set(found) == {1, 2} and all(found[i][name] == f"{name} {i}" for i in found for name in names)
    assert line in found[1].text and line not in found[2].text


def test_work_folders_go(spark):
    """A stage deletes what the stages before it left, but not what its input reads."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    once = stored(corpus_pipeline.exact(spark, docs, SF), "exact")
    left = list(corpus_pipeline._LEFT)
    assert left and all(os.path.isdir(p.removeprefix("file:")) for p in left)
    lazy = corpus_pipeline.exact(spark, once, SF)
    assert not any(os.path.isdir(p.removeprefix("file:")) for p in left)
    again = corpus_pipeline.language(spark, lazy, SF)  # reads folders of the stage before
    assert again.count() <= once.count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    assert docs.count() == 0
