"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tellerscope.llm import byte_bpe
from tellerscope.llm.exact_dedup import exact_dedup
from tellerscope.llm.language_id import identify
from tellerscope.llm.line_dedup import line_dedup
from tellerscope.llm.maxscore import top_k
from tellerscope.llm.ngram_join import ngram_join
from tellerscope.llm.packing import pack
from tellerscope.llm.tool_calls import TURN_SCHEMAS, calls_of_turns, link_tool_calls
from tellerscope.llm.warc import warc_index
from tellerscope.llm.wavelet import token_files

SCHEMA = "doc_id long, text string, lang string, n long, size string, digest int, root int, removed int, `start` int"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, LONG), (7, LONG), (None, "no id at all"),
    (None, None), (8, "!!! 123"), (9, "a line of text that has more than ten words in it, surely\nx"),
    (10, "a line of text that has more than ten words in it, surely\ny"), (6, "other text of a repeated id"),
]
BYTES, RANKS, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
OPERATORS = {
    "exact": exact_dedup,
    "ngram": lambda d: ngram_join(d)[0],
    "lines": line_dedup,
    "language": identify,
    "packing": lambda d: pack(d, WORDS).filter("start = 0"),  # the first piece
    "files": lambda d: token_files(d, BYTES),
    "bpe": lambda d: byte_bpe.encode(d, RANKS),
}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en" if t else None, 1, "s", 2, 3, 4, 5) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_row(spark, name):
    found = OPERATORS[name](frame(spark, ROWS)).select("doc_id").collect()
    assert sorted((r[0] is None, r[0] or 0) for r in found) == sorted((i is None, i or 0) for i, _ in ROWS)


def test_exact_dedup_defined_results(spark):
    rows = exact_dedup(frame(spark, ROWS)).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in rows if r.kept)
    assert kept == sorted([(False, i) for i in (2, 3, 5, 7, 8, 9, 10, 6)] + [(True, 0)])
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id in (1, 2)} == {(2, 3)}


def test_ngram_join_defined_results(spark):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join(frame(spark, ROWS), 3)[0].collect()}
    assert found[(1, 0)] == 1 and found[(2, 0)] == 2 and found[(3, 0)] == 3
    assert found[(4, 1)] == found[(5, 1)] == 4
    assert found[(7, 977)] == found[(6, 977)] == 6


def test_line_dedup_defined_results(spark):
    rows = {r.doc_id: (r.text, [tuple(x) for x in r.removed]) for r in line_dedup(frame(spark, ROWS)).collect() if r.doc_id in (1, 2, 7, 9, 10)}
    assert rows[1] == (None, []) and rows[2] == ("", [])
    assert rows[9][1] == [] and rows[10] == ("y", [(0, 58)])
    assert rows[7] == ("", [(0, len(LONG))])


def test_language_of_texts_without_letters(spark):
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify(frame(spark, ROWS)).collect()}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 8))
    assert found[9][0] == "en"


def test_nothing_learned(spark):
    rows = frame(spark, ROWS).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(rows).collect()} == {"und"}


def test_pages(spark):
    page = "<p>" + "x" * 200 + "</p>"
    odd = "http://[bad\r\nurl/ü"
    rows = [(3, "http://www.A.org/x#f", page), (2, "http://a.org/x", page), (2, "http://a.org/x", page), (None, None, page), (7, odd, None), (8, odd, "tiny"), (9, None, "tiny"), (10, "https://b.org?q", "\r\n\r\nWARC/1.1" + "é" * 99)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, size int, digest string")
    found = warc_index(pages).collect()
    assert len(found) == len(rows)
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in found)
    assert got == sorted([(3, 207, "revisit", 2), (2, 207, "response", None), (2, 207, "response", None), (0, 207, "revisit", 2), (7, 0, "response", None), (8, 4, "response", None), (9, 4, "response", None), (10, 210, "response", None)], key=lambda x: x[:3])
    assert warc_index(pages.limit(0)).count() == 0
    order = sorted(found, key=lambda r: (r.range_id, r.position))
    assert [r.url_key for r in order] == sorted(r.url_key for r in found)
    assert {r.url_key for r in found if r.page_id in (2, 3)} == {"org,a)/x"}


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [3.0]), (None, [9.0, 9.0]), (1, [5.0, 5.0]), (8, [-1.0, -1.0, 7.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(vectors).collect()}
    assert [got[(0, k)] for k in range(1, 6)] == [(1, 327680), (7, 196608), (6, 0), (50, -98304), (8, -196608)]
    assert got[(50, 1)] == (7, 98304) and len(got) == 10
    assert top_k(vectors.limit(0)).count() == 0


def test_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", None), (2, 1, "assistant", "?"), (None, 0, "user", "x"), (1, None, "user", "y"), (3, 0, None, "z"), (1, 0, "user", "hi"), (1, 1, "assistant", "again")]
    turns = spark.createDataFrame([(*r, "n") for r in rows], "conv_id long, turn long, role string, text string, name string")
    found = link_tool_calls(*calls_of_turns(turns), TURN_SCHEMAS).collect()
    got = sorted(str((r.conv_id, r.turn, r.status, r.n_results, r.valid, r.errors)) for r in found)
    assert got == sorted(map(str, [
        (1, 0, "answered", 2, True, ""), (1, 0, "answered", 2, True, ""), (1, 2, "pending", 0, False, "missing prompt"),
        (2, 1, "orphan", 1, False, "no call"), (None, 0, "pending", 0, True, ""), (1, None, "pending", 0, False, "missing turn"),
    ]))
    assert '"content":"again"' in [r.json for r in found if r.status == "answered"][0]
    assert link_tool_calls(*calls_of_turns(turns.limit(0)), TURN_SCHEMAS).count() == 0
