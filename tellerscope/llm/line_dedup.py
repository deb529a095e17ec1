"""Substring dedup by line or paragraph hashing.

A unit is a paragraph, a line, or a sentence of a line; sentences find passages that were put
inside a line, which whole lines miss. Every unit of at least ``min_words`` words is
normalised (lower case, single blanks) and hashed to 128 bits. Digests are grouped over all documents, and the occurrence that ranks
first, by document id and offset, stays; all others are cut out. The spans that went are
reported by their offsets in the original text.

The unit ``run``, as query and pipeline use it, compares paragraphs, lines and sentences at
once, and also runs of adjacent sentences: a sentence of few words goes where it stands in a run
that repeats as a whole.

Only ids, offsets and digests are shuffled before the decision; grouping combines before the
shuffle, and units of very frequent digests are dealt over several tasks.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerscope.llm.common import map_rows, spread_join, stored, tidied

# Where units end, for Python and Java alike: a unit keeps the separator behind it.
ENDS = {"paragraph": r"(?<=\n\n)", "line": r"(?<=\n)", "sentence": r"(?<=\n)|(?<=[.!?] )"}
ENDS["run"] = ENDS["sentence"]
MIN_WORDS = 8
HOT_SHARE = 1000
WAYS = 32


def runs(sizes: list[int], blocks: list[int], min_words: int) -> set[tuple[int, int]]:
    """(first, last) number of the runs of sentences that count; none begins or ends without words.

    ``sizes`` are the words of each sentence, ``blocks`` the numbers where lines and paragraphs
    begin and end. For each sentence there are the shortest runs of at least ``min_words`` words
    that begin and that end with it: any repeated run of so many words is the union of such runs.
    """
    full = [i for i, n in enumerate(sizes) if n]
    sums = [0, *itertools.accumulate(sizes[i] for i in full)]
    out, a, b = set(), 0, len(full) - 1
    for last in range(len(full)):
        while sums[last + 1] - sums[a + 1] >= min_words:
            a += 1
        if sums[last + 1] - sums[a] >= min_words:
            out.add((full[a], full[last]))
    for first in reversed(range(len(full))):
        while sums[b] - sums[first] >= min_words:
            b -= 1
        if sums[b + 1] - sums[first] >= min_words:
            out.add((full[first], full[b]))
    for begin, end in zip(blocks, blocks[1:]):
        x, y = bisect_left(full, begin), bisect_left(full, end)
        if x < y and sums[y] - sums[x] >= min_words:
            out.add((full[x], full[y - 1]))
    return out


def runs_of(parts: list[str], words: list[list[str]], min_words: int) -> list[tuple[int, int]]:
    """All runs of one text: sentences, runs of short ones, lines and paragraphs."""
    lines = [0, *(i + 1 for i, part in enumerate(parts) if part.endswith("\n"))]
    paragraphs = [0, *(i for i in lines[1:] if parts[i - 1] == "\n" or parts[i - 1].endswith("\n\n"))]
    sizes, out = [len(w) for w in words], set()
    for blocks in (lines, paragraphs):
        out |= runs(sizes, sorted({*blocks, len(parts)}), min_words)

    def closed(last: int) -> int:
        """A run takes along what follows without words in its line."""
        while last + 1 < len(parts) and not sizes[last + 1] and not parts[last].endswith("\n"):
            last += 1
        return last

    return sorted((first, closed(last)) for first, last in out)


def units(docs: DataFrame, unit: str = "run", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, number, last, start, stop, digest) of each unit that counts.

    ``start`` and ``stop`` are character offsets of the unit with its separator. A unit is the
    parts ``number`` to ``last`` of the text; only runs have more than one.
    """
    ends = re.compile(ENDS[unit])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text_hash, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "text_hash", "text"))):
                parts = ends.split(text)
                words = [part.lower().split() for part in parts]
                starts = [0, *itertools.accumulate(map(len, parts))]
                if unit == "run":
                    spans = runs_of(parts, words, min_words)
                else:
                    spans = [(i, i) for i, w in enumerate(words) if len(w) >= min_words]
                for number, last in spans:
                    plain = " ".join(words[number]) if number == last else " ".join(w for part in words[number : last + 1] for w in part)
                    digest = hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    rows.append((doc, text_hash, number, last, starts[number], starts[last + 1], digest))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text_hash", "number", "last", "start", "stop", "digest"])

    rows = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(tidied(split), "doc_id long, text_hash long, number int, last int, start long, stop long, digest binary")


def repeats(found: DataFrame) -> DataFrame:
    """The units that go: all but the first occurrence of each digest, and what overlaps it."""
    place = F.struct("doc_id", "text_hash", "start", "stop")
    groups = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("size"))
    groups = stored(groups.filter(F.col("size") > 1), "repeated-units")
    total = groups.agg(F.sum("size")).first()[0] or 0
    hot = [bytes(r[0]) for r in groups.filter(F.col("size") > max(WAYS, total // HOT_SHARE)).select("digest").collect()]
    joined = spread_join(found, groups.select("digest", "first"), "digest", hot, WAYS, ["doc_id", "start"])
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return joined.filter(~(same & (F.col("start") < F.col("first.stop")))).drop("first")


def without_spans(text: str, spans: list[tuple[int, int]], joined: bool) -> tuple[str, list[tuple[int, int]]]:
    """(text without the sorted ``spans``, the spans); with ``joined``, those that touch are one."""
    left, out, at = [], [], 0
    for start, stop in spans:
        left.append(text[at:start])
        at = max(at, stop)
        if joined and out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    left.append(text[at:])
    return "".join(left), out


def line_dedup(docs: DataFrame, unit: str = "run", min_words: int = MIN_WORDS, removed: str = "removed") -> DataFrame:
    """``docs`` with ``text`` cut, and the column ``removed``: array of (start, stop) in the original text.

    A cut unit goes with the separator behind it, so what follows a cut end of line moves up to
    the text before. A document that loses all its units keeps an empty
    text. A null text stays null. Of equal units in one document the first stays, if no
    document before holds it. A null id ranks before all ids; rows that repeat both id and
    text are one document, cut alike. An empty table gives no rows. All columns of ``docs``
    are kept (one of the name ``removed`` is replaced). With unit ``run``, a sentence goes if any run,
    line or paragraph that holds it goes; spans that touch are reported as one, and an
    occurrence that overlaps the first one of its own text stays. The work on a text grows with
    its length, however many of its units go.
    """
    found = stored(units(docs, unit, min_words), "units")
    spans = repeats(found).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("cut"))
    others = [c for c in docs.columns if c not in ("text", removed)]
    # Other columns travel as one, so that their names meet none of ours.
    rows = docs.select(F.struct(*others).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text"))
    same = rows["id"].eqNullSafe(spans["doc_id"]) & (rows["hash"] == spans["text_hash"])
    joined = rows.join(spans, same, "left").select("row", "text", "cut")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, gone = [], []
        for text, spans in zip(batch["text"], batch["cut"]):
            text, spans = text.as_py(), [(c["start"], c["stop"]) for c in spans.as_py() or []]
            if spans:
                text, spans = without_spans(text, spans, unit == "run")
            texts.append(text)
            gone.append([{"start": a, "stop": b} for a, b in spans])
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch["row"], pa.array(texts, pa.string()), pa.array(gone, kinds)], ["row", "text", "gone"])

    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("gone", spans_type)])
    done = map_rows(joined, cut, schema)
    return done.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != removed], F.col("gone").alias(removed))
