"""What a Python worker keeps from one step to the next."""

import re
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from tellerscope.llm import common
from tellerscope.llm.exact_dedup import exact_dedup
from tellerscope.llm.language_id import fit


class Steps:
    """Stands for a table: gives the function that its workers would run."""

    def mapInArrow(self, run, schema):
        return run


def held_mb() -> int:
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10


@pytest.mark.parametrize("own", [(), ("mine",)])
def test_a_step_lets_go_of_other_caches(own, monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {"mine": 1, "other": 2})
    run = common.map_rows(Steps(), lambda batch: list(common._KEPT), "x int", *own)
    assert list(run(iter([None]))) == [list(own)]


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_task_gives_memory_back():
    """Freed blocks go to the system though one behind them is still held."""
    behind = []

    def use(batch):
        blocks = [bytes(4000) for _ in range(40_000)]
        behind.append(blocks.pop())
        return batch

    before = held_mb()
    list(common.map_rows(Steps(), use, "x int")(iter([None])))
    assert behind and held_mb() - before < 60


def test_no_workers_of_another_kind(spark, monkeypatch):
    """The driver's small tables pass through no RDD of Python."""

    def refuse(*_):
        raise AssertionError("a list passes through Python workers")

    texts = [(i, lang, text) for lang, text in (("en", "the cat and the dog"), ("de", "der Hund und die Katze")) for i in range(40)]
    docs = common.stored(spark.createDataFrame(texts * 8, "doc_id long, lang string, text string"), "two-languages")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    assert fit(docs).languages == ["de", "en"]
    assert exact_dedup(docs).filter("keep_id = 39 AND group_size = 320").count() == 640
