"""Cached pieces against the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tellerscope.llm import library_tokens
from tellerscope.llm.library_tokens import LibraryEncoder

VOCABULARIES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]


def noise(n: int, letters: str) -> list[str]:
    r = random.Random(5)
    return ["".join(r.choices(letters, k=r.randrange(60))) for _ in range(n)]


def compare(path: str, encoder: LibraryEncoder, texts: list[str]) -> None:
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("name", "blanks"), VOCABULARIES)
def test_signs_behind_words(name, blanks):
    path = public_tokenizers.path(name)
    odd = ["a***", "it's's***", "b'***", "é.,\n***", "İ*** ı..", "a,\tb", "a. ", "A'LL.x@y.z (a) $b$$$$$$ c.", *noise(3000, " \n\t '’—slredvéß1Aa.,*<_")]
    compare(path, LibraryEncoder(path, blanks), odd)


@pytest.mark.parametrize(("name", "blanks"), VOCABULARIES)
def test_a_word_is_kept_once(name, blanks, monkeypatch):
    """Whatever signs follow, a word goes to the library once, and takes few bytes."""
    encoder, asked = LibraryEncoder(public_tokenizers.path(name), blanks), []
    words = ["".join(w) for w in zip(*[iter(random.Random(3).choices("aeiourstln", k=9 * 4000))] * 9)]
    lines = [w + s for w in words for s in ("", ",", ".", "***", "!!", "$$$")]
    encoder.encode(["\n".join(lines)])
    assert encoder.first.bytes < 80 * len(words)
    monkeypatch.setattr(encoder, "whole", lambda text, whole=encoder.whole: asked.append(text) or whole(text))
    encoder.encode(["x " + " ".join(lines)])
    assert len(asked) < 10


@pytest.mark.parametrize(("name", "blanks"), VOCABULARIES)
def test_pieces_of_one_hash(name, blanks, monkeypatch):
    path = public_tokenizers.path(name)
    monkeypatch.setattr(library_tokens, "_RANDOM", library_tokens._RANDOM & np.uint64(3))
    encoder = LibraryEncoder(path, blanks)
    for _ in range(2):
        compare(path, encoder, noise(500, " \nab.,"))


@pytest.mark.parametrize(("name", "blanks"), VOCABULARIES)
def test_texts_cut_at_blanks(name, blanks, monkeypatch):
    path = public_tokenizers.path(name)
    monkeypatch.setattr(library_tokens, "CHARACTERS", 7)
    compare(path, LibraryEncoder(path, blanks), ["ab cd\nef " * 9 + "x", "a" * 50, "b " + "a." * 20 + " c", "\n" + "a" * 9, "é" * 7, *noise(1000, " \nabc.,é")])
