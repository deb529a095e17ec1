"""Token ids by the tokenizers library, with a cache of the pieces of texts.

Both vocabularies used here treat the pieces between single blanks or line ends on their
own, and what stands before and behind the place where a Latin letter meets a sign. So each
distinct piece is encoded once by the library and then looked up. A text that
holds the name of an added token, such as an end mark, goes to the library as a whole. A piece of
Latin letters, with or without signs behind it, is one word for either
vocabulary and goes to the library's merge model directly; other pieces take the library's
whole way. Where blanks matter, a text in which white space meets white space goes to the
library as a whole.

The pieces of a batch are cut, hashed and looked up together as arrays. A hash only proposes a
known piece: its bytes are compared too.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

IDS = np.dtype("<u2")
#: Bytes of pieces of one generation, of which a worker keeps two.
MOST_BYTES = 24 << 20
#: Characters of text that are looked up together; a longer text is cut at a blank.
CHARACTERS = 1 << 19

_GAP, _LETTER, _SIGN = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x0A]] = _GAP
for _c in range(0x21, 0x7F):
    _KINDS[_c] = _LETTER if chr(_c).isalpha() else 0 if chr(_c).isdigit() else _SIGN
# One random number for each byte at each place of a piece (after 64 they repeat).
_RANDOM = np.random.default_rng(0).integers(0, 1 << 64, 64 << 8, np.uint64)
# U+0130 is left out, as its lower case is no single letter. All of these are in form NFC.
_LATIN = "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and c != 0x130)
_SIGNS = "".join(re.escape(chr(c)) for c in range(0x21, 0x7F) if _KINDS[c] == _SIGN and chr(c) != "'")
_GAPS = re.compile("[ \n]")
_WORD = re.compile(f"([{_LATIN}]+)([{_SIGNS}]{{0,3}})")


def _bytes(ids: list[int]) -> bytes:
    raw = array("H", ids)
    if sys.byteorder == "big":
        raw.byteswap()
    return raw.tobytes()


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    out = np.repeat(first - (ends - lengths), lengths)
    out += np.arange(len(out), dtype=out.dtype)
    return out


def _strings(blob: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(what the ``rows`` of ``blob`` hold, their lengths); row i ends at ``ends[i + 1]``."""
    lengths = ends[rows + 1] - ends[rows]
    return blob[_ranges(ends[rows], lengths)], lengths


class Pieces:
    """Distinct pieces with their ids, found by hash.

    A row holds a piece, its ids, and whether it is ``odd``: one at whose edge white space
    would change how its neighbours are encoded.
    """

    def __init__(self):
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.keys, self.key_ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_ends = np.zeros(0, IDS), np.zeros(1, np.int64)
        self.odd = np.zeros(0, bool)

    @property
    def bytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values())

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.rows[at], np.int32(-1))

    def add(self, hashes: np.ndarray, keys: np.ndarray, key_lengths: np.ndarray, ids: np.ndarray, id_lengths: np.ndarray, odd: np.ndarray) -> None:
        """More rows, by ascending ``hashes`` that are not held yet."""
        at, rows = np.searchsorted(self.hashes, hashes), np.arange(len(hashes), dtype=np.int32) + len(self.odd)
        self.hashes, self.rows = np.insert(self.hashes, at, hashes), np.insert(self.rows, at, rows)
        self.key_ends = np.append(self.key_ends, self.key_ends[-1] + np.cumsum(key_lengths))
        self.id_ends = np.append(self.id_ends, self.id_ends[-1] + np.cumsum(id_lengths))
        self.keys, self.ids, self.odd = np.append(self.keys, keys), np.append(self.ids, ids), np.append(self.odd, odd)


class LibraryEncoder:
    """Texts to bytes of little-endian unsigned 16-bit ids.

    ``blanks`` says whether blanks and line ends become part of tokens (byte-level BPE) or
    are dropped (BPE with word ends). Vocabularies of over 65,536 ids raise a ValueError.

    When there are too many pieces they become the old generation, out of which those that are
    asked for again come back.
    """

    def __init__(self, path: str, blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.model, self.blanks = self.library.model, blanks
        self.names = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # How byte-level vocabularies write bytes: visible ones as themselves, others from U+0100.
        seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(seen)]
        self.written = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.line_end = self.whole("\n")
        self.signs: dict[str, bytes] = {"": b""}
        self.first, self.old = Pieces(), Pieces()

    def whole(self, text: str) -> bytes:
        return _bytes(self.library.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        together: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if any(name in text for name in self.names):
                continue
            if len(text) > CHARACTERS:
                out[i] = self._long(text)
                continue
            if size + len(text) > CHARACTERS:
                self._into(out, together, texts)
                together, size = [], 0
            together.append(i)
            size += len(text)
        self._into(out, together, texts)
        return [self.whole(text) if ids is None else ids for ids, text in zip(out, texts)]

    def _into(self, out: list[bytes | None], numbers: list[int], texts: list[str]) -> None:
        # The line end set before a text gives ids that are no part of it.
        own = len(self.line_end) if self.blanks else 0
        for i, ids in zip(numbers, self._look_up(["\n" + texts[i] for i in numbers])):
            out[i] = ids if ids is None else ids[own:]

    def _long(self, text: str) -> bytes | None:
        text, at, parts = "\n" + text, 0, []
        while at < len(text):
            stop = max(text.rfind(" ", at + 1, at + CHARACTERS), text.rfind("\n", at + 1, at + CHARACTERS))
            if stop < 0:
                found = _GAPS.search(text, at + 1)
                stop = found.start() if found else len(text)
            part = text[at:stop]
            # What has no blank for so long is one piece, and not worth keeping.
            ids = self._piece(part) if len(part) > CHARACTERS else self._look_up([part])[0]
            if ids is None:
                return None
            parts.append(ids)
            at = stop
        return b"".join(parts)[len(self.line_end) if self.blanks else 0 :]

    def _look_up(self, texts: list[str]) -> list[bytes | None]:
        """Ids of texts that begin with a blank or line end; None for those to be encoded whole."""
        if not texts:
            return []
        if self.first.bytes > MOST_BYTES:
            self.first, self.old = Pieces(), self.first
        raw = [(t if self.blanks else t.replace("\n", " ")).encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        kinds = _KINDS[data]
        cut = kinds == _GAP
        cut[1:] |= (kinds[1:] == _SIGN) & (kinds[:-1] == _LETTER)
        starts = np.flatnonzero(cut)
        lengths = np.diff(starts, append=len(data))
        place = np.arange(len(data), dtype=np.int32)
        place -= np.repeat(starts.astype(np.int32), lengths)
        place &= 63
        place <<= 8
        place |= data
        hashes = np.add.reduceat(_RANDOM[place], starts)
        del kinds, cut, place

        distinct, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        rows = self.first.find(distinct)
        if (rows < 0).any():
            new = np.flatnonzero(rows < 0)
            self._learn(distinct[new], data, starts[one[new]], lengths[one[new]])
            rows = self.first.find(distinct)
        rows = rows[which]

        begin = np.searchsorted(starts, np.cumsum([0, *map(len, raw)]))
        odd = self.first.odd[rows]
        known, known_lengths = _strings(self.first.keys, self.first.key_ends, rows)
        if not np.array_equal(known_lengths, lengths):
            # Two pieces of one hash: what differs from the known one is encoded whole.
            same = known_lengths == lengths
            odd = odd | ~same
            known, data = known[np.repeat(same, known_lengths)], data[np.repeat(same, lengths)]
            starts, lengths, compared = np.cumsum(lengths[same]) - lengths[same], lengths[same], np.flatnonzero(same)
        else:
            compared = np.arange(len(rows))
        differ = known != data
        if differ.any():
            odd[compared[np.logical_or.reduceat(differ, starts)]] = True
        ids, n_ids = _strings(self.first.ids, self.first.id_ends, rows)
        ends = np.append(0, np.cumsum(n_ids))[begin].tolist()
        odd_before = np.append(0, np.cumsum(odd))[begin].tolist()
        return [None if odd_before[i] < odd_before[i + 1] else ids[ends[i] : ends[i + 1]].tobytes() for i in range(len(texts))]

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Adds the pieces of ``data`` that begin at ``starts``, from the old generation or the library."""
        again = self.old.find(hashes)
        back = again >= 0
        if back.any():
            rows, old = again[back], self.old
            self.first.add(hashes[back], *_strings(old.keys, old.key_ends, rows), *_strings(old.ids, old.id_ends, rows), old.odd[rows])
        hashes, starts, lengths = hashes[~back], starts[~back], lengths[~back]
        keys = data[_ranges(starts, lengths)]
        raw, ends = keys.tobytes(), np.cumsum(lengths).tolist()
        found = [self._piece(raw[a:b].decode()) for a, b in zip([0, *ends], ends)]
        ids = np.frombuffer(b"".join(x or b"" for x in found), IDS)
        self.first.add(hashes, keys, lengths, ids, np.array([len(x or b"") // 2 for x in found], np.int64), np.array([x is None for x in found], bool))

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a piece with the blank or line end before it; None for an odd one."""
        gap = piece[0] if piece[0] in " \n" else ""
        body = piece[1:] if gap else piece
        if not self.blanks:
            gap = ""
        elif not body or body[0].isspace() or body[-1].isspace():
            return None
        head = self.line_end if gap == "\n" else b""
        found = _WORD.fullmatch(body)
        if found is None:
            return head + self.whole(body if head else gap + body)
        word, signs = found.groups()
        if not self.blanks:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.written)
        behind = self.signs.get(signs)
        if behind is None:
            behind = self.signs[signs] = self.whole(signs)
        ids = _bytes([t.id for t in self.model.tokenize(self.written[32] + word if gap == " " else word)])
        return head + ids + behind
