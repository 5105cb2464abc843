"""Token ids of blocks of texts, with numpy look-ups instead of one per word.

A block of texts is cut where neither a byte-level pre-tokenizer nor a
SentencePiece BPE model (whose pieces hold blanks at their front only) ever
joins two characters: before a blank that stands between two other
characters, and around a line break between two others.  The pieces get 64-bit
names; only distinct names are looked up, only pieces not seen lately are
encoded, and the ids of all texts are gathered with one numpy index.  Pieces of
more than ``LONGEST`` bytes are encoded each time, by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from feeflow.llm.bytehash import Rolling, mix

LONGEST = 64
MOST_PIECES = 500_000     # remembered; beyond it all are forgotten

# A character that starts with one of these bytes is not white space; lead
# bytes of blocks that hold some white space count as unsafe.
_SAFE = np.zeros(256, dtype=bool)
_SAFE[0x21:0x7F] = True
_SAFE[0xC3:0xE1] = True
_SAFE[0xE4:0xF5] = True
_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[0x21:0x7F] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b".,!?;:")] = True
_BLANK, _BREAK, _MARK_END = 0x20, 0x0A, 0x81   # 0x81 ends U+2581, SentencePiece's blank


def led_by_blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one blank before each, and their new bounds."""
    return (np.insert(data, offsets[:-1], np.uint8(_BLANK)),
            offsets + np.arange(len(offsets)))


def cut(data: np.ndarray, offsets: np.ndarray, at_marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the pieces of texts that each begin with a blank.

    ``at_marks`` also cuts between an ASCII letter and a mark after it, which a
    byte-level pre-tokenizer never joins (a SentencePiece model may): a word has
    one name whatever follows it."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[np.uint8(_BLANK)], data[:-1]])
    after = np.concatenate([data[1:], [np.uint8(_BLANK)]])
    first = (data == _BLANK) & _SAFE[after] & (before != _BLANK) & (before != _MARK_END)
    breaks = np.flatnonzero((data == _BREAK) & _GRAPHIC[before] & _SAFE[after])
    first[breaks] = True
    first[breaks + 1] = True
    if at_marks:
        first |= _MARKS[data] & _ASCII_LETTER[before]
    first[offsets[:-1]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(data))


class PieceIds:
    """Ids of pieces, remembered by name.  ``encode`` takes pieces as bytes and
    gives all their ids and the number of each piece's."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MOST_PIECES):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _learn(self, names: np.ndarray, pieces: list[bytes]) -> None:
        found, count = self.encode(pieces)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, found])
        places = np.searchsorted(self.names, names)
        self.names = np.insert(self.names, places, names)
        self.first = np.insert(self.first, places, first)
        self.count = np.insert(self.count, places, count)

    def lookup(self, raw: bytes, names: np.ndarray, starts: np.ndarray,
               ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of the pieces in order; ``raw`` holds them."""
        distinct, at, which = np.unique(names, return_index=True, return_inverse=True)
        if len(self.names) + len(distinct) > self.most:
            self.forget()
        place = np.searchsorted(self.names, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.names)
        new[inside] = self.names[place[inside]] != distinct[inside]
        long = (ends - starts)[at] > LONGEST
        wanted = np.flatnonzero(new & ~long)
        if len(wanted):
            self._learn(distinct[wanted], [raw[a:b] for a, b in zip(
                starts[at[wanted]].tolist(), ends[at[wanted]].tolist(), strict=True)])
            place = np.searchsorted(self.names, distinct)
        ids, place = self.ids, np.minimum(place, max(len(self.names) - 1, 0))
        first = self.first[place] if len(self.names) else np.zeros(len(distinct), np.int64)
        count = self.count[place] if len(self.names) else np.zeros(len(distinct), np.int64)
        which = which.reshape(-1)
        first, count = first[which], count[which]
        longs = np.flatnonzero((ends - starts) > LONGEST)
        if len(longs):   # by their bytes, each time
            found, own = self.encode([raw[a:b] for a, b in zip(
                starts[longs].tolist(), ends[longs].tolist(), strict=True)])
            count[longs], first[longs] = own, len(ids) + np.cumsum(own) - own
            ids = np.concatenate([ids, found])
        before = np.cumsum(count) - count
        return ids[np.repeat(first - before, count) + np.arange(int(count.sum()))], count


def piece_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(Rolling(data).ranges(starts, ends) + (ends - starts).astype(np.uint64))
