"""Token ids of whole texts, inside a task.

``Encoder`` gives exactly ``Tokenizer.encode(text, add_special_tokens=False)``.
A byte-level pre-tokenizer never joins a single blank to what stands before
it, nor a line break between two other characters to either side, so a text
may be cut there and pieces seen lately are looked up.  A new piece that is one
run of letters is one pre-token: the tokenizer's model takes it directly, which
costs a third of a whole ``encode``.  Texts that hold a special token's string,
and tokenizers of another kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from feeflow.llm.piece_ids import PieceIds, cut, led_by_blank, piece_names

_RUN = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_SIDE_MARKS = ".,"
_CACHE_PIECES = 300_000   # in each of two generations
_PLAIN = "\u0250"         # letters below this are letters in every Unicode version

PIECES_KEPT = 1_500_000   # of a block encoder, about 40 bytes each
WORDS_KEPT = 50_000       # words whose ids help with new pieces (word and marks)

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others count up from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    alphabet = dict(enumerate(_byte_alphabet()))

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        before = made.get("pre_tokenizer") or {}
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and not made.get("normalizer")
                     and not made.get("post_processor"))
        self.special = [t["content"] for t in made.get("added_tokens", [])]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str] | None:
        if not self.cuts or any(s in text for s in self.special):
            return None
        if "\0" in text or _RUN.search(text):
            return _SAFE.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pieces not yet known; a word and the marks after it are
        separate tokens, so each word is encoded without them."""
        split: dict[str, tuple[str, str]] = {}
        wanted = set()
        for piece in pieces:
            word = piece.rstrip(_SIDE_MARKS)
            if word and word != piece and word[-1] < _PLAIN and word[-1].isalpha():
                split[piece] = word, piece[len(word):]
                wanted.update(split[piece])
            else:
                wanted.add(piece)
        new = []
        known, tokenize, blank = self.known, self.tokenizer.model.tokenize, self.alphabet[32]
        for piece in wanted:
            if piece in known:
                continue
            word = piece[1:] if piece[:1] == " " else piece
            if not word.isalpha():
                new.append(piece)
            elif word.isascii():
                known[piece] = _packed([t.id for t in tokenize(word if word is piece else blank + word)])
            elif max(word) < _PLAIN:
                known[piece] = _packed([t.id for t in tokenize(
                    piece.encode().decode("latin-1").translate(self.alphabet))])
            else:
                new.append(piece)
        for i in range(0, len(new), 4096):
            part = new[i: i + 4096]
            for piece, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False),
                                strict=True):
                known[piece] = _packed(e.ids)
        for piece, (word, marks) in split.items():
            known[piece] = known[word] + known[marks]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHE_PIECES:  # what is in use moves on, the rest goes
            self.known, self.older = {}, self.known
        cut = [self._pieces(t) for t in texts]
        unknown: set[str] = set()
        for pieces in cut:
            if pieces is not None:
                unknown.update(pieces)
        unknown -= self.known.keys()
        again = unknown & self.older.keys()
        self.known.update((piece, self.older[piece]) for piece in again)
        unknown -= again
        self._learn(unknown)
        get = self.known.__getitem__
        return [b"".join(map(get, pieces)) if pieces is not None else
                _packed(self.tokenizer.encode(t, add_special_tokens=False).ids)
                for t, pieces in zip(texts, cut, strict=True)]

    def ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some pieces that were cut where a pre-tokenizer cuts, and
        the number of each piece's."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        if self.cuts:
            self._learn(set(texts))
            found = [self.known[t] for t in texts]
            if len(self.known) > WORDS_KEPT:   # PieceIds remembers the pieces
                self.known = {}
        else:
            found = self.encode(texts)
        return (np.frombuffer(b"".join(found), dtype="<i4"),
                np.fromiter((len(x) >> 2 for x in found), np.int64, len(found)))


class BlockEncoder:
    """Ids of whole blocks of texts: the ids that ``Encoder`` gives, text by
    text, with numpy look-ups of the pieces (:mod:`feeflow.llm.piece_ids`)."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.special = [t.encode() for t in self.encoder.special]
        self.pieces = PieceIds(self.encoder.ids, PIECES_KEPT)

    def _whole(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Texts to be encoded whole: all, if the tokenizer is of another kind;
        else those that hold a special token's string."""
        if not self.encoder.cuts:
            return np.arange(len(offsets) - 1)
        places = []
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                places.append(at)
                at = raw.find(token, at + 1)
        # a string that begins in one text and ends in the next is encoded whole needlessly
        return np.unique(np.searchsorted(offsets, np.array(places, dtype=np.int64), side="right") - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; ids per text)."""
        n = len(offsets) - 1
        raw = data.tobytes()
        whole = self._whole(raw, offsets)
        led, bounds = led_by_blank(data, offsets)
        starts, ends = cut(led, bounds, at_marks=True)
        row = np.searchsorted(bounds, starts, side="right") - 1
        starts = starts + (starts == bounds[row])      # without the blank before the text
        keep = (ends > starts) & ~np.isin(row, whole)
        starts, ends, row = starts[keep], ends[keep], row[keep]
        flat, per_piece = self.pieces.lookup(led.tobytes(), piece_names(led, starts, ends), starts, ends)
        count = np.bincount(row, weights=per_piece, minlength=n).astype(np.int64)
        if len(whole):
            at = np.concatenate([[0], np.cumsum(count)])
            parts = [flat[at[i]: at[i + 1]] for i in range(n)]
            for i in whole.tolist():
                text = raw[offsets[i]: offsets[i + 1]].decode("utf-8", "replace")
                parts[i] = np.array(self.encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)
                count[i] = len(parts[i])
            flat = np.concatenate(parts)
        count += 1
        out = np.empty(int(count.sum()), dtype="<i4")
        last = np.zeros(len(out), dtype=bool)
        last[np.cumsum(count) - 1] = True
        out[last], out[~last] = end_id, flat
        return out, count


_BLOCKS: dict[str, BlockEncoder] = {}


def block_encoder(path: str) -> BlockEncoder:
    """One block encoder per worker process and vocabulary file."""
    if path not in _BLOCKS:
        _BLOCKS[path] = BlockEncoder(path)
    return _BLOCKS[path]
