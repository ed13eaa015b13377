"""Token ids of whole texts, inside Python tasks, for a public tokenizer file.

The tokenizer splits at white space before its merges, so the ids of a text
are the ids of its white-space-free pieces put together; and it parts a letter
or digit from an ASCII mark, so a mark before white space is a piece of its
own.  It takes no heed of ASCII case.  Text is prose whose words repeat, so a
task keeps a memo from piece to ids and sends only pieces it hasn't met to the
tokenizers library, many in one call; the ids are cut apart again by their
offsets.  The memo has two generations: when the young one is full, it becomes
the old one, and what was old and not met again is forgotten.  So memory is
bounded, and what recurs stays.  Only ASCII white space cuts here: all of it
is white space to the tokenizer too, other white space stays inside a piece
and is left to the tokenizer.  A text that may hold one of the tokenizer's
added tokens is encoded as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from .common import worker_cache

#: Pieces in a generation of a task's memo, which has two; a piece takes some 200 bytes.
MEMO_PIECES = 250_000
CALL_PIECES = 500  # pieces in a call of the library

WINDOW = 4 << 20  # bytes of text cut into pieces at once
ALNUM, MARK, WHITE = 1, 2, 3  # classes of bytes; others are 0

#: Lower-case Latin-1 letters only: one word to the tokenizer, as it stands.
WORD = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")

PROBE = "One, two, été straße. THREE\n4! five; \"six\"  (seven) eight's, n\u00f6n-e."


def _classes():
    """Class of every byte of a lower-cased text."""
    kinds = np.zeros(256, dtype=np.uint8)
    for byte in range(33, 127):
        kinds[byte] = ALNUM if chr(byte).isalnum() else MARK
    kinds[list(b" \t\n\r\v\f")] = WHITE
    return kinds


def default_tokenizer() -> str:
    """Path of the default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def shared_encoder(path: str, memo_pieces: int = MEMO_PIECES) -> "Encoder":
    """One encoder for each worker process and file, with the memo last asked for."""
    cache = worker_cache("tokens")
    if ("encoder", path, memo_pieces) not in cache:
        for old in [k for k in cache if k[:2] == ("encoder", path)]:
            del cache[old]
        cache["encoder", path, memo_pieces] = Encoder(path, memo_pieces)
    return cache["encoder", path, memo_pieces]


def id_width(encoder: "Encoder", end_id: int) -> int:
    """Bytes that hold any id of the vocabulary and the end id."""
    return 2 if max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4


class Encoder:
    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same merges for pieces that need no normalising and hold one word
        self.merges = Tokenizer(self.tokenizer.model)
        steps = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(steps)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.memo_pieces = memo_pieces
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.encode([PROBE]) != [self._ids(PROBE)]:
            raise ValueError(f"{path}: its ids depend on case or white space, so pieces can't be encoded apart")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unseen(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """ids of distinct pieces, by calls over pieces joined by blanks."""
        out: dict[bytes, bytes] = {}
        plain = [p for p in pieces if WORD.fullmatch(p)]
        for at in range(0, len(plain), CALL_PIECES):
            some = plain[at : at + CALL_PIECES]
            got = self.merges.encode(b" ".join(some).decode(), add_special_tokens=False)
            cuts = np.searchsorted(np.array(got.word_ids), np.arange(len(some) + 1))
            out.update(self._cut(some, got.ids, cuts))
        others = [p for p in pieces if p not in out]
        for at in range(0, len(others), CALL_PIECES):
            some = others[at : at + CALL_PIECES]
            texts = [p.decode() for p in some]
            got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            first = np.fromiter((a for a, _ in got.offsets), dtype=np.int64, count=len(got.ids))
            cuts = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in texts)]))
            out.update(self._cut(some, got.ids, cuts))
        return out

    @staticmethod
    def _cut(pieces: list[bytes], ids: list[int], cuts: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        flat, at = np.array(ids, dtype="<u4").tobytes(), (4 * cuts).tolist()
        return ((p, flat[a:b]) for p, a, b in zip(pieces, at, at[1:]))

    def _met(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """ids of distinct pieces that the young memo lacks; it has them then."""
        old = {p: ids for p in pieces if (ids := self.old.get(p)) is not None}
        fresh = old | self._unseen([p for p in pieces if p not in old])
        if len(self.young) + len(fresh) > self.memo_pieces:
            self.young, self.old = {}, self.young
        if len(fresh) <= self.memo_pieces:
            self.young.update(fresh)
        return fresh

    def _pieces(self, raw: bytes, starts: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
        """By windows: (places of pieces in ``raw``, the distinct pieces, which one each is)."""
        import pyarrow as pa

        kinds = _classes()
        at = 0
        while at < len(raw):
            to = min(len(raw), at + WINDOW)
            while to < len(raw) and kinds[raw[to]] != WHITE:  # never within a piece
                to += 1
            part = np.frombuffer(raw, np.uint8, to - at, at)
            kind = kinds[part]
            solid = kind != WHITE
            inner = starts[np.searchsorted(starts, at, side="right") : np.searchsorted(starts, to)] - at
            after = np.append(kind[1:], WHITE)
            after[inner - 1] = WHITE  # a text ends there
            begins = solid.copy()
            begins[1:] &= ~solid[:-1] | ((kind[1:] == MARK) & (kind[:-1] == ALNUM) & (after[1:] == WHITE))
            begins[inner] = solid[inner]
            places = np.flatnonzero(begins)
            if len(places):
                signs = part[solid]
                ends = np.cumsum(solid, dtype=np.int32)[places] - 1
                offsets = np.append(ends, len(signs)).astype(np.int32)
                pieces = pa.BinaryArray.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(signs)])
                coded = pieces.dictionary_encode()
                yield places + at, coded.dictionary.to_pylist(), coded.indices.to_numpy()
            at = to

    def _encode_plain(self, raw: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them up to the end of each text) of lower-cased
        texts back to back, without added tokens."""
        out, places, lengths = [], [], []
        for where, distinct, which in self._pieces(raw, starts):
            ids = list(map(self.young.get, distinct))
            lost = [i for i, x in enumerate(ids) if x is None]
            if lost:
                fresh = self._met([distinct[i] for i in lost])
                for i in lost:
                    ids[i] = fresh[distinct[i]]
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            first = np.cumsum(size) - size
            each = size[which]
            begin = np.cumsum(each) - each
            flat = np.frombuffer(b"".join(ids), "<u4")
            out.append(flat[np.repeat(first[which] - begin, each) + np.arange(int(each.sum()))])
            places.append(where)
            lengths.append(each)
        if not out:
            return np.empty(0, "<u4"), np.zeros(len(starts), dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        last = np.searchsorted(np.concatenate(places), np.append(starts[1:], len(raw)))
        return np.concatenate(out), upto[last]

    def encode_block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(32-bit ids of all texts back to back, how many up to the end of each)."""
        raws = [(t or "").encode().lower() for t in texts]
        whole = [i for i, r in enumerate(raws) if any(token in r for token in self.added)]
        for i in whole:
            raws[i] = b""
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        ids, ends = self._encode_plain(b"".join(raws), np.cumsum(sizes) - sizes)
        for i in whole:
            own = np.frombuffer(self._ids(texts[i]), "<u4")
            ids = np.concatenate([ids[: ends[i]], own, ids[ends[i] :]])
            ends[i:] += len(own)
        return ids, ends

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        ids, ends = self.encode_block(list(texts))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]
