"""Token ids of many texts: each distinct piece of a batch is encoded once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.shared import ragged, raw, strings, words

#: White space beyond 0x20 and 0x09-0x0D; a text that has any is encoded in one go, as is one that holds a special token's string.
RARE_SPACE = "[\u0085   -     　\x1c-\x1f]"
#: Bytes with which such characters begin in UTF-8, and the first one of special tokens; other texts need no closer look.
_SUSPECT = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F, 0x3C, 0xC2, 0xE1, 0xE2, 0xE3])


class Encoder:
    """Ids of texts by a file of the tokenizers library, equal to encoding each whole text.

    Both kinds of file cut a text at the start of every run of white space and
    never join across it, so a text's ids are the ids of its pieces one after
    another. ``spaces`` says that white space itself gets ids and so stays at
    the front of its piece; otherwise pieces are bare words. Ids of pieces seen
    before are kept by a 128-bit hash of the piece, up to ``room`` pieces at a
    time, in a few flat arrays.
    """

    def __init__(self, path: str, spaces: bool, end_id: int | None, room: int = 1_000_000):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        special = "|".join(re.escape(t.content) for t in self.model.get_added_tokens_decoder().values())
        self.whole = f"(?i){special}|{RARE_SPACE}" if special else RARE_SPACE
        # a token that takes no white space along with it
        apart = [(i, t.content) for i, t in self.model.get_added_tokens_decoder().items() if not (t.lstrip or t.rstrip or t.single_word)]
        self.gap_id, self.gap = apart[0] if apart else (None, None)
        self.spaces, self.end_id, self.room = spaces, end_id, room
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # halves of the hashes; keys ascend
        self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(pieces, add_special_tokens=False)]

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces not seen before, piece after piece, and how many each has.

        Many pieces go into one call. Bare words stand in one text with spaces
        between them, and a token belongs to the word that it begins in. Pieces
        with their white space are parted by a special token, at which the model
        cuts a text before anything else; no piece holds one.
        """
        ids, sizes = [], []
        for at in range(0, len(pieces), 8192):  # what the library returns is many times larger than its ids
            part = pieces[at: at + 8192]
            one = self._by_offsets(part) if not self.spaces else self._by_gaps(part) if self.gap else self._alone(part)
            ids.append(one[0])
            sizes.append(one[1])
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode(pieces)
        return np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found], np.int64)

    def _by_gaps(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode([self.gap.join(pieces[i: i + 256]) + self.gap for i in range(0, len(pieces), 256)])
        ids = np.concatenate([np.array(f, np.int32) for f in found])
        ends = np.flatnonzero(ids == self.gap_id)
        return ids[ids != self.gap_id], np.diff(ends, prepend=-1) - 1

    def _by_offsets(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        found = self.model.encode_batch([" ".join(pieces[i: i + 256]) for i in range(0, len(pieces), 256)], add_special_tokens=False)
        ids, owner = [], []
        for i, one in enumerate(found):
            own = lengths[i * 256: (i + 1) * 256]
            first = np.fromiter((o[0] for o in one.offsets), np.int64, len(one))
            owner.append(np.searchsorted(np.cumsum(own) - own, first, side="right") - 1 + i * 256)
            ids.append(np.array(one.ids, np.int32))
        return np.concatenate(ids), np.bincount(np.concatenate(owner), minlength=len(pieces))

    def _known(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each distinct piece stand in ``flat``, and how many it has; new pieces are encoded first."""
        from xxhash import xxh3_128_digest as digest

        if len(self.keys) + len(distinct) > self.room:
            self._forget()
        both = np.frombuffer(b"".join(map(digest, distinct.cast(pa.binary()).to_pylist())), "<u8").reshape(-1, 2)
        key, check = both[:, 0], both[:, 1]
        place = np.searchsorted(self.keys, key)
        inside = place < len(self.keys)
        place[~inside] = 0
        hit = inside & (self.keys[place] == key) & (self.checks[place] == check) if len(self.keys) else inside
        start, size = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        start[hit], size[hit] = self.start[place[hit]], self.size[place[hit]]
        new = np.flatnonzero(~hit)
        if len(new):
            ids, sizes = self._new(distinct.take(pa.array(new)).to_pylist())
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used: self.used + len(ids)] = ids
            start[new], size[new] = self.used + np.cumsum(sizes) - sizes, sizes
            self.used += len(ids)
            order = np.argsort(key[new], kind="stable")
            new = new[order]
            at = np.searchsorted(self.keys, key[new])
            self.keys, self.checks = np.insert(self.keys, at, key[new]), np.insert(self.checks, at, check[new])
            self.start, self.size = np.insert(self.start, at, start[new]), np.insert(self.size, at, size[new])
        return start, size

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        if not self.spaces:
            return words(texts, None)
        offsets, data = raw(texts)
        chars = np.frombuffer(data, np.uint8)
        space = (chars == 32) | ((chars >= 9) & (chars <= 13))
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        if len(chars):
            cut[offsets[:-1][np.diff(offsets) > 0]] = True
        at = np.flatnonzero(cut).astype(np.int32)
        counts = np.diff(np.searchsorted(at, offsets))
        return strings(np.append(at, len(data)).astype(np.int32), data), counts.astype(np.int64)

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts are encoded whole."""
        offsets, data = raw(texts)
        at = np.flatnonzero(_SUSPECT[np.frombuffer(data, np.uint8)])
        odd = np.diff(np.searchsorted(at, offsets)) > 0
        if odd.any():
            odd[odd] = pc.match_substring_regex(texts.filter(pa.array(odd)), self.whole).to_numpy(zero_copy_only=False)
        return odd

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order with each text's end id, and how many each text has."""
        texts = texts.cast(pa.string()).fill_null("")
        odd = self._odd(texts)
        pieces, counts = self._pieces(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        coded = pieces.dictionary_encode()
        start, size = self._known(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        size = size[at]
        ids = self.flat[ragged(start[at], size)]
        before = np.concatenate([[0], np.cumsum(size)])
        bound = np.concatenate([[0], np.cumsum(counts)])
        lengths = np.diff(before[bound])
        if not odd.any() and self.end_id is None:
            return ids, lengths
        tail = [] if self.end_id is None else [self.end_id]
        if odd.any():
            whole = iter(self._encode(texts.filter(pa.array(odd)).to_pylist()))
            rows = np.split(ids, np.cumsum(lengths)[:-1])
            rows = [np.array((next(whole) if o else list(r)) + tail, np.int32) for r, o in zip(rows, odd)]
            return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        out = np.full(len(ids) + len(lengths), self.end_id, np.int32)
        out[ragged(np.cumsum(lengths + 1) - lengths - 1, lengths)] = ids
        return out, lengths + 1


def encoder(path: str, spaces: bool, end_id: int | None) -> Encoder:
    """The encoder of this Python worker; later tasks of the worker find what it knows."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_starloom_encoders", {})
    key = (path, spaces, end_id)
    if key not in held:
        held[key] = Encoder(path, spaces, end_id)
    return held[key]
