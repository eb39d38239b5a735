"""Token ids of whole texts, through a table of words already seen.

For tokenizers that drop white space, never join across it, lower-case, and cut
between letters or digits and other ASCII signs (but for the apostrophe).  The
ids of a text are then those of its units: runs without white space, cut where a
sign of that kind meets an ASCII letter or digit.  Units are hashed in numpy,
known ones are looked up in a hash table, new ones go to the tokenizer, many at
a time.  A text with a special token's string goes to it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from corpusgrove.llm.hashing import GOLDEN, PIECE, SPACES, constants, mix, pieces, text_bytes

SLOTS = 1 << 20
FULL = 1 << 19
SIGNS = np.zeros(256, bool)
SIGNS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
PLAIN = np.zeros(256, bool)
PLAIN[[c for c in range(128) if chr(c).isalnum()]] = True
CAPITALS = np.zeros(256, bool)
CAPITALS[65:91] = True


class WordTable:
    """Units by 64-bit hash, with the place and number of their ids in ``store``."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.values = constants(256, 9)
        self.step, self.back = np.uint64(GOLDEN | 1), np.uint64(pow(GOLDEN | 1, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.place = np.zeros(SLOTS, np.int32)
        self.length = np.zeros(SLOTS, np.uint16)
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = self.words = 0

    def _units(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-case bytes, starts, ends and hashes of the units."""
        # a capital before a byte beyond ASCII stays: a mark may follow that joins with it
        lower = CAPITALS[data]
        lower[:-1] &= data[1:] < 128
        low = data + (lower.view(np.uint8) << 5)
        space, sign, plain = SPACES[data], SIGNS[data], PLAIN[data]
        begin = ~space
        follows = np.zeros(len(data), bool)
        follows[1:] = ~space[:-1] & ~((sign[:-1] & plain[1:]) | (plain[:-1] & sign[1:]))
        follows[cuts[cuts < len(data)]] = False
        starts = np.flatnonzero(begin & ~follows)
        nexts = np.append(starts[1:], len(data))
        # a unit ends where the next begins or at the first white space
        blank = np.flatnonzero(space)
        at = np.searchsorted(blank, starts)
        ends = np.minimum(nexts, np.append(blank, len(data))[at])
        if len(cuts):
            ends = np.minimum(ends, cuts[np.searchsorted(cuts, starts, "right").clip(max=len(cuts) - 1)])
        if len(self.up) < len(data):
            n = max(len(data), 2 * PIECE)
            up, down = np.full(n, self.step), np.full(n, self.back)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[low] * self.up[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.down[starts])
        return low, starts, ends, hashes | np.uint64(1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of every hash, -1 if it is not in the table."""
        out = np.full(len(hashes), -1, np.int64)
        open_, slot = np.arange(len(hashes)), (hashes >> np.uint64(44)).astype(np.int64)
        while len(open_):
            key = self.keys[slot]
            hit = key == hashes[open_]
            out[open_[hit]] = slot[hit]
            go = ~hit & (key != 0)
            open_, slot = open_[go], (slot[go] + 1) % SLOTS
        return out

    def _insert(self, hashes: np.ndarray, place: np.ndarray, length: np.ndarray) -> None:
        """Puts distinct new hashes into free slots."""
        rest, slot = np.arange(len(hashes)), (hashes >> np.uint64(44)).astype(np.int64)
        while len(rest):
            free = self.keys[slot] == 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            take = np.zeros(len(rest), bool)
            take[first] = True
            take &= free
            self.keys[slot[take]] = hashes[rest[take]]
            self.place[slot[take]] = place[rest[take]]
            self.length[slot[take]] = length[rest[take]]
            rest, slot = rest[~take], (slot[~take] + 1) % SLOTS

    def _learn(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        text = low.tobytes()
        words = [text[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        ids, counts = [], []
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            got = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.array([o[0] for o in got.offsets], np.int64)
            stops = np.searchsorted(begins, np.cumsum([len(w) + 1 for w in some]))
            ids.append(np.array(got.ids, np.uint32))
            counts.append(np.diff(stops, prepend=0))
        new, counts = np.concatenate(ids), np.concatenate(counts)
        if self.used + len(new) > len(self.store):
            self.store = np.concatenate((self.store, np.zeros(max(len(new), len(self.store)), np.uint32)))
        self.store[self.used : self.used + len(new)] = new
        self._insert(hashes, (self.used + np.cumsum(counts) - counts).astype(np.int32), counts.astype(np.uint16))
        self.used += len(new)
        self.words += len(words)

    def piece(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between ``cuts``, and how many each has."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(cuts) - 1, np.int64)
        low, starts, ends, hashes = self._units(data, cuts)
        # more ids than 16 bits count, or more words than the table holds: straight to the tokenizer
        whole = (ends - starts) >= 1 << 14
        if self.words + len(hashes) > FULL:
            self.clear()
        slot = self._find(hashes)
        new = np.flatnonzero((slot < 0) & ~whole)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            pick = new[np.sort(first)]
            self._learn(low, starts[pick], ends[pick], hashes[pick])
            slot[new] = self._find(hashes[new])
        length = np.where(whole, 0, self.length[slot]).astype(np.int64)
        place = np.where(whole, 0, self.place[slot]).astype(np.int64)
        store = self.store
        if whole.any():
            long = [np.array(self.tokenizer.encode(low[a:b].tobytes().decode(), add_special_tokens=False).ids, np.uint32) for a, b in zip(starts[whole], ends[whole])]
            length[whole] = [len(x) for x in long]
            place[whole] = len(store) + np.cumsum(length[whole]) - length[whole]
            store = np.concatenate((store, *long))
        stop = np.cumsum(length)
        ids = store[np.repeat(place - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
        total = np.concatenate(([0], stop))[np.searchsorted(starts, cuts)]
        return ids, np.diff(total)

    def _special_rows(self, data: np.ndarray, cuts: np.ndarray) -> list[int]:
        text = data.tobytes()
        if not any(s in text for s in self.special):
            return []
        return [k for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if any(s in text[a:b] for s in self.special)]

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some rows at a time: all their ids, and how many each row has."""
        data, offsets = text_bytes(column)
        for first, last in pieces(offsets):
            part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            odd = self._special_rows(part, cuts)
            if odd:
                for k in range(len(cuts) - 1):
                    text = part[cuts[k] : cuts[k + 1]]
                    if k in odd:
                        ids = np.array(self.tokenizer.encode(text.tobytes().decode(), add_special_tokens=False).ids, np.uint32)
                        yield ids, np.array([len(ids)])
                    else:
                        yield self._long(text)
            elif len(part) > 8 * PIECE:
                yield self._long(part)
            else:
                yield self.piece(part, cuts)

    def _long(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One text, in pieces that end at white space."""
        out, at = [], 0
        blank = np.flatnonzero(SPACES[text])
        while at < len(text):
            k = np.searchsorted(blank, at + 4 * PIECE)
            to = int(blank[k]) if k < len(blank) else len(text)
            out.append(self.piece(text[at:to], np.array([0, to - at]))[0])
            at = to
        ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
        return ids, np.array([len(ids)])


def remembered(path: str) -> WordTable:
    """The table of a tokenizer file, kept with the library for a worker's next task."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_remembered", {})
    if path not in kept:
        kept[path] = WordTable(tokenizers.Tokenizer.from_file(path))
    return kept[path]
