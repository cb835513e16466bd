"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes, over many short strings."""

from __future__ import annotations

import numpy as np

_BYTES = [np.uint64(64 - 8 * k) for k in range(1, 8)]


class Strings:
    """Byte strings laid out one after another, each closed by a border that sorts before any byte.

    Borders are told apart by their string's number, so that no two suffixes are equal. Bytes are raised by
    one, which UTF-8 leaves room for (its bytes end at 0xF4); 0 is the border.
    """

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]]).astype(np.int64)
        raw = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
        self.data = raw + np.uint8(1)
        self.borders = self.starts + self.sizes
        self.n = len(self.data)
        self.owner = np.repeat(np.arange(len(strings)), self.sizes + 1)
        self.border = self.borders[self.owner]
        self.left = np.minimum(self.border - np.arange(self.n), 8)  # bytes of the string in the word at a place
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        words = np.zeros(self.n, np.uint64)
        for k in range(8):
            words = words << np.uint64(8) | padded[k:k + self.n].astype(np.uint64)
        short = self.left < 8
        shift = (np.uint64(8) * (8 - self.left[short]).astype(np.uint64)) % np.uint64(64)
        words[short] = np.where(self.left[short] == 0, np.uint64(0), words[short] >> shift << shift)
        self.words = words

    def suffix_array(self) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes in order, rank of each suffix).

        Sorted by their first eight bytes, then groups that are still equal are refined by the rank of what
        follows, over twice the length each time. Groups of one are never touched again.
        """
        order = np.argsort(self.words, kind="stable")
        keys = self.words[order]
        opens = np.concatenate([[True], keys[1:] != keys[:-1]])
        first = np.maximum.accumulate(np.where(opens, np.arange(self.n), 0))
        rank = np.empty(self.n, np.int64)
        rank[order] = first
        rank[self.borders] = np.arange(len(self.borders))
        order[:len(self.borders)] = self.borders
        single = opens & np.concatenate([opens[1:], [True]])
        single[:len(self.borders)] = True
        open_places, step = np.flatnonzero(~single), 8
        while len(open_places):
            suffix = order[open_places]
            group = rank[suffix]
            behind = rank[np.minimum(suffix + step, self.border[suffix])]
            turn = np.argsort(group * self.n + behind, kind="stable")
            suffix, group, behind = suffix[turn], group[turn], behind[turn]
            order[open_places] = suffix
            opens = np.concatenate([[True], (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])])
            rank[suffix] = open_places[np.maximum.accumulate(np.where(opens, np.arange(len(suffix)), 0))]
            single = opens & np.concatenate([opens[1:], [True]])
            open_places, step = open_places[~single], step * 2
        return order, rank

    def common_prefixes(self, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """By place in ``order``: the length that a suffix has in common with the one before it.

        Kasai's walk from each suffix to the next longer-known one, for all strings in step: what is common at
        one place is at least one less at the next. Compared are eight bytes at a time.
        """
        common = np.zeros(self.n, np.int64)
        before = np.empty(self.n, np.int64)
        before[order[1:]] = order[:-1]
        before[order[0]] = self.borders[0]
        by_size = np.argsort(-self.sizes, kind="stable")
        starts, sizes = self.starts[by_size], self.sizes[by_size]
        held = np.zeros(len(starts), np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            alive = int(np.searchsorted(-sizes, -step, side="left"))
            here = starts[:alive] + step
            there = before[here]
            length = np.maximum(held[:alive] - 1, 0)
            going = np.arange(alive)
            while len(going):
                a, b = here[going] + length[going], there[going] + length[going]
                differ = self.words[a] ^ self.words[b]
                equal = (differ == 0).astype(np.int64)
                for shift in _BYTES:
                    equal += (differ >> shift) == 0
                more = np.minimum(equal, np.minimum(self.left[a], self.left[b]))
                length[going] += more
                going = going[more == 8]
            held[:alive] = length
            common[rank[here]] = length
        return common
