"""Deep-shallow sorting of fixed-length windows of a byte array.

Multikey quicksort with characters of eight bytes orders the windows to a shallow depth; each pass only
looks at groups that are still tied. Groups tied at that depth have a long common prefix; a blind trie
orders the rest of each: a suffix goes down by the branching bytes alone, is compared once with the
leaf it reaches, and the first difference says where it belongs.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zeros stand after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    for i in range(8):
        out <<= np.uint64(8)
        out |= padded[i : i + len(out)]
    return out


class BlindTrie:
    """Strings of one length, ordered; a leaf holds all that are equal."""

    def __init__(self, length: int):
        self.top = 8 * (length - 1)
        self.bits = 8 * length
        self.root = None

    def add(self, value: int, item: int) -> None:
        """``value`` is the string as a big-endian number."""
        if self.root is None:
            self.root = (value, [item])
            return
        top, path, node = self.top, [], self.root
        while type(node) is list:
            path.append(node)
            children = node[1]
            node = children.get(value >> (top - node[0]) & 255) or next(iter(children.values()))
        differs = node[0] ^ value
        if not differs:
            node[1].append(item)
            return
        depth = (self.bits - differs.bit_length()) & ~7  # of the first differing byte, in bits
        above, below = None, self.root
        for one in path:
            if one[0] >= depth:
                break
            above = one
            below = one[1].get(value >> (top - one[0]) & 255)
        leaf = (value, [item])
        if type(below) is list and below[0] == depth:
            below[1][value >> (top - depth) & 255] = leaf
            return
        split = [depth, {node[0] >> (top - depth) & 255: below, value >> (top - depth) & 255: leaf}]
        if above is None:
            self.root = split
        else:
            above[1][value >> (top - above[0]) & 255] = split

    def leaves(self) -> list[list[int]]:
        """The items of each leaf, in the strings' order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += [child for _, child in sorted(node[1].items(), reverse=True)]
            else:
                out.append(node[1])
        return out


def rank_windows(
    data: np.ndarray, starts: np.ndarray, length: int, shallow: int = SHALLOW
) -> np.ndarray:
    """The rank of ``data[s : s + length]`` for each start; equal windows share a rank.

    Ranks follow the order of the windows' bytes; they have gaps. ``shallow`` is a multiple of eight;
    windows that are no longer than it are sorted less deep.
    """
    shallow = min(shallow, (length - 1) // 8 * 8)
    words = _words(data)
    rank = np.zeros(len(starts), dtype=np.int64)
    tied = np.arange(len(starts))
    for depth in range(0, shallow, 8):
        if not len(tied):
            return rank
        word = words[starts[tied] + depth]
        order = np.lexsort((word, rank[tied]))
        tied, word = tied[order], word[order]
        group = rank[tied]
        new = np.ones(len(tied), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(tied)))
        # A group's members get its old rank plus the number of members before them.
        opened = np.ones(len(tied), dtype=bool)
        opened[1:] = group[1:] != group[:-1]
        base = np.maximum.accumulate(np.where(opened, np.arange(len(tied)), 0))
        rank[tied] = np.repeat((group + np.arange(len(tied)) - base)[first], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
    if not len(tied):
        return rank
    tied = tied[np.argsort(rank[tied], kind="stable")]
    edges = np.flatnonzero(np.diff(rank[tied], prepend=-1, append=-2))
    whole, rest = data.tobytes(), length - shallow
    at = (starts[tied] + shallow).tolist()
    number = int.from_bytes
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if hi - lo == 2:
            a, b = at[lo], at[lo + 1]
            one, two = whole[a : a + rest], whole[b : b + rest]
            if one != two:
                rank[tied[lo + 1 if one < two else lo]] += 1
            continue
        trie = BlindTrie(rest)
        for i in range(lo, hi):
            trie.add(number(whole[at[i] : at[i] + rest], "big"), i)
        before = 0
        for leaf in trie.leaves():
            if before:
                rank[tied[leaf]] += before
            before += len(leaf)
    return rank
