"""Deep-shallow sorting of byte strings, and what repeats follow from the sorted order.

The strings are the suffixes (cut at a bound) that start at chosen places of texts. Shallow
part: multikey quicksort on eight bytes at a time, all open groups in one pass, down to a fixed
depth. Deep part: groups that still agree there go into blind tries, which compare a string
with one leaf only and keep branch depths and single bytes, not the long common prefixes.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the shallow part compares.
SHALLOW = 64


class BlindTrie:
    """A trie that keeps, per inner node, the depth at which its strings part, and their bytes there."""

    __slots__ = ("root", "strings")

    def __init__(self, strings: list[bytes], depth: int):
        self.strings = strings
        self.root = 0  # a leaf is the number of a string, an inner node [depth, {byte: node}, equal strings]
        for i in range(1, len(strings)):
            self._add(i, depth)

    def _leaf(self, node) -> int:
        while not isinstance(node, int):
            node = node[2][0] if node[2] else next(iter(node[1].values()))
        return node

    def _add(self, i: int, depth: int) -> None:
        text, node = self.strings[i], self.root
        while not isinstance(node, int):  # blind: follow bytes at branch depths only
            below = node[1].get(text[node[0]]) if node[0] < len(text) else None
            if below is None:
                break
            node = below
        other = self.strings[self._leaf(node)]
        common = shared_prefix(text, other, depth)
        above, key, node = None, None, self.root
        while not isinstance(node, int) and node[0] < common:
            above, key = node, text[node[0]]
            node = node[1][key]
        if not isinstance(node, int) and node[0] == common:
            if common == len(text):
                node[2].append(i)
            else:
                node[1][text[common]] = i
            return
        parted = [common, {}, []]
        for entry, string in ((node, other), (i, text)):
            if common == len(string):
                if isinstance(entry, int):
                    parted[2].append(entry)
                else:  # an inner node lies deeper than its string ends: it cannot
                    raise AssertionError("a node below the end of its strings")
            else:
                parted[1][string[common]] = entry
        if above is None:
            self.root = parted
        else:
            above[1][key] = parted

    def in_order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out.append(node)
            else:
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
                stack.extend(reversed(node[2]))
        return out


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """How many bytes two strings share at their start; `known` of them are known to be."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    while high - low > 16:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    while a[low] == b[low]:
        low += 1
    return low


def padded(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, backwards: bool = False) -> np.ndarray:
    """Strings as rows of a matrix, zeros behind them; backwards: read from starts-1 down."""
    column = np.arange(width)
    at = starts[:, None] - 1 - column if backwards else starts[:, None] + column
    inside = column < lengths[:, None]
    out = np.zeros((len(starts), width), np.uint8)
    out[inside] = raw[at[inside]]
    return out


def deep_shallow_order(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of padded strings by (group, bytes, length)."""
    n, width = rows.shape
    order = np.argsort(group, kind="stable")
    open_group = np.zeros(n, np.int64)
    open_group[1:] = np.cumsum(np.diff(group[order]) != 0)
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = rows
    words = words.view(">u8")
    depth = 0
    active = np.arange(n)  # places in order whose group has more than one member
    while depth < min(SHALLOW, width) and len(active):
        sizes = np.bincount(open_group[active])
        active = active[sizes[open_group[active]] > 1]
        if not len(active):
            break
        key = words[order[active], depth // 8]
        by = np.lexsort((key, open_group[active]))
        order[active] = order[active][by]
        key, own = key[by], open_group[active]
        new = np.concatenate([[True], (np.diff(key.astype(np.uint64)) != 0) | (np.diff(own) != 0)])
        open_group[active] = n * (depth // 8 + 1) + np.cumsum(new)
        # numbers stay in order only among themselves: renumber by first place
        _, open_group = np.unique(open_group, return_inverse=True)
        first = np.full(open_group.max() + 1, n)
        np.minimum.at(first, open_group, np.arange(n))
        open_group = first[open_group]
        depth += 8
    if depth < width and len(active):
        cuts = np.flatnonzero(np.diff(open_group)) + 1
        begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [n]])
        for a, b in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist()):
            members = order[a:b]
            strings = [rows[i, : lengths[i]].tobytes() for i in members.tolist()]
            known = min(depth, *map(len, strings))
            order[a:b] = members[BlindTrie(strings, known).in_order()]
    return order


def neighbour_prefixes(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each string of an order shares with the one before it (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        differ = rows[a] != rows[b]
        common = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.minimum(common, np.minimum(lengths[a], lengths[b]))
    return out


def nearest_smaller(shared: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """What each member of a line shares most with one of smaller nth; shared: with the one before it (-1: another line).

    Only the nearest of smaller nth on either side matters, for sharing falls with the distance.
    """
    best = np.full(len(nth), -1)
    for backwards in (False, True):
        stack: list[tuple[int, int]] = []  # (nth, shared with the member above it), nth rising
        places = range(len(nth) - 1, -1, -1) if backwards else range(len(nth))
        between = (np.append(shared[1:], -1) if backwards else shared).tolist()
        order = nth.tolist()
        for i in places:
            common = between[i]
            if common < 0:
                stack.clear()
            while stack and stack[-1][0] > order[i]:
                common = min(common, stack.pop()[1])
            if stack:
                best[i] = max(best[i], common)
            stack.append((order[i], common))
    return best


def repeated_offsets(
    right: np.ndarray, right_len: np.ndarray, left: np.ndarray, left_len: np.ndarray, group: np.ndarray, window: int, nth: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each place: the least and the greatest o such that the window from o bytes before it occurs at another place of its group.

    nth: an order of the places; then the other place must come before it in that order.

    right: the bytes from the place on; left: those before it, backwards; the window at o takes o bytes
    of left and window-o of right. Places without a repeated window get (window, -1). Two places share the
    windows window-r ... l, if they share r bytes to the right and l to the left. In right order, the places
    that share r bytes stand together; going from deep to shallow r, each such run is put into left order,
    where the neighbour of a place shares most with it.
    """
    n = len(group)
    least, most = np.full(n, window), np.full(n, -1)
    if n < 2:
        return least, most
    by_right = deep_shallow_order(right, right_len, group)
    shared_right = neighbour_prefixes(right, right_len, by_right)
    shared_right[1:][np.diff(group[by_right]) != 0] = -1
    shared_right[0] = -1
    by_left = deep_shallow_order(left, left_len, group)
    left_rank = np.empty(n, np.int64)
    left_rank[by_left] = np.arange(n)
    for depth in np.unique(shared_right[shared_right > 0])[::-1].tolist():
        run = np.cumsum(shared_right < depth)
        grew = np.unique(run[shared_right == depth])
        inside = np.flatnonzero(np.isin(run, grew))
        member = by_right[inside]
        by = np.lexsort((left_rank[member], run[inside]))
        member, own = member[by], run[inside][by]
        shared = neighbour_prefixes(left, left_len, member)
        shared[1:][np.diff(own) != 0] = -1
        shared[0] = -1
        best = np.maximum(shared, np.append(shared[1:], -1)) if nth is None else nearest_smaller(shared, nth[member])
        hit = best >= window - depth
        who = member[hit]
        most[who] = np.maximum(most[who], best[hit])
        least[who] = np.minimum(least[who], window - depth)
    return least, most
