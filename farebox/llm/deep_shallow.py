"""Deep-shallow suffix sorting of one task's suffixes.

Multikey quicksort orders all suffixes to a shallow depth. Suffixes that still
agree there form groups, and a blind trie orders each group by comparing every
member with one other only.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def _words(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as one big-endian character."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(WORD):
        out = out << np.uint64(8) | buf[at + k]
    return out


def _multikey_quicksort(buf: np.ndarray, starts: np.ndarray, shallow: int):
    """Order to ``shallow`` bytes, and the (slot, size) of the groups that agree there.

    All groups are split in three around their own pivots at once: smaller and
    larger characters stay at their depth, equal ones go on with the next.
    """
    n = len(starts)
    order, item, slot = np.empty(n, np.int64), np.arange(n), np.arange(n)
    group, depth = np.zeros(n, np.int64), np.zeros(1, np.int64)
    deep: list[tuple[int, int]] = []
    while len(item):
        word = _words(buf, starts[item] + depth[group])
        first = np.searchsorted(group, np.arange(len(depth)))
        size = np.diff(np.append(first, len(item)))
        a, b, c = word[first], word[first + size // 2], word[first + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[group]
        part = group * 3 + (word >= pivot) + (word > pivot)
        by = np.argsort(part, kind="stable")
        item, part = item[by], part[by]
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sizes = np.diff(np.append(begins, len(part)))
        depths = depth[part[begins] // 3] + WORD * (part[begins] % 3 == 1)
        order[slot] = item
        done = (sizes == 1) | (depths >= shallow)
        deep += [(int(slot[b]), int(s)) for b, s in zip(begins[done & (sizes > 1)], sizes[done & (sizes > 1)], strict=True)]
        live = np.repeat(~done, sizes)
        group = np.repeat(np.cumsum(~done) - 1, sizes)[live]
        item, slot, depth = item[live], slot[live], depths[~done]
    return order, deep


class _Node:
    __slots__ = ("depth", "child")

    def __init__(self, depth: int, child: dict):
        self.depth, self.child = depth, child


def blind_trie(data: bytes, starts: list[int], known: int, limit: int) -> tuple[list[int], list[int]]:
    """Order of suffixes that agree in ``known`` bytes, and each one's common prefix with the one before.

    An inner node keeps a depth and one branch per byte there, a leaf the list of
    suffixes that are equal up to ``limit``. A suffix descends by its branch bytes
    alone, is compared with the leaf it reaches, and branches off where they differ.
    """

    def common(x: int, y: int) -> int:
        diff = int.from_bytes(data[x + known : x + limit], "little") ^ int.from_bytes(data[y + known : y + limit], "little")
        return known + ((diff & -diff).bit_length() - 1 >> 3) if diff else limit

    root: _Node | list = [0]
    for i in range(1, len(starts)):
        s, node = starts[i], root
        while type(node) is _Node:
            node = node.child.get(data[s + node.depth]) or next(iter(node.child.values()))
        depth = common(s, starts[node[0]])
        if depth == limit:
            node.append(i)
            continue
        above, node = None, root
        while type(node) is _Node and node.depth < depth:
            above, node = node, node.child[data[s + node.depth]]
        if type(node) is _Node and node.depth == depth:
            node.child[data[s + depth]] = [i]
            continue
        leaf = node
        while type(leaf) is _Node:
            leaf = next(iter(leaf.child.values()))
        new = _Node(depth, {data[starts[leaf[0]] + depth]: node, data[s + depth]: [i]})
        if above is None:
            root = new
        else:
            above.child[data[s + above.depth]] = new

    order, lcp, stack = [], [], [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if type(node) is list:
            order += node
            lcp += [shared] + [limit] * (len(node) - 1)
        else:
            ways = sorted(node.child, reverse=True)
            stack += [(node.child[b], node.depth) for b in ways[:-1]] + [(node.child[ways[-1]], shared)]
    return order, lcp


def sort_suffixes(buf: np.ndarray, starts: np.ndarray, limit: int, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of the suffixes at ``starts``, compared over ``limit`` bytes.

    ``lcp[i]`` is the common prefix of the i-th and the one before, up to
    ``limit``. Every start needs ``limit`` bytes after it.
    """
    shallow = min(shallow, limit) // WORD * WORD
    starts = np.asarray(starts, dtype=np.int64)
    if not len(starts):
        return starts, starts
    order, deep = _multikey_quicksort(buf, starts, shallow)
    lcp = np.zeros(len(starts), dtype=np.int64)
    lcp[1:] = _shared(buf, starts[order[:-1]], starts[order[1:]], shallow)
    pairs = np.array([slot for slot, size in deep if size == 2], dtype=np.int64)
    for at in range(0, len(pairs), 8192):  # a trie of two leaves is one comparison
        p = pairs[at : at + 8192]
        x, y = starts[order[p]], starts[order[p + 1]]
        same = _shared(buf, x, y, limit)
        last = np.minimum(same, limit - 1)
        swap = (same < limit) & (buf[x + last] > buf[y + last])
        order[p], order[p + 1] = np.where(swap, order[p + 1], order[p]), np.where(swap, order[p], order[p + 1])
        lcp[p + 1] = same
    data = buf.tobytes() if any(size > 2 for _, size in deep) else b""
    for slot, size in deep:
        if size > 2:
            members = order[slot : slot + size]
            by, shared = blind_trie(data, starts[members].tolist(), shallow, limit)
            order[slot : slot + size] = members[by]
            lcp[slot + 1 : slot + size] = shared[1:]
    return order, lcp


def _shared(buf: np.ndarray, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each pair, up to ``limit``."""
    out, live = np.full(len(x), limit, dtype=np.int64), np.arange(len(x))
    for at in range(0, limit, WORD):
        width = min(WORD, limit - at)
        differ = np.stack([buf[x[live] + at + k] != buf[y[live] + at + k] for k in range(width)])
        found = differ.any(axis=0)
        out[live[found]] = at + differ[:, found].argmax(axis=0)
        live = live[~found]
        if not len(live):
            break
    return out
