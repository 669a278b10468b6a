"""Deep-shallow sorting of byte strings of one length: multikey quicksort to a shallow depth, blind tries below it.

Defined cases: equal strings keep the order of their places; no strings give an empty order. The strings are pieces of one
length, whatever the length of the texts they are cut out of, so nulls and empty texts do not come here.
"""

from __future__ import annotations

import numpy as np

#: Multikey quicksort compares this many 8-byte words of a group before a blind trie takes over.
SHALLOW_WORDS = 3
#: Groups this small go to a blind trie at once.
SMALL = 24


class _Node:
    __slots__ = ("children", "depth", "leaf")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.leaf, self.children = depth, leaf, {}


def blind_trie(strings: list[bytes]) -> list[int]:
    """The order of distinct strings of one length.

    A node holds only the depth at which its strings part and a child for each byte there. A new string first follows
    its bytes blindly to some leaf, is compared with that leaf once to learn how far they agree, and is put in at that
    depth on the same way.
    """
    if len(strings) == 1:
        return [0]
    length = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]

    def agree(a: int, b: int) -> int:
        return length - ((numbers[a] ^ numbers[b]).bit_length() + 7) // 8

    root = None
    for k, s in enumerate(strings):
        if root is None:
            root = k
            continue
        way = root
        while isinstance(way, _Node):
            way = way.children.get(s[way.depth], way.leaf)
        depth = agree(k, way)
        parent, at = None, root
        while isinstance(at, _Node) and at.depth < depth:
            parent, at = at, at.children[s[at.depth]]
        if isinstance(at, _Node) and at.depth == depth:
            at.children[s[depth]] = k
            continue
        leaf = at.leaf if isinstance(at, _Node) else at
        node = _Node(depth, leaf)
        node.children[strings[leaf][depth]] = at
        node.children[s[depth]] = k
        if parent is None:
            root = node
        else:
            parent.children[s[parent.depth]] = node
    out, left = [], [root]
    while left:
        at = left.pop()
        if isinstance(at, _Node):
            left += [at.children[b] for b in sorted(at.children, reverse=True)]
        else:
            out.append(at)
    return out


def deep_shallow(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a matrix of bytes: for each row its class (equal rows share one) in ascending order of the strings, and for
    each class how many bytes it has in common with the class before it (0 for the first)."""
    n, length = rows.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = -(-length // 8)
    padded = np.zeros((n, words * 8), np.uint8)
    padded[:, :length] = rows
    keys = padded.view(">u8").astype(np.uint64)
    order: list[np.ndarray] = []

    def by_trie(part: np.ndarray) -> None:
        texts: dict[bytes, list[int]] = {}
        for i in part.tolist():
            texts.setdefault(padded[i].tobytes(), []).append(i)
        distinct = list(texts)
        order.append(np.array([i for k in blind_trie(distinct) for i in texts[distinct[k]]], np.int64))

    todo = [(np.arange(n), 0)]
    while todo:
        part, depth = todo.pop()
        if not len(part):
            continue
        if len(part) <= SMALL or depth >= min(SHALLOW_WORDS, words):
            by_trie(part)
            continue
        k = keys[part, depth]
        pivot = np.sort(k[:: max(1, len(k) // 9)])[len(k[:: max(1, len(k) // 9)]) // 2]
        # the last put in is the first taken out
        todo += [(part[k > pivot], depth), (part[k == pivot], depth + 1), (part[k < pivot], depth)]
    ordered = np.concatenate(order)
    differ = padded[ordered[1:]] != padded[ordered[:-1]]
    same = ~differ.any(axis=1)
    common = np.where(same, length, differ.argmax(axis=1))
    number = np.concatenate([[0], np.cumsum(~same)])
    classes = np.empty(n, np.int64)
    classes[ordered] = number
    return classes, np.concatenate([[0], common[~same]])
