"""An adaptive radix tree over byte strings that are made of fixed-width ids."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

# Children that a layout holds: sorted edges up to 16, then an index of 256 bytes, then one slot an edge.
SORTED, INDEXED = (4, 16), 48
_ABSENT = 255


class Node:
    """An inner node or a leaf. ``path`` is compressed: the bytes after the edge that leads here."""

    __slots__ = ("path", "limit", "edges", "children", "value", "sums", "least")

    def __init__(self, path: bytes):
        self.path = path
        self.limit = SORTED[0]
        self.edges = bytearray()
        self.children: list = []
        self.value = None
        self.sums: list[int] = []
        self.least = 0

    def child(self, edge: int) -> Node | None:
        if self.limit <= SORTED[1]:
            at = bisect_left(self.edges, edge)
            return self.children[at] if at < len(self.edges) and self.edges[at] == edge else None
        if self.limit == INDEXED:
            at = self.edges[edge]
            return self.children[at] if at != _ABSENT else None
        return self.children[edge]

    def add(self, edge: int, node: Node) -> None:
        if self.limit <= INDEXED and len(self.children) == self.limit:
            self._grow()
        if self.limit <= SORTED[1]:
            at = bisect_left(self.edges, edge)
            self.edges.insert(at, edge)
            self.children.insert(at, node)
        elif self.limit == INDEXED:
            self.edges[edge] = len(self.children)
            self.children.append(node)
        else:
            self.children[edge] = node

    def replace(self, edge: int, node: Node) -> None:
        if self.limit <= SORTED[1]:
            self.children[bisect_left(self.edges, edge)] = node
        elif self.limit == INDEXED:
            self.children[self.edges[edge]] = node
        else:
            self.children[edge] = node

    def _grow(self) -> None:
        if self.limit == SORTED[0]:
            self.limit = SORTED[1]
        elif self.limit == SORTED[1]:
            index = bytearray([_ABSENT]) * 256
            for at, edge in enumerate(self.edges):
                index[edge] = at
            self.limit, self.edges = INDEXED, index
        else:
            slots: list = [None] * 256
            for edge, at in enumerate(self.edges):
                if at != _ABSENT:
                    slots[edge] = self.children[at]
            self.limit, self.edges, self.children = 256, bytearray(), slots

    def below(self) -> Iterator[tuple[int, Node]]:
        """Edges and children in ascending order."""
        if self.limit <= SORTED[1]:
            yield from zip(self.edges, self.children)
        elif self.limit == INDEXED:
            yield from ((e, self.children[at]) for e, at in enumerate(self.edges) if at != _ABSENT)
        else:
            yield from ((e, c) for e, c in enumerate(self.children) if c is not None)


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Keys with values; ``width`` bytes are one id, and only id-aligned depths are nodes of the trie."""

    def __init__(self, width: int):
        self.width = width
        self.root = Node(b"")

    def slot(self, key: bytes) -> Node:
        """The node at which ``key`` ends, added where absent."""
        above, edge, node, depth = None, 0, self.root, 0
        while True:
            path = node.path
            same = _shared(path, key[depth : depth + len(path)])
            if same < len(path):
                fork = Node(path[:same])
                node.path = path[same + 1 :]
                fork.add(path[same], node)
                above.replace(edge, fork)  # the root's path is empty, so there is a node above
                node = fork
            depth += same
            if depth == len(key):
                return node
            above, edge = node, key[depth]
            node, depth = node.child(edge), depth + 1
            if node is None:
                leaf = Node(key[depth:])
                above.add(edge, leaf)
                return leaf

    def total(self, weights: int) -> None:
        """Sums of the values' weights and the least id of each subtree, without recursion."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(c for _, c in node.below())
        for node in reversed(order):
            value = node.value
            node.sums = list(value.sums) if value else [0] * weights
            least = [value.least] if value else []
            for _, child in node.below():
                least.append(child.least)
                for i, s in enumerate(child.sums):
                    node.sums[i] += s
            node.least = min(least, default=0)

    def aligned(self) -> Iterator[tuple[Node, int, bytes, bool, object]]:
        """The trie's nodes from the top: tree node, ids on the path, last id, whether a key may end here, and a
        mark of the node above, which the caller sends back for this one.
        """
        mark = yield self.root, 0, b"", True, None
        stack = [(self.root, 0, b"", mark)]
        while stack:
            above, depth, rest, up = stack.pop()
            for edge, node in above.below():
                run, ids, mark = rest + bytes([edge]) + node.path, depth, up
                whole = len(run) // self.width
                for k in range(whole):
                    last = k == whole - 1 and len(run) == whole * self.width
                    ids += 1
                    mark = yield node, ids, run[k * self.width : (k + 1) * self.width], last, mark
                stack.append((node, ids, run[whole * self.width :], mark))
