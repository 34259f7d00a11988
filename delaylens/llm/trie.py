"""A Patricia trie over byte strings whose terminal nodes own copies of a string."""

from __future__ import annotations

from collections.abc import Iterator

NODE_BYTES = 250


class Node:
    __slots__ = ("edge", "children", "entry", "closed")

    def __init__(self, edge: bytes) -> None:
        self.edge = edge
        self.children: dict[int, Node] = {}
        self.entry: list | None = None
        self.closed = False


def shared_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of ``a`` and ``b[start:]``, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Entries under full byte strings; ``weight`` estimates the bytes of memory in use.

    :meth:`add` returns the entry of a key, made on first sight, or None if the key lies
    in a subtree that was spilled. An entry is a list that belongs to the caller.
    """

    def __init__(self) -> None:
        self.root = Node(b"")
        self.weight = 0
        self.entries = 0

    def add(self, key: bytes) -> list | None:
        node, at = self.root, 0
        while True:
            if node.closed:
                return None
            if at == len(key):
                if node.entry is None:
                    node.entry = []
                    self.entries += 1
                return node.entry
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                child.entry = []
                node.children[key[at]] = child
                self.weight += NODE_BYTES + len(child.edge)
                self.entries += 1
                return child.entry
            if not key.startswith(child.edge, at):
                common = shared_prefix(child.edge, key, at)
                middle = Node(child.edge[:common])
                child.edge = child.edge[common:]
                middle.children[child.edge[0]] = child
                node.children[key[at]] = middle
                self.weight += NODE_BYTES
                child = middle
            at += len(child.edge)
            node = child

    def items(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, list]]:
        """Every key below ``node`` with its entry, without recursion."""
        stack = [(node or self.root, prefix)]
        while stack:
            here, path = stack.pop()
            path += here.edge
            if here.entry is not None:
                yield path, here.entry
            stack.extend((child, path) for child in here.children.values())

    def _weights(self) -> dict[int, int]:
        """Bytes below each node, by its id."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        sums: dict[int, int] = {}
        for node in reversed(order):
            sums[id(node)] = NODE_BYTES + len(node.edge) + sum(sums[id(c)] for c in node.children.values())
        return sums

    def spill(self) -> list[tuple[bytes, list]]:
        """Take the heaviest subtree with at most half of the bytes out and close its node."""
        sums = self._weights()
        node, path = self.root, b""
        while node.children:
            path += node.edge
            node = max(node.children.values(), key=lambda c: sums[id(c)])
            if sums[id(node)] <= sums[id(self.root)] // 2:
                break
        taken = list(self.items(node, path))
        node.children, node.entry, node.closed = {}, None, True
        self.weight -= sums[id(node)]
        self.entries -= len(taken)
        return taken
