"""A compressed radix trie over byte strings; the node where a string ends keeps its smallest id."""

from __future__ import annotations


class Node:
    __slots__ = ("label", "children", "least", "ends")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] | None = None
        self.ends = False
        self.least: object = None


def shared_length(a: bytes, b: bytes, at: int) -> int:
    """How far ``a`` agrees with ``b`` read from ``at``: probing slices, no loop over bytes."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        probe = (low + high + 1) // 2
        if a[low:probe] == b[at + low : at + probe]:
            low = probe
        else:
            high = probe - 1
    return low


class TextTrie:
    """Edges carry whole stretches, so a trie of n strings has fewer than 2 n nodes, and the
    labels together are no longer than the strings."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.held = 0

    def insert(self, text: bytes, key) -> Node:
        """The terminal of ``text``; a ``key`` of None leaves its smallest id as it is."""
        node, at = self.root, 0
        while at < len(text):
            if node.children is None:
                node.children = {}
            child = node.children.get(text[at])
            if child is None:
                child = Node(text[at:])
                node.children[text[at]] = child
                self.held += len(child.label)
                at = len(text)
            elif text.startswith(child.label, at):
                at += len(child.label)
            else:
                child = self._split(node, child, shared_length(child.label, text, at))
                at += len(child.label)
            node = child
        node.ends = True
        if key is not None and (node.least is None or key < node.least):
            node.least = key
        return node

    @staticmethod
    def _split(parent: Node, child: Node, length: int) -> Node:
        upper = Node(child.label[:length])
        child.label = child.label[length:]
        upper.children = {child.label[0]: child}
        parent.children[upper.label[0]] = upper
        return upper

    def terminals(self):
        """(string, smallest id) of every string, in byte order."""
        open_nodes = [(self.root, b"")]
        while open_nodes:
            node, before = open_nodes.pop()
            whole = before + node.label
            if node.ends:
                yield whole, node.least
            for first in sorted(node.children or (), reverse=True):
                open_nodes.append((node.children[first], whole))
