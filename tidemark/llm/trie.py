"""Compressed radix tries over byte strings, which give away whole subtrees when they grow too large."""

from __future__ import annotations

from collections.abc import Iterator

#: What a node takes beside the bytes of its label.
NODE_BYTES = 400


class Node:
    """A branch of the trie: ``label`` leads to it, ``value`` is set where a string ends.

    ``away`` is set where the subtree was cut off: whatever a caller keeps for strings that begin like it.
    """

    __slots__ = ("away", "children", "label", "value")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] = {}
        self.value: object | None = None
        self.away: object | None = None


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many first bytes of ``label`` stand in ``text`` from ``at`` on: by doubled steps, then by halves."""
    end = min(len(label), len(text) - at)
    low, step = 0, 8
    while low < end and label[low : low + step] == text[at + low : at + low + step] and low + step <= end:
        low, step = low + step, 2 * step
    high = min(end, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Patricia:
    """A radix trie without one-way branches; equal strings end at one node."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def place(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if need be, or the cut-off node that it would be behind."""
        node, at = self.root, 0
        while node.away is None and at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(text) - at + NODE_BYTES
                return child
            label = child.label
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = _common(label, text, at)
            fork = node.children[text[at]] = Node(label[:shared])
            fork.children[label[shared]] = child
            child.label = label[shared:]
            self.size += NODE_BYTES
            node, at = fork, at + shared
        return node

    def strings(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """All strings at and below a node with their values; ``before`` is what leads to it."""
        stack = [(node or self.root, before)]
        while stack:
            here, lead = stack.pop()
            whole = lead + here.label
            if here.value is not None:
                yield whole, here.value
            stack.extend((child, whole) for child in here.children.values())

    def _sizes(self) -> dict[int, int]:
        order, stack = [], [self.root]
        while stack:
            order.append(stack.pop())
            stack.extend(order[-1].children.values())
        sizes: dict[int, int] = {}
        for node in reversed(order):
            sizes[id(node)] = len(node.label) + NODE_BYTES + sum(sizes[id(c)] for c in node.children.values())
        return sizes

    def heaviest(self) -> tuple[Node, Node, bytes] | None:
        """A subtree to give away, as its parent, itself and what leads to it; None if only one string's path is left.

        From the root it follows the largest child, and stops behind the first fork below which less than half of
        everything lies: large enough to be worth it, and less than the whole.
        """
        sizes = self._sizes()
        node, lead, found = self.root, b"", None
        while node.children:
            child = max(node.children.values(), key=lambda c: sizes[id(c)])
            if len(node.children) > 1 or node.value is not None or found:
                if child.away is None and sizes[id(child)] > 2 * NODE_BYTES:
                    found = node, child, lead + node.label
                if 2 * sizes[id(child)] <= self.size:
                    break
            node, lead = child, lead + node.label
        return found

    def cut(self, parent: Node, node: Node, lead: bytes, away: object | None = None) -> tuple[list[tuple[bytes, object]], list[object]]:
        """Take a subtree out; its strings, and what stood for subtrees cut off inside it before, which belong to it.

        With ``away``, later strings that begin like it get that node.
        """
        taken, inside = list(self.strings(node, lead)), []
        stack, freed = [node], 0
        while stack:
            here = stack.pop()
            freed += len(here.label) + NODE_BYTES
            if here.away is not None:
                inside.append(here.away)
            stack.extend(here.children.values())
        self.size -= freed
        if away is None:
            del parent.children[node.label[0]]
        else:
            node.children, node.value, node.away = {}, None, away
            self.size += len(node.label) + NODE_BYTES
        return taken, inside
