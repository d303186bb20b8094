"""An adaptive radix tree: byte keys, nodes that grow from 4 to 16, 48 and 256 children, and compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to 4 or 16 children: their bytes in order beside them."""

    __slots__ = ("most", "bytes", "kids")

    def __init__(self, most: int = 4) -> None:
        self.most, self.bytes, self.kids = most, bytearray(), []

    def find(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid: Node) -> Sorted | Indexed:
        """Set a child; the layout to use from now on."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
        elif len(self.kids) < self.most:
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)
        else:
            return _moved(self, Sorted(16) if self.most == 4 else Indexed()).put(byte, kid)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children: a place for each byte, 0 where there is none."""

    __slots__ = ("places", "kids")

    def __init__(self) -> None:
        self.places, self.kids = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.kids[place - 1] if place else None

    def put(self, byte: int, kid: Node) -> Indexed | Full:
        if place := self.places[byte]:
            self.kids[place - 1] = kid
        elif len(self.kids) < 48:
            self.kids.append(kid)
            self.places[byte] = len(self.kids)
        else:
            return _moved(self, Full()).put(byte, kid)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.kids[place - 1]) for byte, place in enumerate(self.places) if place)


class Full:
    """A child for each byte."""

    __slots__ = ("kids",)

    def __init__(self) -> None:
        self.kids = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> Full:
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


def _moved(old, new):
    for byte, kid in old.items():
        new.put(byte, kid)
    return new


class Node:
    """Bytes that all keys below share, the children by their next byte, and the values of the key that ends here."""

    __slots__ = ("path", "children", "values")

    def __init__(self, path: bytes = b"") -> None:
        self.path, self.children, self.values = path, Sorted(), []

    def kids(self) -> Iterator[tuple[int, Node]]:
        return self.children.items()


def _shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of `path` agree with `key` from `at` on."""
    if key.startswith(path, at):
        return len(path)
    n = min(len(path), len(key) - at)
    differing = int.from_bytes(path[:n]) ^ int.from_bytes(key[at : at + n])
    return n - (differing.bit_length() + 7) // 8


class Tree:
    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Add a value to those of `key`."""
        if self.root is None:
            self.root = Node(key)
        node, at, above, byte = self.root, 0, None, 0
        while True:
            same = _shared(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same])
                upper.children = upper.children.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.children = above.children.put(byte, upper)
                node = upper
            at += same
            if at == len(key):
                node.values.append(value)
                return
            above, byte = node, key[at]
            at += 1
            node = above.children.find(byte)
            if node is None:
                node = Node(key[at:])
                above.children = above.children.put(byte, node)
