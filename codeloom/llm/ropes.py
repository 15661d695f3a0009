"""Min-plus transfer matrices whose cells carry a cost and a rope: a string kept as a tree of shared halves.

Concatenation costs one node however long the strings are. Ropes compare by descending to the first place where they differ and
skipping halves of equal hash, so ties between long strings are settled without writing them out.
"""

from __future__ import annotations

_PRIME, _BASE = (1 << 61) - 1, 1_000_003

Cell = tuple[int, int]
Matrix = list[list[Cell | None]]


class Ropes:
    """Nodes by number in flat lists, so that a whole set of ropes travels as plain values. Node 0 is the empty string."""

    def __init__(self):
        self.left, self.right, self.letter = [0], [0], [""]
        self.size, self.hash, self.shift = [0], [0], [1]

    def _add(self, left: int, right: int, letter: str, size: int, hashed: int, shift: int) -> int:
        self.left.append(left)
        self.right.append(right)
        self.letter.append(letter)
        self.size.append(size)
        self.hash.append(hashed)
        self.shift.append(shift)
        return len(self.size) - 1

    def leaf(self, letter: str) -> int:
        return self._add(0, 0, letter, 1, ord(letter) + 1, _BASE)

    def join(self, a: int, b: int) -> int:
        if not self.size[a] or not self.size[b]:
            return a or b
        hashed = (self.hash[a] * self.shift[b] + self.hash[b]) % _PRIME
        return self._add(a, b, "", self.size[a] + self.size[b], hashed, self.shift[a] * self.shift[b] % _PRIME)

    def keep(self, n: int) -> None:
        """Forget all nodes from number ``n`` on."""
        for column in (self.left, self.right, self.letter, self.size, self.hash, self.shift):
            del column[n:]

    def text(self, node: int) -> str:
        out, todo = [], [node]
        while todo:
            node = todo.pop()
            if self.letter[node]:
                out.append(self.letter[node])
            elif node:
                todo += (self.right[node], self.left[node])
        return "".join(out)

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        x, y = [a] if a else [], [b] if b else []
        while x and y:
            a, b = x.pop(), y.pop()
            if a == b or (self.size[a] == self.size[b] and self.hash[a] == self.hash[b]):
                continue
            if self.size[a] == 1 and self.size[b] == 1:
                return self.letter[a] < self.letter[b]
            if self.size[a] >= self.size[b]:
                x += (self.right[a], self.left[a])
                y.append(b)
            else:
                y += (self.right[b], self.left[b])
                x.append(a)
        return bool(y)

    def better(self, one: Cell | None, other: Cell | None) -> Cell | None:
        """The cheaper cell, of equal ones the smaller string."""
        if one is None or other is None:
            return one or other
        if one[0] != other[0]:
            return one if one[0] < other[0] else other
        return other if self.less(other[1], one[1]) else one

    def times_row(self, row: list[Cell | None], matrix: Matrix) -> list[Cell | None]:
        out: list[Cell | None] = [None] * len(matrix[0])
        for cell, steps in zip(row, matrix):
            if cell is None:
                continue
            for k, step in enumerate(steps):
                if step is not None and (out[k] is None or cell[0] + step[0] <= out[k][0]):
                    out[k] = self.better(out[k], (cell[0] + step[0], self.join(cell[1], step[1])))
        return out

    def times(self, a: Matrix, b: Matrix) -> Matrix:
        return [self.times_row(row, b) for row in a]

    def closure(self, steps: Matrix) -> Matrix:
        """Any number of steps, none included. Steps must cost more than nothing."""
        n = len(steps)
        out: Matrix = [[(0, 0) if i == j else steps[i][j] for j in range(n)] for i in range(n)]
        for _ in range(n.bit_length()):
            out = self.times(out, out)
        return out
