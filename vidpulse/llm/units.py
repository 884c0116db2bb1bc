"""Values of repeated text units, remembered per Python worker within a byte budget."""

from __future__ import annotations

from collections.abc import Callable

#: Units longer than this are worked out each time: they hardly ever return.
SHORT = 64


class UnitMemory(dict):
    """``memory[unit]`` is ``work(unit)``, remembered for short units.

    The memory is emptied when its bytes (``most_bytes``, by an estimate of
    what Python spends on unit, value and table entry) are used up.
    """

    def __init__(self, work: Callable[[bytes], bytes], most_bytes: int = 256 << 20) -> None:
        super().__init__()
        self.work, self.most_bytes, self.used = work, most_bytes, 0

    def __missing__(self, unit: bytes) -> bytes:
        value = self.work(unit)
        if len(unit) <= SHORT:
            cost = 200 + len(unit) + len(value)
            if self.used + cost > self.most_bytes:
                self.clear()
                self.used = 0
            self[unit] = value
            self.used += cost
        return value


class AgingMemory(UnitMemory):
    """A ``UnitMemory`` in two halves of its bytes: when the newer is full it
    becomes the older, whose units are forgotten unless they are met again.
    Frequent units stay in a memory far smaller than the vocabulary."""

    def __init__(self, work: Callable[[bytes], bytes], most_bytes: int) -> None:
        super().__init__(work, most_bytes)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, unit: bytes) -> bytes:
        value = self.older.pop(unit, None)
        if value is None:
            value = self.work(unit)
        if len(unit) <= SHORT:
            cost = 200 + len(unit) + len(value)
            if 2 * (self.used + cost) > self.most_bytes:
                self.older = dict(self)
                self.clear()
                self.used = 0
            self[unit] = value
            self.used += cost
        return value
