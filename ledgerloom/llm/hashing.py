"""Polynomial hashes of stretches of a sequence, for many stretches at a time."""

import numpy as np

from ledgerloom.llm.common import by_value

BASE = 0x9E3779B97F4A7C15
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _FACTOR
    x = (x ^ (x >> _HALF)) * _FACTOR
    return x ^ (x >> _HALF)


_TABLE: dict[str, np.ndarray] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least so many powers of the base and of its inverse; kept until more are asked for."""
    if len(_TABLE.get("power", ())) < size:
        power, inverse = (np.full(max(1 << 17, 1 << size.bit_length()), x, dtype=np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64)))
        power[0] = inverse[0] = 1
        _TABLE["power"], _TABLE["inverse"] = np.cumprod(power), np.cumprod(inverse)
    return _TABLE["power"], _TABLE["inverse"]


class Stretches:
    """Hashes any stretches of ``values`` (64-bit numbers, none zero): equal stretches have equal hashes."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = powers(len(values) + 1)
        self.total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[:len(values)], out=self.total[1:])

    def raw(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.total[stop] - self.total[start]) * self.inverse[start]

    def raw_all(self, length: int) -> np.ndarray:
        """Of every stretch of one length, by its start."""
        count = max(len(self.total) - length, 0)
        return (self.total[length:] - self.total[:count]) * self.inverse[:count]


by_value(__name__)
