"""Hashed n-grams of a text and a logistic regression over sparse rows.

Texts come as UTF-8 bytes. A gram is hashed from its bytes alone, so a model
trained by one task scores alike in every other one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(64)], np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(33))) * _MIX
    return values ^ (values >> np.uint64(29))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def char_grams(raw: bytes, sizes: Sequence[int]) -> list[np.ndarray]:
    """One array of 64-bit hashes per size: every run of that many bytes."""
    codes = _BYTES[np.frombuffer(raw, np.uint8)]
    out, running, at = [], np.zeros(len(codes), np.uint64), 0
    for size in sorted(sizes):
        for i in range(at, min(size, len(codes))):
            running[: len(codes) - i] += codes[i:] * _POWERS[i % 64]
        at = size
        if len(codes) >= size:
            out.append(mix(running[: len(codes) - size + 1] + np.uint64(size)))
    return out


def rolling(raw: bytes, size: int) -> np.ndarray:
    """64-bit hashes of every run of ``size`` bytes, from runs of half the length."""
    codes = _BYTES[np.frombuffer(raw, np.uint8)]
    if len(codes) < size:
        return np.zeros(0, np.uint64)
    total, done, run, span, left = None, 0, codes, 1, size
    while left:
        if left & 1:
            if total is None:
                total = run
            else:
                m = min(len(total), len(run) - done)
                total = total[:m] + run[done : done + m] * np.uint64(pow(int(_ODD), done, 1 << 64))
            done += span
        left >>= 1
        if left:
            run = run[:-span] + run[span:] * np.uint64(pow(int(_ODD), span, 1 << 64))
            span *= 2
    return mix(total[: len(codes) - size + 1])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width`` values."""
    out, span = keys, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash per word, stable over processes."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(joined)) - np.repeat(starts, lengths)
    weighed = _BYTES[joined] * _POWERS[place % 64] + (place // 64).astype(np.uint64)
    return mix(np.add.reduceat(mix(weighed), starts) + lengths.astype(np.uint64))


def word_grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * _ODD + hashes[i : len(hashes) - size + 1 + i])
    return total


class Distinct:
    """Distinct slots of many hashes without sorting: the last writer of a slot stands for it."""

    def __init__(self, bits: int):
        self.shift, self.owner = np.uint64(64 - bits), np.zeros(1 << bits, np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> self.shift).astype(np.int64)
        order = np.arange(len(slots))
        self.owner[slots] = order
        return slots[self.owner[slots] == order]


def pack_slots(slots: np.ndarray) -> bytes:
    """Rising slots as bytes: the steps from one to the next, 255 for what goes on in the next byte."""
    steps = np.diff(slots, prepend=0)
    ends = np.cumsum(steps // 255 + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = steps % 255
    return out.tobytes()


def unpack_slots(raw: bytes | pa.Buffer) -> np.ndarray:
    """The slots of ``pack_slots``."""
    steps = np.frombuffer(raw, np.uint8) if len(raw) else np.zeros(0, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


#: entries of a logistic regression that are worked on at a time
ENTRIES = 1 << 17


def fit_blocks(
    blocks: Callable[[], Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]],
    labels: np.ndarray,
    width: int,
    penalty: float,
    rounds: int = 40,
    rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression.

    ``blocks()`` gives the entries (indices, rows, values) in parts, whole
    numbers as int64; it is called twice a round, so that no more than a part
    is held. Sums run in the order of the entries, whatever the parts.
    Full-batch gradients with a pace of its own for each weight (AdaGrad), so
    reruns agree.
    """
    n = len(labels)
    weights, bias = np.zeros(width), 0.0
    seen, seen_bias = np.full(width, 1e-12), 1e-12
    for _ in range(rounds):
        score, slope = np.zeros(n), np.zeros(width)
        for indices, rows, values in blocks():
            np.add.at(score, rows, weights[indices] * values)
        error = (sigmoid(score + bias) - labels) / n
        for indices, rows, values in blocks():
            np.add.at(slope, indices, error[rows] * values)
        slope, slope_bias = slope + penalty * weights, error.sum()
        seen, seen_bias = seen + slope * slope, seen_bias + slope_bias * slope_bias
        weights, bias = weights - rate * slope / np.sqrt(seen), bias - rate * slope_bias / np.sqrt(seen_bias)
    return weights, bias


def fit_logistic(
    indices: np.ndarray, rows: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int, penalty: float, *pace: float
) -> tuple[np.ndarray, float]:
    """``fit_blocks`` over entries that are held as arrays."""

    def blocks():
        for at in range(0, len(indices), ENTRIES):
            part = slice(at, at + ENTRIES)
            yield indices[part].astype(np.int64, copy=False), rows[part].astype(np.int64, copy=False), values[part]

    return fit_blocks(blocks, labels, width, penalty, *pace)
