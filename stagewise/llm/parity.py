"""Parity sketches: how far two sets are apart at least, from about a bit for each member.

A member flips the bit that its low bits name. What both sets hold flips the same bit twice, so two sketches differ in no
more bits than the sets differ in members: a pair that is over a threshold always passes, most others do not. A sketch of
twice the width, folded, is the sketch of the width.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bits of a sketch, as powers of two; that of a larger set passes more.
LEAST_POWER, MOST_POWER = 6, 20


def sketches(token: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> pa.Array:
    """The sketch of each set; nothing for those that are not ``wanted``. ``token`` is distinct in a set."""
    size = np.diff(first)
    power = np.clip(np.ceil(np.log2(np.maximum(size, 1))), LEAST_POWER, MOST_POWER).astype(np.int64)
    bits = np.where(wanted, 1 << power, 0)
    base = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(size)), size)
    mine = wanted[owner]
    owner, token = owner[mine], token[mine]
    spot = base[owner] + (token & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(spot, minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(bool), bitorder="little")
    places = (base // 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(places), pa.py_buffer(packed)])


def _rows(packed: list[bytes]) -> np.ndarray:
    """Sketches of one width as rows of 64-bit words."""
    return np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), -1)


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _near(rows: np.ndarray, other: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sketches, with so many members together, may be similar to ``percent``."""
    apart = np.bitwise_count(rows ^ other).sum(axis=1, dtype=np.int64)
    return apart * (100 + percent) <= sizes * (100 - percent)


def may_be_similar(a: pa.Array, b: pa.Array, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Of each pair of sketches, whether the sets may be similar; ``sizes`` are the members of both together."""
    out = np.zeros(len(sizes), bool)
    left, right = a.to_pylist(), b.to_pylist()
    wide = np.array([[len(x), len(y)] for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    for x, y in np.unique(wide, axis=0):
        at = np.flatnonzero((wide[:, 0] == x) & (wide[:, 1] == y))
        words = min(x, y) // 8
        rows, other = (_folded(_rows([side[k] for k in at]), words) for side in (left, right))
        out[at] = _near(rows, other, sizes[at], percent)
    return out


def may_meet(asking: pa.Table, held: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which asking nodes have a held one they may be similar to, and which held ones have such an asking node."""
    query, n_q, packed_q = asking["node"].to_numpy(), asking["n"].to_numpy(), asking["sketch"].to_pylist()
    member, n_m, packed_m = held["held"].to_numpy(), held["held_n"].to_numpy(), held["held_sketch"].to_pylist()
    order = np.argsort(n_m, kind="stable")
    member, n_m = member[order], n_m[order]
    wide = np.array([len(packed_m[k]) for k in order])  # grows with the set
    cuts = [0, *(np.flatnonzero(np.diff(wide)) + 1), len(wide)]
    spans = [(a, z, {}, _rows([packed_m[k] for k in order[a:z]])) for a, z in zip(cuts[:-1], cuts[1:], strict=True) if a < z]
    low, high = np.searchsorted(n_m, -(-n_q * percent // 100), "left"), np.searchsorted(n_m, n_q * 100 // percent, "right")
    asks, holds = np.zeros(len(query), bool), np.zeros(len(member), bool)
    for k, one in enumerate(packed_q):
        own = _rows([one])
        for begin, end, known, rows in spans:
            a, z = max(low[k], begin), min(high[k], end)
            if a >= z:
                continue
            words = min(own.shape[1], rows.shape[1])
            if words not in known:
                known[words] = _folded(rows, words)
            near = _near(known[words][a - begin : z - begin], _folded(own, words), n_m[a:z] + n_q[k], percent)
            near &= member[a:z] != query[k]
            asks[k] |= near.any()
            holds[a:z] |= near
    back = np.zeros(len(member), bool)
    back[order] = holds
    return asks, back
