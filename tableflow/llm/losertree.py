"""Merging of front-coded sorted runs with a loser tree that knows common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of a sorted list: the prefix each string shares with the one before, the length of the rest,
    and the rests."""
    shared, rests, before = [], [], b""
    for s in strings:
        n = common_prefix(before, s, 0)
        shared.append(n)
        rests.append(s[n:])
        before = s
    return (np.array(shared, dtype=np.uint16), np.array([len(r) for r in rests], dtype=np.uint16),
            b"".join(rests))


def decode(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    """(prefix shared with the string before, string) of a front-coded run."""
    at, before = 0, b""
    for n, size in zip(shared.tolist(), lengths.tolist(), strict=True):
        before = before[:n] + rests[at : at + size]
        at += size
        yield n, before


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that are known to share ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    differ = int.from_bytes(x) ^ int.from_bytes(y)
    return n - (differ.bit_length() + 7) // 8


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(prefix shared with the string before, string, run) over all runs, in order.

    Every string waiting in the tree carries the prefix it shares with the last string given out,
    or with the winner it lost to. Of two such strings, the one that shares more is the smaller, with
    no look at their bytes; if they share equally much, the comparison begins after the shared
    prefix, and the loser keeps what it shares with the winner. So no byte of a known prefix is
    compared again. Equal strings come in the order of their runs.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [None] * size
    shares = [0] * size
    for i, run in enumerate(runs):
        first = next(run, None)
        heads[i] = first[1] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share becomes that with the winner."""
        if a > b:
            a, b = b, a
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shares[a] != shares[b]:
            return (a, b) if shares[a] > shares[b] else (b, a)
        n = common_prefix(x, y, shares[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            shares[b] = n
            return a, b
        shares[a] = n
        return b, a

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    while heads[best] is not None:
        yield shares[best], heads[best], best
        following = next(runs[best], None)
        if following:
            shares[best], heads[best] = following
        else:
            heads[best] = None
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2
