"""XXH64 of many byte spans of one buffer at once, the published algorithm in numpy steps."""

from __future__ import annotations

import numpy as np

# Fixed values of the algorithm.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """Hash of ``data[starts[i]:ends[i]]`` for every i."""
    n = len(starts)
    if n == 0:
        return np.zeros(0, np.uint64)
    buffer = np.concatenate([data, np.zeros(8, np.uint8)])
    lane8 = np.ndarray(len(data) + 1, "<u8", buffer, strides=(1,))
    lane4 = np.ndarray(len(data) + 1, "<u4", buffer, strides=(1,))
    s = np.uint64(seed)
    size = ends - starts
    at = starts.copy()
    acc = np.full(n, s + P5, np.uint64)

    wide = np.flatnonzero(size >= 32)
    if len(wide):
        wide = wide[np.argsort(-size[wide], kind="stable")]
        stripes = size[wide] // 32
        start4 = np.array([int(s) + int(P1) + int(P2), int(s) + int(P2), int(s), int(s) - int(P1)], object) % (1 << 64)
        v = [np.full(len(wide), int(x), np.uint64) for x in start4]
        for k in range(int(stripes[0])):
            live = int(np.searchsorted(-stripes, -k, "left"))  # spans with more than k stripes
            p = starts[wide[:live]] + 32 * k
            for j in range(4):
                v[j][:live] = _round(v[j][:live], lane8[p + 8 * j])
        got = _turn(v[0], 1) + _turn(v[1], 7) + _turn(v[2], 12) + _turn(v[3], 18)
        for x in v:
            got = (got ^ _round(np.zeros_like(x), x)) * P1 + P4
        acc[wide] = got
        at[wide] += 32 * stripes
    acc += size.astype(np.uint64)

    left = ends - at
    for k in range(3):
        i = np.flatnonzero(left >= 8 * (k + 1))
        if not len(i):
            break
        lane = lane8[at[i] + 8 * k]
        acc[i] = _turn(acc[i] ^ _round(np.zeros_like(lane), lane), 27) * P1 + P4
    at += left // 8 * 8
    left = left % 8
    i = np.flatnonzero(left >= 4)
    acc[i] = _turn(acc[i] ^ (lane4[at[i]].astype(np.uint64) * P1), 23) * P2 + P3
    at[i] += 4
    left = left % 4
    for k in range(3):
        i = np.flatnonzero(left > k)
        acc[i] = _turn(acc[i] ^ (buffer[at[i] + k].astype(np.uint64) * P5), 11) * P1
    acc = (acc ^ (acc >> np.uint64(33))) * P2
    acc = (acc ^ (acc >> np.uint64(29))) * P3
    return acc ^ (acc >> np.uint64(32))
