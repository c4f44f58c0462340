"""Plain-Python statements of the series rules, row by row, for comparison."""

from __future__ import annotations

import statistics


def fence(values: list, k: float = 8.0, width: int = 48) -> list:
    medians, distances, out = [], [], []
    for i, v in enumerate(values):
        seen = [x for x in values[max(0, i - width + 1) : i + 1] if x is not None]
        medians.append(statistics.median(seen) if seen else None)
        distances.append(None if v is None else abs(v - medians[i]))
    for i, v in enumerate(values):
        if v is None:
            out.append(None)
            continue
        near = [x for x in distances[max(0, i - width + 1) : i + 1] if x is not None]
        spread = k * (1.4826 * statistics.median(near) + 1e-9)
        out.append(min(max(v, medians[i] - spread), medians[i] + spread))
    return out


def junk(values: list, band: tuple | None) -> list[bool]:
    n = len(values)
    if band is None or n < 100:
        return [False] * n
    middle = band[0] + 0.5 * (band[1] - band[0])
    high = []
    for i in range(n):
        seen = [x for x in values[max(0, i - 23) : i + 1] if x is not None]
        high.append(len(seen) >= 12 and sum(seen) / len(seen) > middle)
    run = [False] * n
    i = 0
    while i < n:
        j = i
        while j < n and high[j] == high[i]:
            j += 1
        if high[i] and j - i >= 48:
            run[i:j] = [True] * (j - i)
        i = j
    return [
        run[i] or (i + 36 < n and any(run[i + 1 : i + 37])) or (values[i] is not None and values[i] >= band[1] - 1e-6)
        for i in range(n)
    ]


def clean(values: list, band: tuple | None) -> dict[int, float]:
    """Hour to level for an hourly list that starts and ends with a value."""
    v = fence(values)
    if band is not None:
        v = [None if x is None else min(max(x, band[0]), band[1]) for x in v]
    bad = junk(v, band)
    filled = list(v)
    known = [i for i, x in enumerate(v) if x is not None]
    for a, b in zip(known, known[1:]):
        for i in range(a + 1, b):
            filled[i] = v[a] + (v[b] - v[a]) * (i - a) / (b - a)
    return {i: x for i, x in enumerate(filled) if not bad[i]}
