"""Threshold grids reproduced with the same floating-point recipe as NumPy.

``arange`` fills ``start + i * (x1 - start)`` with ``x1 = start + step``;
``linspace`` uses ``start + i * ((stop - start) / (num - 1))`` and pins the end
point.  The values are generated once on the driver (they are parameters, a
few dozen numbers) and shipped as literal arrays.
"""

from __future__ import annotations

import math


def arange(start: float, stop: float, step: float) -> list[float]:
    n = max(0, math.ceil((stop - start) / step))
    if n == 0:
        return []
    delta = (start + step) - start
    return [start + i * delta if i else start for i in range(n)]


def linspace(start: float, stop: float, num: int) -> list[float]:
    if num == 1:
        return [start]
    step = (stop - start) / (num - 1)
    out = [start + i * step for i in range(num)]
    out[-1] = stop
    return out
