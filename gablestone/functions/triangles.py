"""Triangles of one planar polygon with holes: holes are bridged to the outer ring, then ears are cut."""

from __future__ import annotations

import numpy as np


def _turn(a, b, c) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _size(ring) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))


def _apart(a, b, c, d) -> bool:
    """Whether the segments ab and cd have no point in common but shared ends."""
    if a in (c, d) or b in (c, d):
        return True
    return _turn(a, b, c) * _turn(a, b, d) > 0 or _turn(c, d, a) * _turn(c, d, b) > 0


def triangulate(rings: list[list[int]], points: np.ndarray) -> list[tuple[int, int, int]]:
    """Vertex triples that cover a planar polygon in space: corners + 2 holes - 2 of them. The plane is
    looked at along the axis that its normal is closest to."""
    outer = points[rings[0]]
    normal = np.cross(outer, np.roll(outer, -1, axis=0)).sum(0)
    if len(rings[0]) < 3 or not np.any(normal):
        raise ValueError("the surface is degenerate")
    axes = [i for i in range(3) if i != int(np.argmax(np.abs(normal)))]
    at = {i: tuple(map(float, points[i, axes])) for r in rings for i in r}
    flat = lambda r: [at[i] for i in r]
    chain = list(rings[0]) if _size(flat(rings[0])) > 0 else list(rings[0])[::-1]
    holes = [list(r) if _size(flat(r)) < 0 else list(r)[::-1] for r in rings[1:]]
    sides = lambda r: list(zip(r, r[1:] + r[:1]))
    while holes:
        walls = sides(chain) + [s for h in holes for s in sides(h)]
        free = [
            (sum((x - y) ** 2 for x, y in zip(at[i], at[j])), k, n, m) for k, h in enumerate(holes) for m, j in enumerate(h) for n, i in enumerate(chain)
            if all(_apart(at[i], at[j], at[a], at[b]) for a, b in walls)
        ]
        if not free:
            raise ValueError("a hole cannot be reached")
        _, k, n, m = min(free)
        h = holes.pop(k)
        chain = chain[: n + 1] + h[m:] + h[: m + 1] + chain[n:]
    out = []
    while len(chain) > 3:
        for k in range(len(chain)):
            a, b, c = chain[k - 1], chain[k], chain[(k + 1) % len(chain)]
            pa, pb, pc = at[a], at[b], at[c]
            if _turn(pa, pb, pc) <= 0:
                continue
            inside = lambda p: min(_turn(pa, pb, p), _turn(pb, pc, p), _turn(pc, pa, p)) >= 0  # noqa: B023, E731
            if not any(inside(at[i]) for i in chain if at[i] not in (pa, pb, pc)):
                out.append((a, b, c))
                del chain[k]
                break
        else:
            # What is left has no area beyond sides in line.
            flat_corner = next((k for k in range(len(chain)) if _turn(at[chain[k - 1]], at[chain[k]], at[chain[(k + 1) % len(chain)]]) == 0), None)
            if flat_corner is None:
                raise ValueError("the surface is no simple polygon")
            k = flat_corner
            out.append((chain[k - 1], chain[k], chain[(k + 1) % len(chain)]))
            del chain[k]
    return [*out, tuple(chain)]
