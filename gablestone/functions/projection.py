"""Transverse Mercator by Krueger's series, as SQL text: ETRS89 / UTM zone 30 on GRS80."""

from __future__ import annotations

import math

A, F_ = 6378137.0, 1 / 298.257222101
N = F_ / (2 - F_)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
K0, FALSE_EASTING, LON0 = 0.9996, 500000.0, math.radians(-3.0)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)
E = 2 * math.sqrt(N) / (1 + N)


def _f(x: float) -> str:
    return f"cast('{x!r}' as double)"


def to_utm(lon: str, lat: str) -> tuple[list[dict[str, str]], str, str]:
    """(steps of named expressions, easting, northing) from degrees."""
    steps = [
        {"q_phi": f"radians({lat})", "q_lam": f"radians({lon}) - {_f(LON0)}"},
        {"q_s": "sin(q_phi)"},
        {"q_a": f"0.5*ln((1+q_s)/(1-q_s)) - {_f(E)}*0.5*ln((1+{_f(E)}*q_s)/(1-{_f(E)}*q_s))"},
        {"q_t": "(exp(q_a)-exp(-q_a))/2"},
        {"q_xi": "atan2(q_t, cos(q_lam))", "q_r": "sin(q_lam)/sqrt(1+q_t*q_t)"},
        {"q_eta": "0.5*ln((1+q_r)/(1-q_r))"},
    ]
    ch, sh = "((exp({0})+exp(-({0})))/2)", "((exp({0})-exp(-({0})))/2)"
    east = "q_eta" + "".join(f" + {_f(a)}*cos({2 * j}*q_xi)*{sh.format(f'{2 * j}*q_eta')}" for j, a in enumerate(ALPHA, 1))
    north = "q_xi" + "".join(f" + {_f(a)}*sin({2 * j}*q_xi)*{ch.format(f'{2 * j}*q_eta')}" for j, a in enumerate(ALPHA, 1))
    return steps, f"{_f(FALSE_EASTING)} + {_f(K0 * RADIUS)}*({east})", f"{_f(K0 * RADIUS)}*({north})"


def to_geographic(easting: str, northing: str) -> tuple[list[dict[str, str]], str, str]:
    """(steps, longitude, latitude) in degrees."""
    ch, sh = "((exp({0})+exp(-({0})))/2)", "((exp({0})-exp(-({0})))/2)"
    steps = [
        {"q_x": f"({northing})/{_f(K0 * RADIUS)}", "q_e": f"(({easting})-{_f(FALSE_EASTING)})/{_f(K0 * RADIUS)}"},
        {
            "q_xi": "q_x" + "".join(f" - {_f(b)}*sin({2 * j}*q_x)*{ch.format(f'{2 * j}*q_e')}" for j, b in enumerate(BETA, 1)),
            "q_eta": "q_e" + "".join(f" - {_f(b)}*cos({2 * j}*q_x)*{sh.format(f'{2 * j}*q_e')}" for j, b in enumerate(BETA, 1)),
        },
        {"q_chi": f"asin(sin(q_xi)/{ch.format('q_eta')})"},
    ]
    lat = "degrees(q_chi" + "".join(f" + {_f(d)}*sin({2 * j}*q_chi)" for j, d in enumerate(DELTA, 1)) + ")"
    return steps, f"degrees({_f(LON0)} + atan2({sh.format('q_eta')}, cos(q_xi)))", lat


def inline(parts: tuple) -> str:
    """One expression for both results, struct(x, y); each step is worked out once."""
    import re

    steps, first, second = parts
    body = f"struct({first} as x, {second} as y)"
    for k in reversed(range(len(steps))):
        names = "|".join(steps[k])
        body = re.sub(rf"\b({names})\b", rf"s{k}.\1", body)
        body = f"element_at(transform(array(struct({', '.join(f'{v} as {n}' for n, v in steps[k].items())})), s{k} -> {body}), 1)"
    return body


def apply(df, parts: tuple, names: tuple[str, str]):
    """A DataFrame with the two results of to_utm() or to_geographic()."""
    steps, first, second = parts
    from pyspark.sql import functions as F

    own = df.columns
    for s in steps:
        df = df.select("*", *[F.expr(v).alias(k) for k, v in s.items()])
    return df.select(*own, F.expr(first).alias(names[0]), F.expr(second).alias(names[1]))


def as_sql(table: str, parts: tuple, names: tuple[str, str]) -> str:
    """The same as nested SELECTs."""
    steps, first, second = parts
    sql = table
    for i, s in enumerate(steps):
        sql = f"(select *, {', '.join(f'{v} as {k}' for k, v in s.items())} from {sql}) as step{i}"
    return f"(select *, {first} as {names[0]}, {second} as {names[1]} from {sql})"
