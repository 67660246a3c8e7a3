"""Walking a path at a constant step length.

``walkers`` returns closures, so Spark ships their code with the job and workers need not have the package.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

# a vertex this close (relative) to the length counts as that far away, so rounding does not decide
NEAR = 1e-9
# position of a walk: points made, current point, last vertex with its time
STATE = ("_made", "_cx", "_cy", "_px", "_py", "_pt")
# points handed on at once, however many lie on one straight stretch
CHUNK = 50_000


def walkers(length: float, keys: tuple[str, ...], columns: list[str], chunk: int = CHUNK) -> tuple[Callable, Callable]:
    """Two task functions over batches sorted by burst and time: whole bursts, and bursts that go on from a position.

    The second takes the position from the columns ``STATE`` (null at a burst's beginning) and adds a last row with the
    position reached. Both hand on at most about ``chunk`` points at once.
    """
    state_names = STATE

    def walk(x, y, t, state):
        """Arrays of points at distance ``length``: from the current point, follow the path to the first place that far away.

        ``state`` is (current x, current y, last vertex x, y, t); the state reached is returned, so a path can go on later.
        """
        x, y, t = x.tolist(), y.tolist(), t.tolist()
        out, i = [], 0
        if state is None:
            out.append((x[0], y[0], t[0]))
            state, i = (x[0], y[0], x[0], y[0], t[0]), 1
        cx, cy, px, py, pt = state
        square = length * length
        reach = square * (1.0 - NEAR)
        for vx, vy, vt in zip(x[i:], y[i:], t[i:], strict=True):
            wx, wy, ux, uy = px - cx, py - cy, vx - px, vy - py
            moves = ux != 0.0 or uy != 0.0
            if moves and (vx - cx) * (vx - cx) + (vy - cy) * (vy - cy) >= reach:
                # the circle around the current point is left on the way to this vertex
                a, b, c = ux * ux + uy * uy, ux * wx + uy * wy, wx * wx + wy * wy - square
                share = min(max((math.sqrt(max(b * b - a * c, 0.0)) - b) / a, 0.0), 1.0)
                cx, cy, ct = px + share * ux, py + share * uy, pt + share * (vt - pt)
                out.append((cx, cy, ct))
                # further points before the vertex lie on one straight line
                rest = math.hypot(vx - cx, vy - cy)
                more = math.floor(rest / length + NEAR)
                ex, ey, et = cx, cy, ct
                for first in range(1, more + 1, chunk):
                    shares = np.minimum(np.arange(first, min(first + chunk, more + 1)) * length / rest, 1.0)
                    line = np.stack([ex + shares * (vx - ex), ey + shares * (vy - ey), et + shares * (vt - et)], axis=1)
                    if out:
                        yield np.array(out)
                        out = []
                    yield line
                    cx, cy = float(line[-1, 0]), float(line[-1, 1])
                if len(out) >= chunk:
                    yield np.array(out)
                    out = []
            px, py, pt = vx, vy, vt
        if out:
            yield np.array(out)
        return cx, cy, px, py, pt

    def placed(pdf, take, points, numbers):
        """New points with the other columns of the rows they are taken from."""
        out = pdf[columns].iloc[np.concatenate(take)].reset_index(drop=True)
        at = np.concatenate(points)
        out["x"], out["y"] = at[:, 0], at[:, 1]
        out["us"] = np.rint(at[:, 2]).astype("int64")
        out["rid"] = np.concatenate(numbers)
        return out

    def position(pdf, row, made, state):
        """A row that holds no point but the position reached."""
        out = pdf[columns].iloc[[row]].reset_index(drop=True)
        out["_is_state"] = True
        for name, value in zip(state_names, (made, *state), strict=True):
            out[name] = value
        return out

    def run(batches: Iterator[pd.DataFrame], carried: bool) -> Iterator[pd.DataFrame]:
        """Bursts arrive one after another in time order; a burst may go on in the next batch."""
        burst, state, made, last = None, None, 0, None
        for pdf in batches:
            if pdf.empty:
                continue
            names = [pdf[k].to_numpy() for k in keys]
            changes = np.flatnonzero(np.logical_or(*[n[1:] != n[:-1] for n in names])) + 1
            x, y, t = (pdf[c].to_numpy(dtype="float64") for c in ("x", "y", "us"))
            take, points, numbers, waiting = [], [], [], 0
            for a, b in zip([0, *changes], [*changes, len(pdf)], strict=True):
                here = tuple(n[a] for n in names)
                if here != burst:
                    if carried and burst is not None:
                        yield position(*last, made, state)
                    burst, state, made = here, None, 0
                    if carried and pd.notna(pdf["_made"].iloc[a]):
                        made, state = int(pdf["_made"].iloc[a]), tuple(float(pdf[c].iloc[a]) for c in state_names[1:])
                walking = walk(x[a:b], y[a:b], t[a:b], state)
                while True:
                    try:
                        found = next(walking)
                    except StopIteration as end:
                        state = end.value
                        break
                    take.append(np.full(len(found), a))
                    points.append(found)
                    numbers.append(np.arange(made + 1, made + 1 + len(found)))
                    made, waiting = made + len(found), waiting + len(found)
                    if waiting >= chunk:
                        yield marked(placed(pdf, take, points, numbers), carried)
                        take, points, numbers, waiting = [], [], [], 0
                last = (pdf.iloc[a : a + 1], 0)
            if points:
                yield marked(placed(pdf, take, points, numbers), carried)
        if carried and burst is not None:
            yield position(*last, made, state)

    def marked(out, carried):
        if carried:
            out["_is_state"] = False
            for name in state_names:
                out[name] = pd.array([None] * len(out), dtype="Int64" if name == "_made" else "Float64")
        return out

    def whole_bursts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches, False)

    def continued(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(batches, True)

    return whole_bursts, continued
