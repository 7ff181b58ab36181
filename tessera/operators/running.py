"""Running sums: window sums along an axis of a block volume, at a cost that does not depend on the radius.

Let P(y) be the sum of a line's first y samples.  Under a border of zeros the sum over ``[x-r, x+r]`` is
E(x+r+1) - E(x-r) with E(u) = P(u), held at its ends.  Under a mirrored border E goes on beyond the line: a period adds a fixed
multiple of the line's total T (less its first and last sample F and L, where the ends are not repeated), and within a
period E is P, or a constant less P of the mirrored place.  So whatever r and the border, a window is two places of P and a multiple of
T, F and L: a target block reads two ranges of P, each no longer than itself, and planes of one sample a line.

1. Every block sends its totals per line; for each row of blocks they become the sums before each block, and T, F, L
   (one exchange of ``1/block`` of the data).
2. Every block cuts its own running sums into the ranges that targets read; the planes of step 1 go to the same
   targets, in one exchange.  A block that is not stored sends nothing: its P is the sum before it.

All sums are field sets (``exact``): integers without rounding, in every voxel type.
"""

from __future__ import annotations

import functools
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..plans.grid import block_grid
from . import exact as X
from .halo import BLOCK_COLUMNS, BLOCK_SCHEMA, G, Outbox, grouped_rows

MARK, CENTRE, AHEAD, BEHIND, TOTAL, FIRST, LAST, BEFORE = range(-1, 7)


def terms(u: np.ndarray, n: int, mode: str) -> tuple[np.ndarray, ...]:
    """E(u) = sign * P(y) + t * T + f * F + l * L: (y, sign, t, f, l)."""
    zero, one = np.zeros_like(u), np.ones_like(u)
    if mode == "zero":
        return np.clip(u, 0, n), one, zero, zero, zero
    if mode == "mirror_double":
        k, q = np.divmod(u, 2 * n)
        up = q <= n
        return np.where(up, q, 2 * n - q), np.where(up, 1, -1), 2 * k + np.where(up, 0, 2), zero, zero
    if n == 1:
        return zero, zero, u, zero, zero
    k, q = np.divmod(u, 2 * n - 2)
    up = q <= n
    return (np.where(up, q, 2 * n - 1 - q), np.where(up, 1, -1), 2 * k + np.where(up, 0, 2), -k, -k - np.where(up, 0, 1))


@functools.lru_cache(maxsize=4096)
def ends(n: int, b: int, r: int, mode: str, t: int):
    """The terms at both ends of the windows of target block t, and the range of y that each end reads (empty: first > last)."""
    x = np.arange(t * b, min(n, t * b + b))
    out = []
    for u in (x + r + 1, x - r):
        e = terms(u, n, mode)
        y = e[0][(e[0] > 0) & (e[1] != 0)]
        out.append((e, (int(y.min()), int(y.max())) if len(y) else (1, 0)))
    return out


@functools.lru_cache(maxsize=64)
def reads(n: int, b: int, r: int, mode: str) -> np.ndarray:
    """For AHEAD and BEHIND, first and last y that every target block reads: shape (2, blocks, 2)."""
    return np.array([[ends(n, b, r, mode, t)[k][1] for t in range(-(-n // b))] for k in (0, 1)], np.int64)


@functools.lru_cache(maxsize=64)
def readers(n: int, b: int, r: int, mode: str) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (source block p, target block t), by p: t reads running sums that start with the sum before p."""
    found = set()
    for ranges in reads(n, b, r, mode):
        for t, (lo, hi) in enumerate(ranges.tolist()):
            found.update((p, t) for p in range((lo - 1) // b, (hi - 1) // b + 1) if lo <= hi)
    both = np.array(sorted(found), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


@functools.lru_cache(maxsize=64)
def wholes(n: int, b: int, r: int, mode: str) -> tuple[tuple[int, ...], ...]:
    """For every target block the planes of its whole lines that it needs."""
    return tuple(tuple(kind for kind, term in ((TOTAL, 2), (FIRST, 3), (LAST, 4)) if any(e[term].any() for e, _ in ends(n, b, r, mode, t)))
                 for t in range(-(-n // b)))


def window_pass(df: DataFrame, dims, block, axis: int, r: int, mode: str, read: Callable, finish: Callable,
                every_block: bool = False) -> DataFrame:
    """Blocks of window sums over ``[x-r, x+r]`` along one axis.

    ``df`` has ``gx, gy, gz, payload``.  ``read(payload, size)`` gives (bytes that the block keeps, field set);
    ``finish(kept bytes or None, window sums, size)`` the payload of the result.  A block without stored samples in its line is
    left out unless ``every_block``.
    """
    dims, block = tuple(int(n) for n in dims), tuple(int(b) for b in block)
    n, b, ax = dims[axis], block[axis], 2 - axis
    nb, others = -(-n // b), [g for d, g in enumerate(G) if d != axis]
    mirrored_single = mode == "mirror_single" and n > 1

    def size_of(g):
        return [min(k, m - x * k) for x, k, m in zip(g, block, dims)]

    def plane(s):  # of one sample a line
        shape = [s[2], s[1], s[0]]
        shape[ax] = 1
        return tuple(shape)

    def totals(it):
        out = Outbox([*G, "kind", "payload"], ("kind",))
        for pdf in it:
            for row in pdf.itertuples(index=False):
                g = (row.gx, row.gy, row.gz)
                f = read(row.payload, size_of(g))[1]
                rows = [(TOTAL, {k: x.sum(ax, keepdims=True) for k, x in f.items()})]
                if mirrored_single and g[axis] == 0:
                    rows.append((FIRST, {k: np.take(x, [0], ax) for k, x in f.items()}))
                if mirrored_single and g[axis] == nb - 1:
                    rows.append((LAST, {k: np.take(x, [-1], ax) for k, x in f.items()}))
                for kind, planes in rows:
                    if out.add((*g, kind, X.pack(planes))):
                        yield out.frame()
        if out.rows:
            yield out.frame()

    names = ["tx", "ty", "tz", "kind", "at", "size", "payload"]

    def lines(it):
        """What the targets of a row of blocks need to know of its lines: the blocks pass in their order, and only sums are held."""
        out, (of, target_of), kinds = Outbox(names, ("kind", "size")), readers(n, b, r, mode), wholes(n, b, r, mode)

        def at(g, t):
            key = list(g)
            key[axis] = t
            return key

        def before(g, acc, first, last):  # the sum before the blocks first ... last - 1
            lo, hi = np.searchsorted(of, (first, last))
            if lo < hi:
                packed = X.pack(acc)
                for p, t in zip(of[lo:hi].tolist(), target_of[lo:hi].tolist()):
                    yield (*at(g, t), BEFORE, p, 0, packed)

        def finished(g, acc, done, whole):
            yield from before(g, acc, done, nb)
            whole[TOTAL] = X.pack(acc)
            for t, wanted in enumerate(kinds):
                for kind in wanted:
                    yield (*at(g, t), kind, 0, 0, whole.get(kind) or X.pack({}))

        def rows_of(it):
            g, acc, done, whole = None, {}, 0, {}
            for pdf in it:
                for row in pdf.itertuples(index=False):
                    here, p = [row.gx, row.gy, row.gz], row[axis]
                    if g is None or at(here, 0) != at(g, 0):
                        if g is not None:
                            yield from finished(g, acc, done, whole)
                        g, acc, done, whole = here, {}, 0, {}
                    if row.kind != TOTAL:
                        whole[row.kind] = row.payload
                        continue
                    yield from before(g, acc, done, p + 1)
                    done = p + 1
                    for k, x in X.unpack(row.payload, plane(size_of(g))).items():
                        acc[k] = acc[k] + x if k in acc else x
            if g is not None:
                yield from finished(g, acc, done, whole)

        for x in rows_of(it):
            if out.add(x):
                yield out.frame()
        if out.rows:
            yield out.frame()

    def cut(it):
        out, (ahead, behind) = Outbox(names, ("kind", "size")), reads(n, b, r, mode)
        for pdf in it:
            for row in pdf.itertuples(index=False):
                g = [row.gx, row.gy, row.gz]
                kept, f = read(row.payload, size_of(g))
                run = {k: x.cumsum(ax) for k, x in f.items()}
                o, e = g[axis] * b, min(n, g[axis] * b + b)  # P(o+1) ... P(e)
                rows = [(*g, CENTRE, 0, 0, kept)]
                for kind, ranges in ((AHEAD, ahead), (BEHIND, behind)):
                    lo, hi = np.maximum(ranges[:, 0], o + 1), np.minimum(ranges[:, 1], e)
                    for t in np.flatnonzero(lo <= hi).tolist():
                        part = {k: np.take(x, np.arange(lo[t] - o - 1, hi[t] - o), ax) for k, x in run.items()}
                        key = list(g)
                        key[axis] = t
                        rows.append((*key, kind, int(lo[t]), int(hi[t] - lo[t] + 1), X.pack(part)))
                for x in rows:
                    if out.add(x):
                        yield out.frame()
        if out.rows:
            yield out.frame()

    source = df.select(*G, "payload")
    schema = "tx long, ty long, tz long, kind int, at long, size int, payload binary"
    known = source.mapInPandas(totals, "gx long, gy long, gz long, kind int, payload binary").repartition(*others) \
        .sortWithinPartitions(*others, G[axis]).mapInPandas(lines, schema)
    rows = source.mapInPandas(cut, schema).unionAll(known)
    if every_block:
        rows = rows.unionAll(block_grid(df.sparkSession, dims, block).select(
            *G, F.lit(MARK).cast("int"), F.lit(0).cast("long"), F.lit(0).cast("int"), F.lit(None).cast("binary")))

    def target(pdf: pd.DataFrame):
        g = [int(pdf[c].iloc[0]) for c in ("tx", "ty", "tz")]
        s = size_of(g)
        kept, planes, before, parts = None, {}, {}, {AHEAD: [], BEHIND: []}
        for kind, at, size, payload in zip(pdf["kind"], pdf["at"], pdf["size"], pdf["payload"]):
            if kind == CENTRE:
                kept = payload
            elif kind in parts:
                shape = [s[2], s[1], s[0]]
                shape[ax] = int(size)
                parts[kind].append((int(at), int(size), X.unpack(payload, shape)))
            elif kind == BEFORE:
                before[int(at)] = X.unpack(payload, plane(s))
            elif kind != MARK:
                planes[kind] = X.unpack(payload, plane(s))
        known = [*planes.values(), *before.values(), *(f for p in parts.values() for _, _, f in p)]
        line = [1, 1, 1]
        line[ax] = s[axis]
        both, window = ends(n, b, r, mode, g[axis]), {}
        for i in sorted({k for f in known for k in f}):
            side = []
            for kind, (e, (lo, hi)) in zip((AHEAD, BEHIND), both):
                shape = [s[2], s[1], s[0]]
                shape[ax] = max(0, hi - lo + 1) + 1  # P(0) = 0 at the front
                p = np.zeros(shape, np.int64)
                for q, f in before.items():
                    y0, y1 = max(lo, q * b + 1), min(hi, q * b + b)
                    if i in f and y0 <= y1:
                        p[_at(ax, y0 - lo + 1, y1 - lo + 2)] += f[i]
                for y0, m, f in parts[kind]:
                    if i in f:
                        p[_at(ax, y0 - lo + 1, y0 - lo + 1 + m)] += f[i]
                y, sign, *multiples = e
                v = np.take(p, np.where((y > 0) & (sign != 0), y - lo + 1, 0), ax) * sign.reshape(line)
                for kind_, c in zip((TOTAL, FIRST, LAST), multiples):
                    if c.any() and i in planes.get(kind_, {}):
                        v = v + planes[kind_][i] * c.reshape(line)
                side.append(v)
            window[i] = side[0] - side[1]
        o = [x * k for x, k in zip(g, block)]
        return (*g, *o, *s, finish(kept, window, s))

    return grouped_rows(rows, ["tx", "ty", "tz"], target, BLOCK_SCHEMA, BLOCK_COLUMNS)


def _at(ax: int, lo: int, hi: int) -> tuple:
    where = [slice(None)] * 3
    where[ax] = slice(lo, hi)
    return tuple(where)


def box_windows(df: DataFrame, dims, block, r: int, mode: str, sample: Callable, finish: Callable, every_block: bool = False) -> DataFrame:
    """Window sums over ``(2r+1)^2`` in every z slice: a pass along x, whose result is written, then one along y.

    ``sample(payload, size)`` gives the field set of a block; ``finish(payload or None, window sums, size)`` the result's payload.
    """
    from ..session import cut_lineage

    def joined(kept, f, s):
        kept = kept or b""
        return np.array([len(kept)], "<i8").tobytes() + kept + X.pack(f)

    def parted(payload, s):
        k = 8 + int(np.frombuffer(payload, "<i8", 1)[0])
        return payload[8:k], X.unpack(payload[k:], (s[2], s[1], s[0]))

    rows = window_pass(df, dims, block, 0, r, mode, lambda p, s: (p, sample(p, s)), joined)
    return window_pass(cut_lineage(rows), dims, block, 1, r, mode, parted, lambda kept, f, s: finish(kept or None, f, s), every_block)
