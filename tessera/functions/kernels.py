"""Arrow-batched distance kernels: the one hot spot that leaves the JVM.

Spark's higher-order functions evaluate a 64-wide distance at tens of
microseconds (boxed elements, interpreted lambdas), and written-out arithmetic
grows past the JIT's method size. These steps view each Arrow batch of points
as a matrix, without a Python object per row, and measure it against the
centers of each part with NumPy. A task adds up what its batches give and
returns few rows per part or per (part, label); Spark does the rest. Sums are
exact, in whole numbers, so they do not depend on how the rows are dealt out.

Squares are added coordinate by coordinate from the first on, the order of
``aggregate(zip_with(...), 0D, (s, e) -> s + e)``, so the results are the
same doubles as the SQL expression.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Ship this module's code with the step (by value), so that Python workers do
# not need this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The centers of each part: a (k, dim) matrix.
Model = dict[int, np.ndarray]

NEAREST_SCHEMA = "part INT, id BIGINT, label INT, dist DOUBLE"
RACE_SCHEMA = "part INT, rnd INT, key DOUBLE, id BIGINT, e DOUBLE, w DOUBLE, d DOUBLE, v ARRAY<DOUBLE>"
PICK_SCHEMA = "part INT, rnd INT, id BIGINT, mass DOUBLE, v ARRAY<DOUBLE>"
LIMB_SCHEMA = "part INT, label INT, cnt BIGINT, limb INT, sums ARRAY<BIGINT>"
SUMS_SCHEMA = "part INT, label INT, cnt BIGINT, sw DOUBLE, sd DOUBLE, sx ARRAY<DOUBLE>"

#: Candidates of a round that are kept, by task and in all, and bits of a limb of an exact sum.
CANDIDATES, LIMB_BITS = 32, 24

#: Label of the row that counts distances, and a share that is well above what rounding changes in one.
MEASURED, SLACK = -1, 1e-9


def matrix(v: pa.ListArray, dim: int) -> np.ndarray:
    """A batch's vectors as an (n, dim) matrix of doubles; refuses ragged, NULL or non-finite coordinates."""
    if (np.diff(v.offsets.to_numpy()) != dim).any():
        raise ValueError("vectors of different length")
    flat = v.flatten()
    if flat.null_count:
        raise ValueError("NULL coordinate in a point")
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(v), dim)
    if not np.isfinite(x).all():
        raise ValueError("non-finite coordinate in a point")
    return x


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(n, k) Euclidean distances, squares summed in coordinate order."""
    acc = np.zeros((x.shape[0], c.shape[0]))
    for j in range(x.shape[1]):
        diff = x[:, j, None] - c[None, :, j]
        acc += diff * diff
    return np.sqrt(acc)


def own_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The distance of each row to the same row of ``c``, the doubles that :func:`distances` gives."""
    acc = np.zeros(len(x))
    for j in range(x.shape[1]):
        diff = x[:, j] - c[:, j]
        acc += diff * diff
    return np.sqrt(acc)


def _width(model: Model) -> int:
    return next(iter(model.values())).shape[1] if model else 0


def _centers(model: Model, part: int) -> np.ndarray:
    if part not in model:
        raise ValueError(f"no centers for part {part}")
    return model[part]


def _by_part(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each part of a batch, after one sort."""
    order = np.argsort(parts, kind="stable")
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(parts[rows[0]]), rows


def _lists(vectors: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(v) for v in vectors)])
    flat = np.concatenate(vectors) if vectors else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float64()))


def nearest_rows(df: DataFrame, model: Model, labels: dict[int, np.ndarray]) -> DataFrame:
    """``part, id, v`` to ``part, id, label, dist``: the nearest center of the row's part.

    Ties go to the first center (the lowest label). Every part must have centers.
    """
    dim = _width(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, x = b.column("part").to_numpy(), matrix(b.column("v"), dim)
            label, dist = np.empty(len(parts), np.int32), np.empty(len(parts))
            for p, rows in _by_part(parts):
                d = distances(x[rows], _centers(model, p))
                at = np.argmin(d, axis=1)
                label[rows], dist[rows] = labels[p][at], d[np.arange(len(rows)), at]
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), b.column("id"), pa.array(label), pa.array(dist)], ["part", "id", "label", "dist"]
            )

    return df.select("part", "id", "v").mapInArrow(run, NEAREST_SCHEMA)


def with_bounds(df: DataFrame, model: Model) -> DataFrame:
    """``part, id, v, w`` with ``label``, the row of the nearest center, and ``bound``, the distance to the next one.

    ``bound`` is infinite where there is one center. Points of parts without centers are left out.
    """
    dim, vector = _width(model), df.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, x = b.column("part").to_numpy(), matrix(b.column("v"), dim)
            label, bound = np.full(len(parts), -1, np.int32), np.full(len(parts), np.inf)
            for p, rows in _by_part(parts):
                if p in model:
                    d = distances(x[rows], model[p])
                    at = np.argmin(d, axis=1)
                    d[np.arange(len(rows)), at] = np.inf
                    label[rows], bound[rows] = at, d.min(axis=1)
            arrays = [*(b.column(c) for c in ("part", "id", "v", "w")), pa.array(label), pa.array(bound)]
            out = pa.RecordBatch.from_arrays(arrays, ["part", "id", "v", "w", "label", "bound"])
            yield out.filter(pa.array(label >= 0))

    return df.select("part", "id", "v", "w").mapInArrow(run, f"part INT, id BIGINT, v {vector}, w DOUBLE, label INT, bound DOUBLE")


def others_moved(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """For each center how far any of the others has moved at most."""
    step = own_distances(now, before)
    far = int(np.argmax(step))
    out = np.full(len(step), step[far])
    out[far] = np.delete(step, far).max(initial=0.0)
    return out


class Race(NamedTuple):
    """The rounds of an exponential race that a part runs in one scan: ``first`` to ``end - 1``.

    ``limit`` is the largest key that counts; ``exclude`` are the ids chosen before.
    """

    first: int
    end: int
    limit: float
    exclude: list[int]


def _smallest(key: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((ids, key))[:most]


def race(df: DataFrame, model: Model | None, races: dict[int, Race] | None, first: int = 0) -> DataFrame:
    """``part, rnd, id, mass, v``: the winners of each part's rounds, as far as one scan can tell.

    ``df`` holds ``part, id, v, w, u`` with the uniform draws of the rounds
    from ``first`` on. The winner of a round is the point of the smallest
    (key, id) with the key -ln(u) / (w·d), where d is the distance to the
    nearest center chosen before that round (+Infinity for w·d = 0); without a
    model there is one round and the key is u itself.

    All rounds of a scan are run with the distances to the model's centers. As
    a distance only shrinks with more centers, such a key is a lower bound. A
    round's points with the smallest bounds are kept; their true keys follow
    from the winners of the rounds before, and the smallest one has won if no
    bound that was dropped is under it. The first round where that fails ends
    the part's rounds; the next scan takes them up again. ``mass`` is the sum
    of w·d with the model's centers.
    """
    dim = _width(model or {})
    names = [f.split(" ")[0] for f in RACE_SCHEMA.split(", ")]

    def rows_of(part: int, rnd: int, key, ids, e, w, d, x) -> pa.RecordBatch:
        n = len(ids)
        arrays = [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, rnd, np.int32)), *(pa.array(a, pa.float64()) for a in (key,))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.int64()), *(pa.array(a, pa.float64()) for a in (e, w, d)), _lists(list(x))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], tuple] = {}
        mass: dict[int, float] = {}
        for b in batches:
            if not b.num_rows:
                continue
            parts, ids, w = (b.column(c).to_numpy() for c in ("part", "id", "w"))
            x = matrix(b.column("v"), dim or len(b.column("v")[0]))
            u = b.column("u").flatten().to_numpy().reshape(len(ids), -1)
            for p, rows in _by_part(parts):
                r = Race(0, 1, np.inf, []) if races is None else races.get(p)
                if r is None:
                    continue
                if r.exclude:
                    rows = rows[~np.isin(ids[rows], r.exclude)]
                if model is None:
                    d, wd = np.full(len(rows), np.inf), np.ones(len(rows))
                else:
                    d = distances(x[rows], model[p]).min(axis=1)
                    wd = w[rows] * d
                    mass[p] = mass.get(p, 0.0) + float(wd.sum())
                for rnd in range(r.first, r.end):
                    mine = u[rows, rnd - first]
                    e = mine if model is None else -np.log(mine)
                    key = np.full(len(rows), np.inf)
                    np.divide(e, wd, out=key, where=wd > 0)
                    held = kept.get((p, rnd))
                    most = r.limit if held is None or len(held[0]) < CANDIDATES else min(r.limit, held[0][-1])
                    at = np.flatnonzero(key <= most)
                    if len(at) > CANDIDATES:
                        at = at[_smallest(key[at], ids[rows[at]], CANDIDATES)]
                    if len(at):
                        new = (key[at], ids[rows[at]], e[at], w[rows[at]], d[at], x[rows[at]])
                        both = new if held is None else tuple(np.concatenate(pair) for pair in zip(held, new, strict=True))
                        order = _smallest(both[0], both[1], CANDIDATES)
                        kept[p, rnd] = tuple(c[order] for c in both)
        for (p, rnd), c in kept.items():
            yield rows_of(p, rnd, *c)
        for p, m in mass.items():
            yield rows_of(p, -1, [m], [-1], [0.0], [0.0], [0.0], [np.empty(0)])

    def winners(part: int, rounds: dict[int, list[tuple]], mass: float) -> list[tuple]:
        r = Race(0, 1, np.inf, []) if races is None else races[part]
        out: list[tuple] = [(part, -1, -1, mass, [])]
        chosen, new = set(), []
        for rnd in range(r.first, r.end):
            best = None
            held = rounds.get(rnd, [])
            for key, i, e, w, d, v in held:
                if i in chosen:
                    continue
                if new:
                    d = min(d, float(distances(np.array([v]), np.array(new)).min()))
                    key = e / (w * d) if w * d > 0 else np.inf
                if best is None or (key, i) < best[:2]:
                    best = (key, i, v)
            dropped = held[-1][:2] if len(held) == CANDIDATES else (r.limit, np.inf)
            if best is None or best[:2] > dropped:
                break
            chosen.add(best[1])
            new.append(best[2])
            out.append((part, rnd, best[1], 0.0, best[2]))
        return out

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by part, round, key and id."""
        now, rounds, mass = None, {}, 0.0

        def flush():
            part, rnd, ids, m, v = zip(*winners(now, rounds, mass), strict=True)
            arrays = [pa.array(part, pa.int32()), pa.array(rnd, pa.int32()), pa.array(ids, pa.int64()), pa.array(m, pa.float64()), _lists([np.asarray(x, float) for x in v])]
            return pa.RecordBatch.from_arrays(arrays, ["part", "rnd", "id", "mass", "v"])

        for b in batches:
            columns = [b.column(c).to_pylist() for c in names[:-1]]
            for k, (part, rnd, key, *rest) in enumerate(zip(*columns, strict=True)):
                if part != now:
                    if now is not None:
                        yield flush()
                    now, rounds, mass = part, {}, 0.0
                if rnd < 0:
                    mass += key
                elif len(rounds.setdefault(rnd, [])) < CANDIDATES:
                    rounds[rnd].append((key, *rest, b.column("v")[k].values.to_numpy()))
        if now is not None:
            yield flush()

    found = df.select("part", "id", "v", "w", "u").mapInArrow(run, RACE_SCHEMA)
    dealt = found.repartition("part").sortWithinPartitions("part", "rnd", "key", "id")
    return dealt.mapInArrow(settle, PICK_SCHEMA)


class _Exact:
    """Exact sums of rows of doubles by (part, label): whole numbers of 2**(24 b) for every limb b.

    Each double is cut into limbs of 24 bits at places that are the same for
    all, and the limbs are added up as 64-bit integers (up to 2**39 rows), so
    the sums are the same in any order and grouping.
    """

    def __init__(self):
        self.counts: dict[tuple[int, int], int] = {}
        self.limbs: dict[tuple[int, int, int], np.ndarray] = {}

    def add(self, part: int, labels: np.ndarray, terms: np.ndarray) -> None:
        """Rows of ``terms`` (n, m) under their labels."""
        order = np.argsort(labels, kind="stable")
        labels, rest = labels[order], terms[order]
        starts = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1])))
        sizes = np.diff(np.append(starts, len(labels)))
        for label, n in zip(labels[starts].tolist(), sizes.tolist(), strict=True):
            self.counts[part, label] = self.counts.get((part, label), 0) + n
        while (top := float(np.abs(rest).max(initial=0.0))) > 0:
            limb = (int(np.frexp(top)[1]) - 1) // LIMB_BITS
            whole = np.trunc(np.ldexp(rest, -LIMB_BITS * limb))
            rest = rest - np.ldexp(whole, LIMB_BITS * limb)
            for label, total in zip(labels[starts].tolist(), np.add.reduceat(whole.astype(np.int64), starts, axis=0), strict=True):
                self.put(part, label, limb, total)

    def put(self, part: int, label: int, limb: int, total: np.ndarray) -> None:
        held = self.limbs.get((part, label, limb))
        self.limbs[part, label, limb] = total if held is None else held + total

    def partial(self, width: int) -> pa.RecordBatch:
        """One row per limb; the count is on a row of its own."""
        keys = [(p, label, n, 0, np.zeros(width, np.int64)) for (p, label), n in self.counts.items()]
        keys += [(p, label, 0, limb, total) for (p, label, limb), total in self.limbs.items()]
        part, label, n, limb, sums = zip(*keys, strict=True)
        offsets = np.arange(0, width * len(sums) + 1, width)
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sums), pa.int64()))
        arrays = [pa.array(part, pa.int32()), pa.array(label, pa.int32()), pa.array(n, pa.int64()), pa.array(limb, pa.int32()), lists]
        return pa.RecordBatch.from_arrays(arrays, ["part", "label", "cnt", "limb", "sums"])

    def totals(self, width: int) -> pa.RecordBatch:
        """The sums as doubles: limbs from the lowest up, always in the same order."""
        sums = {key: np.zeros(width) for key in self.counts}
        for (p, label, limb), total in sorted(self.limbs.items(), key=lambda x: x[0]):
            sums[p, label] += np.ldexp(total.astype(np.float64), LIMB_BITS * limb)
        part, label = zip(*sums, strict=True)
        sw, sd = (np.array([t[c] for t in sums.values()]) for c in (0, 1))
        arrays = [pa.array(part, pa.int32()), pa.array(label, pa.int32()), pa.array(list(self.counts.values()), pa.int64()), pa.array(sw), pa.array(sd)]
        return pa.RecordBatch.from_arrays([*arrays, _lists([t[2:] for t in sums.values()])], ["part", "label", "cnt", "sw", "sd", "sx"])


def cluster_sums(
    df: DataFrame, model: Model, by_label: bool = True, strict: bool = True, moved: Model | None = None
) -> DataFrame:
    """``part, v, w`` to ``part, label, cnt, sw, sd, sx``: the count, Σw, Σw·d and Σw·v of each nonempty cluster.

    ``label`` is the center's row in the model; ties go to the first. Without
    ``by_label`` a part has one row, of label 0, without Σw·v. The sums are
    exact up to their last rounding, however the rows are dealt out. A task
    returns a few rows per (part, label) it has seen. Points of a part
    without centers are an error or, if not ``strict``, left out.

    With ``moved`` the points come :func:`with_bounds`, and it has for each
    center how far the others have moved since then (:func:`others_moved`). A
    point whose own center is nearer than its bound less that distance keeps
    its label, as no other center can be as near; one distance is measured
    for it instead of k. A row of label ``MEASURED`` per part counts the
    distances in ``cnt``.
    """
    dim = _width(model)
    width = dim + 2 if by_label else 2

    def nearest(x: np.ndarray, p: int, label: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        c = model[p]
        at, own = label.copy(), own_distances(x, c[label])
        open_ = np.flatnonzero(~(own * (1 + SLACK) + moved[p][label] * (1 + SLACK) < bound * (1 - SLACK)))
        if len(open_):
            d = distances(x[open_], c)
            at[open_] = np.argmin(d, axis=1)
            own[open_] = d[np.arange(len(open_)), at[open_]]
        return at, own, len(x) + len(open_) * len(c)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Exact()
        for b in batches:
            if not b.num_rows:
                continue
            parts, w, x = b.column("part").to_numpy(), b.column("w").to_numpy(), matrix(b.column("v"), dim)
            for p, rows in _by_part(parts):
                if not strict and p not in model:
                    continue
                if moved is None:
                    d = distances(x[rows], _centers(model, p))
                    at = np.argmin(d, axis=1)
                    own = d[np.arange(len(rows)), at]
                else:
                    at, own, n = nearest(x[rows], p, b.column("label").to_numpy()[rows], b.column("bound").to_numpy()[rows])
                    sums.counts[p, MEASURED] = sums.counts.get((p, MEASURED), 0) + n
                wp = w[rows]
                terms = np.empty((len(rows), width))
                terms[:, 0], terms[:, 1] = wp, wp * own
                if by_label:
                    terms[:, 2:] = wp[:, None] * x[rows]
                sums.add(p, at if by_label else np.zeros_like(at), terms)
        if sums.counts:
            yield sums.partial(width)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Exact()
        for b in batches:
            totals = b.column("sums").flatten().to_numpy().reshape(b.num_rows, width)
            rows = zip(*(b.column(c).to_pylist() for c in ("part", "label", "cnt", "limb")), strict=True)
            for k, (p, label, cnt, limb) in enumerate(rows):
                if cnt:
                    sums.counts[p, label] = sums.counts.get((p, label), 0) + cnt
                else:
                    sums.put(p, label, limb, totals[k])
        if sums.counts:
            yield sums.totals(width)

    columns = ["part", "v", "w"] if moved is None else ["part", "v", "w", "label", "bound"]
    partial = df.select(*columns).mapInArrow(assign, LIMB_SCHEMA)
    return partial.repartition("part", "label").mapInArrow(merge, SUMS_SCHEMA)
