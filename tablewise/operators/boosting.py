"""Gradient-boosted trees of any number of rows whose model does not depend on how the rows lie (M2).

The method is that of Spark ML's boosters (a first tree on the labels, then trees on the negative gradient of the
squared or logistic loss, variance as impurity, a fixed rate, row and feature sampling, up to ``maxBins`` bins a
feature), and what is returned are Spark ML's own models. Three things differ, so that the same rows give the same
model in any number of partitions:

* Bin borders come from counts of all rows (``feature_cuts``), not from a sample of them.
* A row is in a tree's sample by a hash of the row, not by its place in a partition.
* Gradients are summed as whole numbers (of a 2^-b part of the largest one), so the order of a sum does not matter.

A fit is one stage. Each task holds its rows as bytes (a bin a feature) and keeps their margins from tree to tree;
after every level of a tree the tasks of the stage (a barrier stage, so they run side by side) exchange their
histograms through the shared folder and find the same splits. So a level costs one exchange instead of a job.
"""
from __future__ import annotations

import json
import math
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.classification import GBTClassifier as SparkGBTClassifier
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.regression import GBTRegressor as SparkGBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_
from ..session import scratch_path, travels

travels(__name__)

# Rows that a task works on at a time, and combined bins that several features share in one count.
CHUNK = 1 << 17
GROUP_BINS = 1024
# Bytes of numbers that a task takes from the others at once; above, each task sums a piece of them for all.
EXCHANGE_BYTES = 4 << 20
# Bytes that a task holds for its rows (about), and for one row beside its bins.
TASK_BYTES = 256 << 20
ROW_BYTES = 48
# Parts that a range of values is cut into while bin borders are looked for, and ranges so cut in one pass.
CUT_PARTS = 2048
CUT_RANGES = 512

CODES = "_x binary, _t double, _h bigint"
NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
         "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,"
         "numCategories:int>>")

_SIGN = np.uint64(1 << 63)


# --------------------------------------------------------------------------- #
# bins
# --------------------------------------------------------------------------- #
def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _double(key: int) -> float:
    key = np.uint64(key)
    return float((key & ~_SIGN if key & _SIGN else ~key).view(np.float64))


def _counted(ranges: dict):
    """(feature values) to (feature, range, part, n, least, largest): rows in equal parts of the ranges of each feature.

    Least and largest are as ``_ordered``, moved to signed numbers; features go by their place.
    """
    def run(batches):
        sums: dict = {}
        for batch in batches:
            for f, spans in ranges.items():
                v = batch.column(f).to_numpy(zero_copy_only=False)
                key, n = np.unique(_ordered(v[~np.isnan(v)]), return_counts=True)
                lows, highs, shifts = spans
                at = np.searchsorted(lows, key, side="right") - 1
                in_one = (at >= 0) & (key <= highs[at])
                key, n, at = key[in_one], n[in_one], at[in_one]
                if not len(key):
                    continue
                part = ((key - lows[at]) >> shifts[at]).astype(np.int64)
                cell = at * (2 * CUT_PARTS) + part  # keys are sorted, so cells are
                first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                last = np.r_[first[1:], len(cell)] - 1
                for c, m, lo, hi in zip(cell[first].tolist(), np.add.reduceat(n, first).tolist(), key[first].tolist(),
                                        key[last].tolist(), strict=True):
                    was = sums.get((f, c))
                    sums[f, c] = (m, lo, hi) if was is None else (was[0] + m, min(was[1], lo), max(was[2], hi))
        rows = [(f, *divmod(c, 2 * CUT_PARTS), m, lo - (1 << 63), hi - (1 << 63)) for (f, c), (m, lo, hi) in sums.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                             names=["f", "r", "p", "n", "lo", "hi"])
    return run


def feature_cuts(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Bin borders of the first ``features`` columns (doubles): v <= cuts[i] is left of border i. NaN is not counted.

    A feature of at most ``bins`` values is cut between all of them, another so that bins hold about equally
    many rows. All rows are counted in parts of the range of values; parts of several values that hold over
    1 / (8 bins) of the rows are cut again, until none is left. At most CUT_RANGES * 8 counts a feature are read here.
    """
    whole = (np.array([0], np.uint64), np.array([np.iinfo(np.uint64).max], np.uint64))
    cells: dict[int, list] = {f: [] for f in range(features)}
    todo: dict[int, tuple] = {f: (*whole, np.array([64 - int(math.log2(CUT_PARTS))], np.uint64)) for f in range(features)}
    while todo:
        found = (rows.mapInArrow(_counted(todo), "f bigint, r bigint, p bigint, n bigint, lo bigint, hi bigint")
                 .groupBy("f", "r", "p").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
        for r in found:
            cells[r["f"]].append((r["lo"] + (1 << 63), r["hi"] + (1 << 63), r["n"]))
        again = {}
        for f in todo:
            total = sum(n for *_, n in cells[f])
            few = len(cells[f]) <= bins  # it may have few values: all parts must be of one
            wide = [c for c in cells[f] if c[0] < c[1] and (few or c[2] * 8 * bins > total)][:CUT_RANGES]
            if wide:
                cells[f] = sorted(set(cells[f]) - set(wide))
                parts = CUT_PARTS if len(wide) <= 2 else max(8, CUT_RANGES * 8 // len(wide))
                shift = [max(0, (hi - lo).bit_length() - int(math.log2(parts))) for lo, hi, _ in sorted(wide)]
                again[f] = (np.array([c[0] for c in sorted(wide)], np.uint64), np.array([c[1] for c in sorted(wide)], np.uint64),
                            np.array(shift, np.uint64))
        todo = again
    return [_borders(sorted(cells[f]), bins) for f in range(features)]


def _borders(cells: list[tuple], bins: int) -> np.ndarray:
    """Borders between cells (least, largest, n): between all if they are few, else where a border comes nearest to equal parts."""
    def between(a, b):
        lo, hi = _double(a[1]), _double(b[0])
        mid = lo / 2 + hi / 2
        return mid if lo <= mid < hi else lo  # infinities, and neighbours without a double between them
    if len(cells) <= bins:
        return np.array([between(a, b) for a, b in zip(cells, cells[1:])], np.float64)
    stride = sum(n for *_, n in cells) / bins
    out, seen, want = [], cells[0][2], stride
    for a, b in zip(cells, cells[1:]):
        before, seen = seen, seen + b[2]
        if abs(before - want) < abs(seen - want):
            out.append(between(a, b))
            want += stride
    return np.array(out[:bins - 1], np.float64)


def _binned(cuts: list[np.ndarray]):
    """(feature values, _t, _h) to (_x, _t, _h): a byte a feature; NaN is in the last bin."""
    def run(batches):
        for batch in batches:
            n, k = batch.num_rows, len(cuts)
            x = np.empty((n, k), np.uint8)
            for f, c in enumerate(cuts):
                x[:, f] = np.searchsorted(c, batch.column(f).to_numpy(zero_copy_only=False))
            at = pa.array(np.arange(n + 1, dtype=np.int32) * k).buffers()[1]
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), n, [None, at, pa.py_buffer(x.tobytes())]),
                                              batch.column(k), batch.column(k + 1)], names=["_x", "_t", "_h"])
    return run


def binned(train: DataFrame, feature_cols: list[str], target: str, bins: int) -> tuple[DataFrame, list[np.ndarray]]:
    """Training rows (CODES) and the bin borders. ``_h`` is a hash of the whole row, by which trees sample rows.

    Null features become NaN. The rows are written once, for the passes over them.
    """
    hashed = [col_(f.name) for f in train.schema.fields if "map<" not in f.dataType.simpleString()
              and f.dataType.simpleString() != "variant"]
    path = scratch_path(train.sparkSession, "fit-rows")
    values = [F.coalesce(col_(c).cast("double"), F.lit(float("nan"))).alias(f"f{i}") for i, c in enumerate(feature_cols)]
    train.select(*values, col_(target).cast("double").alias("_t"), F.xxhash64(*hashed).alias("_h")).write.parquet(path)
    rows = train.sparkSession.read.parquet(path)
    cuts = feature_cuts(rows.select(*[f"f{i}" for i in range(len(feature_cols))]), len(feature_cols), bins)
    return rows.mapInArrow(_binned(cuts), CODES), cuts


# --------------------------------------------------------------------------- #
# trees
# --------------------------------------------------------------------------- #
class _Tasks:
    """What the tasks of a fit tell each other, through small files in the shared folder; a fit of one task needs none.

    (Spark's own exchange between the tasks of a barrier stage looks for the answer once a second.) A file is there
    whole or not at all. Whoever has all files of one exchange knows that those of the one before were read.
    """

    def __init__(self, n: int, folder: str):
        self.n, self.me, self.turn, self.old = n, 0, 0, []
        if n > 1:
            from pyspark import BarrierTaskContext
            context = BarrierTaskContext.get()
            self.me = context.partitionId()
            said = context.allGather(uuid.uuid4().hex)[0]  # a stage that is tried again has a folder of its own
            self.fs, self.folder = _file_system(f"{folder}/{said}")
            self.fs.create_dir(self.folder, recursive=True)

    def _say(self, a: np.ndarray) -> str:
        """Give ``a`` to the others; the names of all files of this exchange."""
        self.turn += 1
        mine = f"{self.folder}/{self.turn}-{self.me}"
        with self.fs.open_output_stream(f"{mine}.part") as f:
            f.write(memoryview(np.ascontiguousarray(a)).cast("B"))
        self.fs.move(f"{mine}.part", mine)
        self.old.append(mine)
        return f"{self.folder}/{self.turn}-"

    def _hear(self, name: str, lo: int = 0, size: int | None = None) -> bytes:
        pause = 0.0002
        while True:
            try:
                with self.fs.open_input_file(name) as f:
                    return f.read() if size is None else f.read_at(size, lo)
            except FileNotFoundError:
                time.sleep(pause)
                pause = min(2 * pause, 0.02)

    def _heard(self) -> None:
        for name in self.old[:-1]:
            self.fs.delete_file(name)
        del self.old[:-1]

    def total(self, a: np.ndarray) -> np.ndarray:
        """Sums of whole numbers over the tasks."""
        if self.n == 1:
            return a
        flat = np.ascontiguousarray(a).ravel()
        if flat.nbytes * self.n > EXCHANGE_BYTES:  # each task sums a piece for all
            step = 8 * math.ceil(flat.size / self.n)
            names = self._say(flat)
            piece = sum(np.frombuffer(self._hear(f"{names}{t}", step * self.me, step), np.int64) for t in range(self.n))
            self._heard()
            names = self._say(piece)
            out = np.concatenate([np.frombuffer(self._hear(f"{names}{t}"), np.int64) for t in range(self.n)])
        else:
            names = self._say(flat)
            out = sum(np.frombuffer(self._hear(f"{names}{t}"), np.int64) for t in range(self.n))
        self._heard()
        return out.reshape(a.shape)

    def most(self, x: float) -> float:
        if self.n == 1:
            return x
        names = self._say(np.array([x]))
        out = max(float(np.frombuffer(self._hear(f"{names}{t}"))[0]) for t in range(self.n))
        self._heard()
        return out


def _file_system(folder: str):
    from pyarrow import fs
    if "://" in folder:
        return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), folder


class _Grower:
    """Rows of one task, and the trees that all tasks grow."""

    def __init__(self, batches, spec: dict):
        self.spec, self.tasks = spec, _Tasks(spec["tasks"], spec["folder"])
        self.sizes = [len(c) + 1 for c in spec["cuts"]]
        k = len(self.sizes)
        xs, ys, hs = [np.empty(0, np.uint8)], [np.empty(0)], [np.empty(0, np.int64)]
        for batch in batches:
            x = batch.column(0)
            ends = np.frombuffer(x.buffers()[1], np.int32)
            xs.append(np.frombuffer(x.buffers()[2], np.uint8)[ends[x.offset]:ends[x.offset + len(x)]].copy())
            ys.append(batch.column(1).to_numpy(zero_copy_only=False).copy())
            hs.append(batch.column(2).to_numpy(zero_copy_only=False).copy())
        self.x, y, self.h = np.concatenate(xs), np.concatenate(ys), np.concatenate(hs).view(np.uint64)
        del xs, ys, hs
        self.n = len(y)
        bad = np.isnan(y).sum() if not spec["logistic"] else (~np.isin(y, (0.0, 1.0))).sum()
        self.rows, bad = self.tasks.total(np.array([self.n, bad], np.int64)).tolist()
        if not self.rows or bad:
            raise ValueError("labels of boosted trees must not be null or NaN, and those of two classes 0 or 1" if bad
                             else "no training rows")
        self.y = 2 * y - 1 if spec["logistic"] else y
        self._group()
        self.margin = np.zeros(self.n)
        self.part = np.empty(self.n)  # gradients as whole numbers
        self.at = np.empty(self.n, np.int16 if spec["depth"] < 14 else np.int32)
        self.chosen = np.empty(self.n, bool)
        self.chunks = [slice(a, min(a + CHUNK, self.n)) for a in range(0, self.n, CHUNK)]
        self.base = np.arange(min(CHUNK, self.n), dtype=np.intp) * k
        self.bits = min(40, 52 - int(self.rows).bit_length())

    def _group(self) -> None:
        """Features whose bins have few combinations are counted together: a code a row for each such group."""
        groups: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            fits = [g for g in groups if math.prod(self.sizes[i] for i in g) * self.sizes[f] <= GROUP_BINS]
            if self.sizes[f] > 1:  # a feature of one value splits nothing
                fits[0].append(f) if fits else groups.append([f])
        x = self.x.reshape(self.n, len(self.sizes))
        self.groups = []
        for g in groups:
            code = np.zeros(self.n, np.uint16)
            for f in g:
                code *= np.uint16(self.sizes[f])
                code += x[:, f]
            self.groups.append((g, math.prod(self.sizes[f] for f in g), code, self._parts(g)))

    def _parts(self, group: list[int]) -> np.ndarray:
        """Which of the group's codes a feature's bin is a part of: a matrix (code, bin of the group's features in turn)."""
        size = [self.sizes[f] for f in group]
        bins = np.indices(size).reshape(len(size), -1)
        return np.concatenate([b[:, None] == np.arange(n) for b, n in zip(bins, size)], axis=1).astype(np.float64)

    def gradient(self, tree: int) -> float:
        """Set the gradients as multiples of the unit, which is returned, and the rows of the tree's sample."""
        spec, mix = self.spec, np.uint64(spec_mix(self.spec["seed"], tree))
        for c in self.chunks:
            y = self.y[c]
            if tree == 0:
                r = y
            elif spec["logistic"]:
                r = 4 * y / (1 + np.exp(2 * y * self.margin[c]))
            else:
                r = 2 * (y - self.margin[c])
            self.part[c] = r
            z = self.h[c] ^ mix
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            self.chosen[c] = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) < np.uint64(int(spec["bag"] * (1 << 53)))
        most = 4.0 if spec["logistic"] else self.tasks.most(float(np.abs(self.part).max()) if self.n else 0.0)
        if not math.isfinite(most):
            raise ValueError("labels of boosted trees must be finite")
        unit = math.ldexp(1.0, math.frexp(most)[1] - self.bits) if most else 1.0
        for c in self.chunks:
            np.rint(np.divide(self.part[c], unit, out=self.part[c]), out=self.part[c])
        return unit

    def level(self, move: tuple | None, slots: np.ndarray, n: int) -> np.ndarray:
        """Move rows down (``move``), then count rows and sum gradients of ``n`` nodes: (2, node, feature, bin)."""
        # whole numbers below 2^53, so doubles sum them exactly in any order
        tables = [np.zeros((2, n * size)) for _, size, *_ in self.groups]
        for c in self.chunks:
            self._move(c, move)
            slot = slots.take(self.at[c])
            rows = np.flatnonzero(self.chosen[c] & (slot >= 0))
            slot, part = slot.take(rows), self.part[c].take(rows)
            for (_, size, code, _), table in zip(self.groups, tables):
                place = slot * size
                place += code[c].take(rows)
                table[0] += np.bincount(place, minlength=n * size)
                table[1] += np.bincount(place, part, n * size)
        out = np.zeros((2, n, len(self.sizes), max(self.sizes)), np.int64)
        for (group, size, _, parts), table in zip(self.groups, tables):
            sums, at = table.reshape(2 * n, size) @ parts, 0
            for f in group:
                out[:, :, f, :self.sizes[f]] = sums[:, at:at + self.sizes[f]].reshape(2, n, -1)
                at += self.sizes[f]
        return out

    def _move(self, c: slice, move: tuple | None) -> None:
        if move is None:
            self.at[c] = 0
            return
        feature, cut, left = move
        at = self.at[c]
        n = len(at)
        where = self.base[:n] + feature.take(at)
        bin_ = self.x[c.start * len(self.sizes):c.stop * len(self.sizes)].take(where)
        self.at[c] = left.take(at) + (bin_ > cut.take(at))

    def leaves(self, move: tuple | None, n: int) -> np.ndarray:
        """Rows moved down to the leaves; of each node what its rows of the sample sum to: number, gradients, squares."""
        out = np.zeros((3, n), np.int64)
        scale = math.ldexp(1.0, -self.bits)
        for c in self.chunks:
            self._move(c, move)
            rows = np.flatnonzero(self.chosen[c])
            at, part = self.at[c].take(rows), self.part[c].take(rows)
            out[0] += np.bincount(at, minlength=n)
            out[1] += np.bincount(at, part, n).astype(np.int64)
            out[2] += np.bincount(at, np.rint(part * part * scale), n).astype(np.int64)
        return self.tasks.total(out)

    def tree(self, t: int) -> list[tuple]:
        """Grow tree ``t``: its nodes in the order of Spark's model files."""
        spec = self.spec
        unit = self.gradient(t)
        feature, cut, left, gain = [0], [255], [0], [0.0]  # a leaf keeps its rows: no bin is above 255
        move, small, large, known = None, [0], [], None
        for depth in range(spec["depth"]):
            slots = np.full(len(feature), -1, np.int64)
            slots[small] = np.arange(len(small))
            have = self.tasks.total(self.level(move, slots, len(small)))
            nodes = list(small)
            if depth:  # what a parent's other rows hold
                nodes += large
                have = np.concatenate([have, known - have], axis=1)
            best, gains, n_left, n_all = self._splits(have, [spec_mix(spec["seed"], t, i) for i in nodes])
            small, large, parents = [], [], []
            for i, node in enumerate(nodes):
                if gains[i] > 0:
                    f, b = divmod(int(best[i]), have.shape[3])
                    feature[node], cut[node], left[node], gain[node] = f, b, len(feature), float(gains[i]) * unit * unit
                    feature += [0, 0]
                    cut += [255, 255]
                    left += [len(left), len(left) + 1]
                    gain += [0.0, 0.0]
                    less = 2 * n_left[i] <= n_all[i]
                    small.append(left[node] + (0 if less else 1))
                    large.append(left[node] + (1 if less else 0))
                    parents.append(i)
            move = (np.array(feature, np.intp), np.array(cut, np.int16), np.array(left, self.at.dtype)) if depth or small else None
            if not small:
                break
            known = have[:, parents]
        n, s, q = self.leaves(move, len(feature)).tolist()
        for i in reversed(range(len(feature))):  # children come after their parents
            if left[i] != i:
                for a in (n, s, q):
                    a[i] = a[left[i]] + a[left[i] + 1]
        mean = [s[i] / n[i] * unit if n[i] else 0.0 for i in range(len(feature))]
        square = [q[i] * unit * unit * 2.0 ** self.bits for i in range(len(feature))]
        weight = 1.0 if t == 0 else spec["rate"]
        value = np.array(mean) * weight
        for c in self.chunks:
            self.margin[c] += value.take(self.at[c])
        return self._written(t, feature, cut, left, gain, n, mean, square)

    def _splits(self, have: np.ndarray, seeds: list[int]) -> tuple:
        """Of each node the best place (feature, bin) to cut after, its gain, the rows left of it and all rows."""
        n, s = have[0].cumsum(axis=2), have[1].cumsum(axis=2)
        n_all, s_all = n[:, :, -1:], s[:, :, -1:]
        # a feature of one bin is not counted: all rows of a node are those of any other
        n_all, s_all = n_all.max(axis=1, keepdims=True), np.take_along_axis(s_all, n_all.argmax(axis=1, keepdims=True), axis=1)
        n_right = n_all - n
        ok = (n > 0) & (n_right > 0)
        k = len(self.sizes)
        if self.spec["features"] < k:
            for i, seed in enumerate(seeds):
                drawn = np.random.default_rng(seed).permutation(k)[self.spec["features"]:]
                ok[i, drawn] = False
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = s / n - (s_all - s) / n_right
            gains = np.where(ok, (n / n_all) * (n_right / n_all) * apart * apart, 0.0)
        flat = gains.reshape(len(gains), -1)
        best = flat.argmax(axis=1)
        at = np.arange(len(gains))
        return best, flat[at, best], n.reshape(len(gains), -1)[at, best], n_all[:, 0, 0]

    def _written(self, t, feature, cut, left, gain, n, mean, square) -> list[tuple]:
        rows, cuts = [], self.spec["cuts"]

        def put(i: int) -> int:
            place = len(rows)
            rows.append(None)
            impurity = max(0.0, square[i] / n[i] - mean[i] ** 2) if n[i] else 0.0
            own = (t, place, mean[i], impurity, [float(n[i]), n[i] * mean[i], square[i]], n[i])
            if left[i] == i:
                rows[place] = (*own, -1.0, -1, -1, -1, [])
            else:
                a, b = put(left[i]), put(left[i] + 1)
                rows[place] = (*own, gain[i], a, b, feature[i], [float(cuts[feature[i]][cut[i]])])
            return place
        put(0)
        return rows


def spec_mix(*numbers: int) -> int:
    """64 bits for whole numbers, the same everywhere."""
    z = 0
    for x in numbers:
        z = (z ^ (x & (1 << 64) - 1)) + 0x9E3779B97F4A7C15 & (1 << 64) - 1
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
        z = (z ^ z >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
        z ^= z >> 31
    return z


def _grown(spec: dict):
    """(_x, _t, _h) of all rows to the nodes of all trees (NODES), from the first task."""
    def run(batches):
        grower = _Grower(batches, spec)
        for t in range(spec["trees"]):
            rows = grower.tree(t)
            if grower.tasks.me == 0:
                tree, id_, mean, impurity, stats, n, gain, a, b, feature, cut = zip(*rows, strict=True)
                split = pa.StructArray.from_arrays(
                    [pa.array(feature, pa.int32()), pa.array(cut, pa.list_(pa.float64())), pa.array([-1] * len(rows), pa.int32())],
                    names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
                node = pa.StructArray.from_arrays(
                    [pa.array(id_, pa.int32()), pa.array(mean), pa.array(impurity), pa.array(stats, pa.list_(pa.float64())),
                     pa.array(n, pa.int64()), pa.array(gain), pa.array(a, pa.int32()), pa.array(b, pa.int32()), split],
                    names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
                yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), node], names=["treeID", "nodeData"])
    return run


# --------------------------------------------------------------------------- #
# estimators
# --------------------------------------------------------------------------- #
def slots(spark) -> int:
    """Tasks that run at the same time."""
    try:
        sc = spark.sparkContext._jsc.sc()
        return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))
    except Exception:  # a remote session has no local context
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class _Boosted:
    """Fits rows of CODES (``labelCol`` beside them); ``cuts`` are the borders of their bins, ``rows`` their number.

    ``partitions`` is the number of tasks the rows are worth, ``together`` that of the fits that share the cores.
    """

    def __init__(self, *, cuts: list[np.ndarray], rows: int, partitions: int = 1, together: int = 1, **params):
        super().__init__(**params)
        self.cuts, self.rows, self.partitions, self.together = cuts, rows, partitions, together

    def _fit(self, dataset: DataFrame):
        spark, k = dataset.sparkSession, len(self.cuts)
        if not k:
            raise ValueError("boosted trees need a feature")
        cores = slots(spark)
        held = math.ceil(self.rows * (ROW_BYTES + 3 * k) / TASK_BYTES)
        tasks = min(cores, max(held, min(self.partitions, max(1, cores // self.together))))
        path = scratch_path(spark, "booster")
        spec = {"cuts": self.cuts, "tasks": tasks, "folder": f"{path}/exchange", "trees": self.getMaxIter(), "depth": self.getMaxDepth(),
                "rate": self.getStepSize(), "bag": self.getSubsamplingRate(), "seed": self.getSeed(),
                "features": math.ceil(float(self.getFeatureSubsetStrategy()) * k), "logistic": self._logistic}
        rows = dataset.select("_x", col_(self.getLabelCol()).cast("double").alias("_t"), "_h")
        rows = rows.coalesce(1) if tasks == 1 else rows.repartition(tasks)
        rows.mapInArrow(_grown(spec), NODES, barrier=tasks > 1).write.parquet(f"{path}/data")
        self._describe(spark, path, k)
        return self._copyValues(self._model.load(path))

    def _describe(self, spark, path: str, k: int) -> None:
        """The rest of a model folder as Spark writes it."""
        def doc(name: str, uid: str, drop=()) -> dict:
            def named(params):
                return {p.name: v for p, v in params.items() if p.name not in drop}
            return {"class": name, "timestamp": 0, "sparkVersion": spark.version, "uid": uid,
                    "paramMap": named(self._paramMap), "defaultParamMap": named(self._defaultParamMap)}
        n = self.getMaxIter()
        head = doc(self._java_name, self.uid, ("probabilityCol", "rawPredictionCol") if not self._logistic else ())
        head |= {"numFeatures": k, "numTrees": n}
        own = ("featureSubsetStrategy", "lossType", "maxIter", "stepSize", "subsamplingRate", "validationTol", "probabilityCol",
               "rawPredictionCol", "thresholds", "validationIndicatorCol")
        trees = [(t, json.dumps(doc("org.apache.spark.ml.regression.DecisionTreeRegressionModel", f"{self.uid}_{t}", own)),
                  1.0 if t == 0 else self.getStepSize()) for t in range(n)]
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")


class GBTRegressor(_Boosted, SparkGBTRegressor):
    _logistic, _model, _java_name = False, GBTRegressionModel, "org.apache.spark.ml.regression.GBTRegressionModel"


class GBTClassifier(_Boosted, SparkGBTClassifier):
    _logistic, _model, _java_name = True, GBTClassificationModel, "org.apache.spark.ml.classification.GBTClassificationModel"
