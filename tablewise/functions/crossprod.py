"""Correlations of all column pairs of a wide table in one scan.

A task keeps, for its rows, the matrices of counts, sums, sums of squares and sums of
products over the rows where both columns of a pair have a value: with values Z
(missing ones 0) and their mask M these are M'M, Z'M, (Z*Z)'M and Z'Z. Each task
shifts its columns by a value of its own, so a large mean costs no digits; two
tasks' matrices are moved to one shift before they are added. The matrices travel
in blocks of columns and are added in a tree.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import travels
from .scalars import col_

travels(__name__)

# Columns on each side of a block: a task holds 7 matrices of BLOCK x BLOCK doubles for each pair of blocks.
BLOCK = 256
# Pairs of blocks that one scan counts (235 MB in a worker): those of 2,500 columns.
PAIRS_A_SCAN = 64
# Partial results that one task of the tree adds.
FANIN = 16

_SCHEMA = "i int, j int, task int, part binary"


class _Block:
    """Sums over row pairs of columns a (rows) and b (columns), relative to the shifts sa and sb."""

    def __init__(self, sa, sb, n=None, za=None, zb=None, qa=None, qb=None, p=None, bad=None):
        zero = lambda x: np.zeros((len(sa), len(sb))) if x is None else x
        self.sa, self.sb = sa, sb
        self.n, self.za, self.zb, self.qa, self.qb, self.p, self.bad = map(zero, (n, za, zb, qa, qb, p, bad))

    def add_rows(self, xa: np.ndarray, xb: np.ndarray) -> None:
        ma, mb = ~np.isnan(xa), ~np.isnan(xb)
        ia, ib = np.isinf(xa), np.isinf(xb)
        za, zb = (np.where(m & ~i, x - s, 0.0) for m, i, x, s in ((ma, ia, xa, self.sa), (mb, ib, xb, self.sb)))
        ma, mb = ma.astype(float), mb.astype(float)
        self.n += ma.T @ mb
        self.za += za.T @ mb
        self.zb += ma.T @ zb
        self.qa += (za * za).T @ mb
        self.qb += ma.T @ (zb * zb)
        self.p += za.T @ zb
        if ia.any() or ib.any():
            self.bad += ia.astype(float).T @ mb + ma.T @ ib.astype(float)

    def moved(self, sa: np.ndarray, sb: np.ndarray) -> _Block:
        """The same sums relative to other shifts."""
        d, e = (self.sa - sa)[:, None], (self.sb - sb)[None, :]
        return _Block(sa, sb, self.n, self.za + d * self.n, self.zb + e * self.n,
                      self.qa + 2 * d * self.za + d * d * self.n, self.qb + 2 * e * self.zb + e * e * self.n,
                      self.p + e * self.za + d * self.zb + d * e * self.n, self.bad)

    def plus(self, other: _Block) -> _Block:
        o = other.moved(self.sa, self.sb)
        return _Block(self.sa, self.sb, *(getattr(self, x) + getattr(o, x) for x in ("n", "za", "zb", "qa", "qb", "p", "bad")))

    def dump(self) -> bytes:
        return np.concatenate([[len(self.sa), len(self.sb)], self.sa, self.sb, *(
            getattr(self, x).ravel() for x in ("n", "za", "zb", "qa", "qb", "p", "bad"))]).astype("<f8").tobytes()

    @staticmethod
    def load(data: bytes) -> _Block:
        v = np.frombuffer(data, dtype="<f8")
        a, b = int(v[0]), int(v[1])
        rest = v[2 + a + b:].reshape(7, a, b)
        return _Block(v[2:2 + a], v[2 + a:2 + a + b], *(x.copy() for x in rest))

    def r(self) -> np.ndarray:
        """Pearson's r; 0 where it is undefined."""
        with np.errstate(all="ignore"):
            cov = self.p - self.za * self.zb / self.n
            va, vb = self.qa - self.za ** 2 / self.n, self.qb - self.zb ** 2 / self.n
            out = cov / np.sqrt(va * vb)
        ok = (self.n >= 2) & (va > 0) & (vb > 0) & (self.bad == 0) & np.isfinite(out)
        return np.clip(np.where(ok, out, 0.0), -1.0, 1.0)


def _gather(columns: int, pairs: list[tuple[int, int]]):
    def work(batches):
        from pyspark import TaskContext
        found: dict[tuple[int, int], _Block] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                some = batch.slice(lo, 2048)
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in some.columns])
                if not found:
                    with np.errstate(all="ignore"):
                        finite = np.where(np.isfinite(x), x, np.nan)
                    has = ~np.isnan(finite).all(axis=0)
                    first = np.where(has, finite[np.argmax(~np.isnan(finite), axis=0), np.arange(columns)], 0.0)
                    cut = [slice(k * BLOCK, (k + 1) * BLOCK) for k in range(-(-columns // BLOCK))]
                    found = {(i, j): _Block(first[cut[i]], first[cut[j]]) for i, j in pairs}
                for (i, j), block in found.items():
                    block.add_rows(x[:, cut[i]], x[:, cut[j]])
        task = TaskContext.get().partitionId()
        for (i, j), block in found.items():
            yield _row(i, j, task, block)
    return work


def _row(i: int, j: int, task: int, block: _Block) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([task], pa.int32()),
                                       pa.array([block.dump()], pa.binary())], names=["i", "j", "task", "part"])


def _add(batches):
    """Rows come sorted by (i, j, task); one sum a group, one block at a time in memory."""
    key, total = None, None
    for batch in batches:
        for row in batch.to_pylist():
            k, block = (row["i"], row["j"], row["task"]), _Block.load(row["part"])
            if k == key:
                total = total.plus(block)
            else:
                if key:
                    yield _row(*key, total)
                key, total = k, block
    if key:
        yield _row(*key, total)


def correlations(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson's r of all pairs of numeric columns over the rows where both have a value; 0 where undefined.

    Null and NaN are missing; a pair that meets an infinite value is undefined. One scan for up to
    2,500 columns, then one for each further PAIRS_A_SCAN pairs of blocks.
    """
    n_blocks = -(-len(cols) // BLOCK)
    pairs = [(i, j) for i in range(n_blocks) for j in range(i, n_blocks)]
    values = df.select(*[col_(c).cast("double").alias(f"_{k}") for k, c in enumerate(cols)])
    out = np.zeros((len(cols), len(cols)))
    for at in range(0, len(pairs), PAIRS_A_SCAN):
        some = pairs[at:at + PAIRS_A_SCAN]
        rows = values.mapInArrow(_gather(len(cols), some), _SCHEMA)
        tasks = values.rdd.getNumPartitions()
        while tasks > 1:
            tasks = -(-tasks // FANIN)
            rows = rows.withColumn("task", F.floor(F.col("task") / FANIN).cast("int"))
            rows = (rows.repartition(max(1, min(len(some) * tasks, 200)), "i", "j", "task").sortWithinPartitions("i", "j", "task")
                    .mapInArrow(_add, _SCHEMA))
        for r in rows.toLocalIterator():  # one block a pair of blocks
            block = _Block.load(r["part"]).r()
            a, b = r["i"] * BLOCK, r["j"] * BLOCK
            out[a:a + block.shape[0], b:b + block.shape[1]] = block
            out[b:b + block.shape[1], a:a + block.shape[0]] = block.T
    return out
