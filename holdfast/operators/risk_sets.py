"""Risk-set sums of a Cox model over any number of different durations.

Durations fall into cells: ranges of time, in which every cut point is a cell of its
own. A cell of one duration needs only its sums, one aggregate for all of them. Rows
of the other cells are ordered inside their cell and walked from its longest duration
to its shortest, with the sums of all longer cells as a start. So a pass is one
aggregate by cell and, where some cell holds several durations, one ordered walk of
those rows; the driver sees one row per cell, never one per duration.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.ranking import ROWS_PER_CELL, _apart, _edges
from holdfast.session import materialize

MAX_CELLS = 4096
_SAMPLE = 50  # sampled rows per cell
_CELL_NUMBERS = 1 << 22  # sums of all cells that reach the driver, about
_WALK_ROWS = 2048  # rows whose products are in memory at a time
_TAIL = 32  # tied events summed one by one; the rest by formula, at any number of ties


def efron_sums(total, dying, d) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over l < d of 1/f, 1/f^2 and log f, with f = total - l/d x dying; arrays in, arrays out.

    The last ``_TAIL`` terms, where f may come close to zero, are added one by one. The terms before
    them follow from the Euler-Maclaurin formula; as f there stays above ``_TAIL`` steps, its
    remainder is below double precision. The same rule holds for any number of ties.
    """
    total, dying, d = (np.atleast_1d(np.asarray(v, float)) for v in (total, dying, d))
    step = dying / d
    out = [np.zeros(len(d)) for _ in range(3)]
    for back in range(1, _TAIL + 1):
        some = d >= back
        f = total[some] - (d[some] - back) / d[some] * dying[some]
        for sums, g in zip(out, (1 / f, 1 / f**2, np.log(f))):
            sums[some] += g
    head = d > _TAIL
    if head.any():
        n, h, f0 = d[head] - _TAIL, step[head], total[head]
        f1 = f0 - n * h
        drop = -np.log1p(-n * h / f0)  # log f0 - log f1
        integrals = (drop / h, n / (f0 * f1), n * np.log(f1) + f0 / h * (drop - n * h / f0))
        ends = ((1 / f0, 1 / f1), (1 / f0**2, 1 / f1**2), (np.log(f0), np.log(f1)))
        # odd derivatives at both ends, and Bernoulli numbers over factorials
        weights = {1: 1 / 12, 3: -1 / 720, 5: 1 / 30240, 7: -1 / 1209600}
        for k, (sums, integral, (g0, g1)) in enumerate(zip(out, integrals, ends)):
            value = integral + (g0 - g1) / 2
            for m, w in weights.items():
                if k == 2:
                    scale = -math.factorial(m - 1)
                    value += w * scale * ((h / f1) ** m - (h / f0) ** m)
                else:
                    scale = math.factorial(m + k)
                    value += w * scale * ((h / f1) ** m * g1 - (h / f0) ** m * g0)
            sums[head] += value
    return out[0], out[1], out[2]


def _efron_terms(d, z, all_sums, own_sums, beta):
    """Log-likelihood, gradient and packed information of tied groups, summed.

    ``all_sums`` are (s0, s1, s2) of the rows at risk and ``own_sums`` those of the dying, one
    group a row; ``z`` holds the dying's covariate sums, s2 the upper triangle row by row.
    """
    (s0, s1, s2), (d0, d1, d2) = all_sums, own_sums
    p = len(beta)
    a0, b0, logs = efron_sums(s0, d0, d)
    # sums weighted by l/d follow from total - f = l/d x dying
    a1 = (s0 * a0 - d) / d0
    b1 = (s0 * b0 - a0) / d0
    b2 = (s0 * b1 - a1) / d0
    upper_j, upper_k = np.triu_indices(p)
    loglik = float((z @ beta).sum() - logs.sum())
    gradient = (z - s1 * a0[:, None] + d1 * a1[:, None]).sum(axis=0)
    cross = s1[:, upper_j] * d1[:, upper_k] + d1[:, upper_j] * s1[:, upper_k]
    information = (
        s2 * a0[:, None]
        - d2 * a1[:, None]
        - s1[:, upper_j] * s1[:, upper_k] * b0[:, None]
        + cross * b1[:, None]
        - d1[:, upper_j] * d1[:, upper_k] * b2[:, None]
    ).sum(axis=0)
    return loglik, gradient, information


def _square(packed: np.ndarray, p: int) -> np.ndarray:
    out = np.zeros((p, p))
    j, k = np.triu_indices(p)
    out[j, k] = out[k, j] = packed
    return out


def _groups(frames: Iterator[pd.DataFrame], beta: np.ndarray, carried: dict[int, np.ndarray]):
    """Walk rows ordered by (cell, longest first): blocks of tied groups that are complete.

    Yields (cell, t, d, z, all, own) with a row per duration: ``all`` sums everyone at risk, the
    cell's later rows and the cells after it included. Only one block of rows and the sums of
    the duration in work are held.
    """
    p = len(beta)
    j, k = np.triu_indices(p)
    width = 1 + p + len(j)
    cell = at = None
    running = np.zeros(width)  # everyone with a longer duration
    open_ = np.zeros(1 + p + 2 * width)  # the duration in work: d, z, everyone, the dying

    def close():
        nonlocal running
        everyone = running + open_[1 + p : 1 + p + width]
        done = (cell, np.array([at]), open_[:1], open_[None, 1 : 1 + p], everyone[None], open_[None, 1 + p + width :])
        running = everyone
        return done

    for frame in frames:
        for start in range(0, len(frame), _WALK_ROWS):
            part = frame.iloc[start : start + _WALK_ROWS]
            cells, times = part["cell"].to_numpy(), part["t"].to_numpy()
            x = part.iloc[:, 3:].to_numpy(float).reshape(len(part), p)
            died = (part["e"].to_numpy() == 1).astype(float)
            r = np.exp(x @ beta)
            sums = np.column_stack((np.ones(len(part)), x, x[:, j] * x[:, k])) * r[:, None]
            rows = np.column_stack((died, x * died[:, None], sums, sums * died[:, None]))
            edge = np.flatnonzero(np.r_[True, (np.diff(cells) != 0) | (np.diff(times) != 0)])
            totals = np.add.reduceat(rows, edge, axis=0)
            at_cells, at_times = cells[edge], times[edge]
            first = 0
            while first < len(edge):
                here = at_cells[first]
                if cell is not None and (here, at_times[first]) == (cell, at):
                    open_ = open_ + totals[first]
                    first += 1
                    continue
                if cell is not None:
                    yield close()
                if here != cell:
                    cell, running = here, carried[int(here)].copy()
                # all groups of this cell but the last of the block are complete as well
                stop = first + int(np.searchsorted(at_cells[first:] != here, True))
                if stop - first > 1:
                    block = totals[first : stop - 1]
                    everyone = running + np.cumsum(block[:, 1 + p : 1 + p + width], axis=0)
                    yield cell, at_times[first : stop - 1], block[:, 0], block[:, 1 : 1 + p], everyone, block[:, 1 + p + width :]
                    running = everyone[-1]
                at, open_ = at_times[stop - 1], totals[stop - 1]
                first = stop
    if cell is not None:
        yield close()


def _split(sums: np.ndarray, p: int):
    return sums[:, 0], sums[:, 1 : 1 + p], sums[:, 1 + p :]


class RiskSets:
    """Rows (t, e, z0, z1, ...) prepared for repeated passes at changing coefficients."""

    def __init__(self, rows: DataFrame, rows_per_cell: int = ROWS_PER_CELL, max_cells: int = MAX_CELLS):
        self.p = len(rows.columns) - 2
        self.width = 1 + self.p + self.p * (self.p + 1) // 2
        n = rows.count()
        # no more cells than give a bounded number of sums
        most = max(16, min(max_cells, _CELL_NUMBERS // self.width))
        sample = rows.where(F.rand(0) < min(1.0, _SAMPLE * most / max(n, 1))).select("t")
        seen = sample.groupBy("t").count().limit(most + 1).collect()
        if len(seen) <= most:
            points = [row["t"] for row in seen]  # few durations: a cell for each that the sample holds
        else:
            cells = min(most, math.ceil(n / rows_per_cell))
            parts = [float(i / cells) for i in range(1, cells)]
            found = sample.agg(F.percentile_approx("t", parts, 10 * cells)).first()[0] if parts else []
            points = found or []
        edges = _edges(_apart(points))
        # with no cut there is one cell; Bucketizer asks for two
        placed = (
            Bucketizer(splits=edges, inputCol="t", outputCol="cell").transform(rows)
            if len(edges) > 2
            else rows.withColumn("cell", F.lit(0.0))
        )
        self.rows = materialize(placed.withColumn("cell", F.col("cell").cast("int")).select("cell", *rows.columns))
        mixed = self.rows.where(F.col("cell") % 2 == 0)
        used = [row[0] for row in mixed.select("cell").distinct().collect()]
        self.walked = None
        if used:
            order = mixed.repartition(len(used), "cell").sortWithinPartitions("cell", F.desc("t"))
            self.walked = order.persist(StorageLevel.DISK_ONLY)  # ordered once, read by every pass

    def release(self) -> None:
        if self.walked is not None:
            self.walked.unpersist()

    def _by_cell(self, beta: np.ndarray) -> dict[str, np.ndarray]:
        """Per cell, ascending: events, their covariates, and sums of everyone and of the dying."""
        p = self.p
        eta = F.lit(0.0)
        for j in range(p):
            eta = eta + F.lit(float(beta[j])) * F.col(f"z{j}")
        names = ["s0", *[f"a{j}" for j in range(p)], *[f"b{j}_{k}" for j in range(p) for k in range(j, p)]]
        terms = [
            F.col("r"),
            *[F.col("r") * F.col(f"z{j}") for j in range(p)],
            *[F.col("r") * F.col(f"z{j}") * F.col(f"z{k}") for j in range(p) for k in range(j, p)],
        ]
        found = (
            self.rows.withColumn("r", F.exp(eta))
            .groupBy("cell", "e")
            .agg(
                F.count("*").alias("n"),
                F.min("t").alias("t"),
                *[F.sum(f"z{j}").alias(f"z{j}") for j in range(p)],
                *[F.sum(c).alias(n) for n, c in zip(names, terms)],
            )
            .toPandas()
        )
        cells = np.sort(found["cell"].unique())
        at = np.searchsorted(cells, found["cell"].to_numpy())
        died = found["e"].to_numpy() == 1

        def fill(columns: list[str], which: np.ndarray) -> np.ndarray:
            out = np.zeros((len(cells), len(columns)))
            np.add.at(out, at[which], found.loc[which, columns].to_numpy(dtype=float))
            return out

        everyone = np.ones(len(found), dtype=bool)
        t = np.full(len(cells), np.inf)
        np.minimum.at(t, at, found["t"].to_numpy(dtype=float))
        every = fill(names, everyone)
        reach = np.cumsum(every[::-1], axis=0)[::-1]
        return {
            "cell": cells,
            "t": t,
            "d": fill(["n"], died)[:, 0],
            "z": fill([f"z{j}" for j in range(p)], died),
            "own": fill(names, died),
            "reach": reach,  # this cell and all longer ones
            "after": np.vstack((reach[1:], np.zeros((1, reach.shape[1])))),
        }

    def likelihood(self, beta: np.ndarray):
        """Efron log partial likelihood, gradient, information, and the sums by cell."""
        p, sums = self.p, self._by_cell(beta)
        single = (sums["cell"] % 2 == 1) & (sums["d"] > 0)
        loglik, gradient, packed = _efron_terms(
            sums["d"][single],
            sums["z"][single],
            _split(sums["reach"][single], p),
            _split(sums["own"][single], p),
            beta,
        ) if single.any() else (0.0, np.zeros(p), np.zeros(p * (p + 1) // 2))
        if self.walked is not None:
            carried = self._carried(sums)

            def walk(frames):
                out = np.zeros(self_width)
                for _, _, d, z, everyone, own in _groups(frames, beta, carried.value):
                    some = d > 0
                    if some.any():
                        part = _efron_terms(d[some], z[some], _split(everyone[some], p), _split(own[some], p), beta)
                        out += np.concatenate(([part[0]], part[1], part[2]))
                yield pd.DataFrame({"sums": [out]})

            self_width = self.width
            found = self.walked.mapInPandas(walk, "sums array<double>").select(F.posexplode("sums"))
            total = np.zeros(self.width)
            for row in found.groupBy("pos").agg(F.sum("col").alias("v")).collect():
                total[row["pos"]] = row["v"]
            loglik, gradient, packed = loglik + total[0], gradient + total[1 : 1 + p], packed + total[1 + p :]
            carried.unpersist()
        return loglik, gradient, _square(packed, p), sums

    def _carried(self, sums):
        table = {int(c): a for c, a in zip(sums["cell"], sums["after"]) if c % 2 == 0}
        return self.rows.sparkSession.sparkContext.broadcast(table)

    def baseline(self, beta: np.ndarray, sums) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
        """Breslow's hazard: (durations, steps) of the cells of one duration, and, where
        others exist, a written table (t, step) of every duration with events."""
        single = (sums["cell"] % 2 == 1) & (sums["d"] > 0)
        times, steps = sums["t"][single], sums["d"][single] / sums["reach"][single][:, 0]
        if self.walked is None:
            return times, steps, None
        carried = self._carried(sums)

        def walk(frames):
            for _, t, d, _, everyone, _ in _groups(frames, beta, carried.value):
                some = d > 0
                yield pd.DataFrame({"t": t[some], "step": d[some] / everyone[some][:, 0]})

        schema = "t double, step double"
        known = self.rows.sparkSession.createDataFrame(
            [(float(t), float(s)) for t, s in zip(times, steps)], schema
        )
        table = materialize(self.walked.mapInPandas(walk, schema).unionByName(known))
        carried.unpersist()
        return times, steps, table
