"""Exact order statistics by refining counts: bounded state on unbounded domains.

A double's bits, with the sign folded in, order like the doubles themselves.
A round counts the values of each wanted bracket by the next ``STEP`` bits (tasks
read the doubles' bits as they are and add up at most 2**STEP counters per bracket, an
aggregate adds those of the tasks), and the driver follows the wanted rank into one of them.  After 64 / ``STEP``
rounds a bracket is a single value.  Several columns and ranks share the rounds.
"""

from __future__ import annotations

import math
import struct
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed copy

STEP = 16


def _sortable(x: Column) -> Column:
    """Sign, exponent and mantissa of a finite double as one long that orders like it."""
    size = F.abs(x)
    # the exponent by logarithm, put right by one where rounding misled it
    guess = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(5e-324)))), F.lit(-1022)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), F.greatest(e, F.lit(-1022)).cast("double"))
    e = F.when(size < power(guess), guess - 1).when((guess < 1023) & (size >= power(F.least(guess + 1, F.lit(1023)))), guess + 1).otherwise(guess)
    e = F.greatest(e, F.lit(-1022))
    normal = size >= 2.0 ** -1022
    fraction = size / power(e)  # in [1, 2) for normal numbers, exact
    mantissa = F.when(normal, ((fraction - 1) * (2.0 ** 52)).cast("long")).otherwise((size * (2.0 ** 537) * (2.0 ** 537)).cast("long"))
    bits = F.when(normal, (e + 1023).cast("long") * (1 << 52) + mantissa).otherwise(mantissa)
    return F.when(x < 0, -bits).otherwise(bits)


def to_double(bits: int) -> float:
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(bits)))[0], bits) if bits else 0.0


def counted(values: DataFrame, brackets: Sequence[tuple[int, int]], done: int) -> DataFrame:
    """Per task the values of the brackets (column, leading ``done`` bits), NULL and NaN left out, by their next ``STEP`` bits."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        counts = np.zeros((len(brackets), 1 << STEP), np.int64)
        for b in batches:
            keys = {}
            for i in {i for i, _ in brackets}:
                x = b.column(i).to_numpy(zero_copy_only=False)
                x = x[~np.isnan(x)] + 0.0  # one zero
                size = np.abs(x).view(np.int64)
                keys[i] = np.where(x < 0, -size, size).view(np.uint64) ^ np.uint64(1 << 63)
            for k, (i, lead) in enumerate(brackets):
                own = keys[i]
                if done:
                    own = own[own >> np.uint64(64 - done) == np.uint64(lead)]
                digit = own >> np.uint64(64 - done - STEP) & np.uint64((1 << STEP) - 1)
                counts[k] += np.bincount(digit.astype(np.int64), minlength=1 << STEP)
        for (i, lead), own in zip(brackets, counts):
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(some), pa.int32()), pa.array([str(lead)] * len(some), pa.string()), pa.array(some, pa.int32()),
                                              pa.array(own[some], pa.int64())], names=["c", "lead", "digit", "n"])

    return values.mapInArrow(run, "c int, lead string, digit int, n long")


def order_statistics(df: DataFrame, ranks: dict[str, Sequence[int]]) -> dict[str, dict[int, float]]:
    """The values at the given ranks (from 0) of the numeric columns, NULL and NaN left out.

    Infinite values aren't supported.
    """
    names = list(ranks)
    values = df.select(*[F.col(n).cast("double").alias(f"x{i}") for i, n in enumerate(names)])
    # a key read as an unsigned number orders like x; its leading bits are found by unsigned shifts
    wanted = {(i, r): (0, r) for i, n in enumerate(names) for r in ranks[n]}  # (leading bits, rank among the values that have them)
    for done in range(0, 64, STEP):
        brackets = sorted({(i, lead) for (i, _), (lead, _) in wanted.items()})
        counts: dict = {}
        for r in counted(values, brackets, done).groupBy("c", "lead", "digit").agg(F.sum("n").alias("n")).collect():
            counts.setdefault((r.c, int(r.lead)), {})[r.digit] = r.n
        for key, (b, rank) in wanted.items():
            for d, n in sorted(counts.get((key[0], b), {}).items()):
                if rank < n:
                    break
                rank -= n
            else:
                raise ValueError(f"rank {key[1]} is beyond the values of {names[key[0]]}")
            wanted[key] = ((b << STEP) | d, rank)
    out: dict[str, dict[int, float]] = {n: {} for n in names}
    for (i, r), (b, _) in wanted.items():
        out[names[i]][r] = to_double(b - (1 << 63))
    return out


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float] | None:
    """Quantiles with linear interpolation between neighbouring values, as ``percentile`` gives them; None without values."""
    n = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return None
    at = [(n - 1) * p for p in probabilities]
    values = order_statistics(df, {column: sorted({r for a in at for r in (math.floor(a), math.ceil(a))})})[column]
    return [values[math.floor(a)] + (a - math.floor(a)) * (values[math.ceil(a)] - values[math.floor(a)]) for a in at]
