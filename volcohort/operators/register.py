"""A label laid onto a scan whose axes it may have mirrored: eight flips, the shift of each by cross-correlation, the best by bone."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volcohort.operators.density import BONE
from volcohort.operators.resample import resampled
from volcohort.operators.storage import dealt, staged
from volcohort.operators.voxel import AT

# The stride of the coarse grid, the fewest voxels of a label that lies well.
STRIDE, LEAST = 4, 5000
#: Places of the coarse grids that are worked on in one step, and of those whose voxels one call gets, about.
CELLS = 1 << 18
FLIPS = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]


def _flipped(affine: Column, sizes: list[str], flips: tuple[int, int, int]) -> Column:
    """The affine of a volume whose array axes i, j, k are turned round, so that each voxel keeps its place in the array."""
    at = lambda r, c: F.get(affine, F.lit(4 * r + c))
    out = []
    for r in range(3):
        out += [-at(r, c) if flips[c] else at(r, c) for c in range(3)]
        out.append(at(r, 3) + sum((at(r, c) * (F.col(sizes[c]) - 1) for c in range(3) if flips[c]), F.lit(0.0)))
    return F.array(*out, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])


def _coarse(voxels: DataFrame, stride: int, *more: str) -> DataFrame:
    on = [F.col(c) % stride == 0 for c in "kji"]
    return voxels.where(on[0] & on[1] & on[2]).select("case_id", *[(F.col(c) / stride).cast("int").alias(c) for c in "kji"], *more)


def shifts(fixed: DataFrame, moving: DataFrame, shape: DataFrame) -> DataFrame:
    """(case_id, flip, di, dj, dk): the shift at which most voxels of `moving` (case_id, flip, k, j, i) meet voxels of `fixed` (case_id,
    k, j, i), both on a coarse grid whose ends meet; the first of equal ones in the order of i, j, k. shape: (case_id, ni, nj, nk). A
    call gets the voxels of the cases that fall to it and holds coarse grids of CELLS places, or one; shifts of more than half the grid
    count as shifts back."""
    case, names = moving.schema["case_id"].dataType.simpleString(), ["case_id", "flip", "di", "dj", "dk"]
    cells = shape.agg(F.sum(F.col("ni").cast("long") * F.col("nj") * F.col("nk")).alias("n")).first()["n"] or 0
    calls = max(shape.sparkSession.sparkContext.defaultParallelism, -(-cells // CELLS))

    def some(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame([], columns=names)]
        for n, rows in (b.groupby(["ni", "nj", "nk"]).indices if len(b) else {}).items():
            part, size = b.iloc[rows], int(np.prod(n))
            pair = part.groupby(["case_id", "flip"]).ngroup().to_numpy()
            own = part[["case_id", "flip"]].drop_duplicates().sort_values(["case_id", "flip"], ignore_index=True)
            cases, of = np.unique(own["case_id"], return_inverse=True)
            at = pd.Index(cases).get_indexer(a["case_id"])
            for p in range(0, len(own), max(1, CELLS // size)):
                q = min(len(own), p + max(1, CELLS // size))
                grids = []
                for d, held, lo, hi in ((a, at, of[p], of[q - 1] + 1), (part, pair, p, q)):
                    d, held = d[(held >= lo) & (held < hi)], held[(held >= lo) & (held < hi)] - lo
                    g = np.zeros((hi - lo, *n))
                    g[(held, *(d[c].to_numpy(int) for c in "ijk"))] = 1
                    grids.append(np.fft.rfftn(g, axes=(1, 2, 3)))
                met = np.rint(np.fft.irfftn(grids[0][of[p:q] - of[p]] * np.conj(grids[1]), s=n, axes=(1, 2, 3)))  # counts, so whole numbers
                best = np.column_stack(np.unravel_index(met.reshape(q - p, -1).argmax(axis=1), n))
                best = np.where(best > np.array(n) // 2, best - n, best)
                out.append(own[p:q].assign(di=best[:, 0], dj=best[:, 1], dk=best[:, 2]))
        return pd.concat(out[1:] or out)

    own = moving.join(shape.hint("merge"), "case_id")
    both = [dealt(d.withColumn("_call", F.pmod(F.hash("case_id"), F.lit(calls))), "_call").groupBy("_call") for d in (fixed, own)]
    return both[0].cogroup(both[1]).applyInPandas(some, f"case_id {case}, flip int, di int, dj int, dk int")


def _blocks(places: DataFrame, *keys: str, **bits: Column) -> DataFrame:
    """Places by blocks of 64 along i: (keys, k, j, b) and, for each condition, a number whose bits are the places where it holds."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i").bitwiseAND(63))
    return places.groupBy(*keys, "k", "j", F.shiftright("i", 6).alias("b")).agg(*[F.bit_or(F.when(on, bit).otherwise(F.lit(0).cast("long"))).alias(c) for c, on in bits.items()])


def laid(moving: DataFrame, source: DataFrame, hu: DataFrame, target: DataFrame, least: int = LEAST, stride: int = STRIDE, bone: int = BONE) -> tuple[DataFrame, DataFrame]:
    """(voxels, found): `moving` (case_id, k, j, i, label) on the grid of the scan hu (case_id, k, j, i, hu) under the flip whose voxels,
    shifted, hold most bone in per cent; of equal ones the first. found: (case_id, flip, di, dj, dk, voxels, percent), flip a number
    of three bits for i, j, k, the shift in voxels. Flips that leave fewer than `least` voxels don't count; cases without any are
    left out. source, target: (case_id, affine, ni, nj, nk)."""
    kinds = F.array(*[F.struct(F.lit(n).alias("flip"), _flipped(F.col("affine"), ["ni", "nj", "nk"], f).alias("affine")) for n, f in enumerate(FLIPS)])
    each = lambda g: F.struct("case_id", g).alias("case_id")
    turned = source.select("case_id", F.explode(kinds).alias("f")).select(each(F.col("f.flip").alias("flip")), "f.affine")
    numbers = F.explode(F.array(*[F.lit(n) for n in range(len(FLIPS))])).alias("flip")
    here = target.select("case_id", "affine", "ni", "nj", "nk", numbers).select(each(F.col("flip")), "affine", "ni", "nj", "nk")
    held = moving.where("label <> 0").select("case_id", "k", "j", "i", "label", numbers).select(each(F.col("flip")), "k", "j", "i", "label")
    placed = resampled(held, turned, here).select(F.col("case_id.case_id").alias("case_id"), F.col("case_id.flip").alias("flip"), "k", "j", "i", "label")
    placed = staged(placed, "register-placed")
    size = lambda c: F.ceil(F.col(c) / stride).cast("int").alias(c)
    # The scan is read several times, so it is written, as the few blocks of bits that its lines are.
    scan = staged(_blocks(hu, "case_id", _in=F.lit(True), _bone=F.col("hu") > bone), "register-scan")
    coarse = _coarse(placed, stride, "flip")
    enough = coarse.groupBy("case_id", "flip").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least // stride**3).select("case_id", "flip")
    lit = scan.where((F.col("k") % stride == 0) & (F.col("j") % stride == 0) & (F.col("_bone") != 0))
    lit = lit.select("case_id", "k", "j", F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda n: F.getbit("_bone", n) == 1)).alias("_n"), "b")
    fixed = _coarse(lit.select("case_id", "k", "j", (F.col("b") * 64 + F.col("_n")).alias("i")), stride)
    moves = shifts(fixed, coarse.join(enough.hint("merge"), ["case_id", "flip"], "left_semi"), target.select("case_id", size("ni"), size("nj"), size("nk")))
    moves = moves.select("case_id", "flip", *[(F.col(f"d{c}") * stride).alias(f"d{c}") for c in "ijk"])
    moves = staged(moves, "register-shifts")
    moved = placed.join(moves, ["case_id", "flip"]).select("case_id", "flip", *[(F.col(c) + F.col(f"d{c}")).alias(c) for c in "kji"], "label")
    met = _blocks(moved, "case_id", "flip", _own=F.lit(True)).hint("merge").join(scan, ["case_id", "k", "j", "b"])
    count = lambda c: F.sum(F.bit_count(F.col("_own").bitwiseAND(F.col(c))))
    scored = met.groupBy("case_id", "flip").agg(count("_in").alias("voxels"), count("_bone").alias("_n")).where((F.col("voxels") >= least) & (F.col("_n") > 0))
    scored = scored.withColumn("percent", 100 * F.col("_n") / F.col("voxels")).hint("merge").join(moves, ["case_id", "flip"])
    best = scored.groupBy("case_id").agg(F.max_by(F.struct("flip", "di", "dj", "dk", "voxels", "percent"), F.struct("percent", -F.col("flip"))).alias("b"))
    found = staged(best.select("case_id", "b.*"), "register-found")
    kept = moved.join(found.select("case_id", "flip"), ["case_id", "flip"], "left_semi").withColumn("b", F.shiftright("i", 6)).hint("merge")
    inside = kept.join(scan.drop("_bone"), ["case_id", "k", "j", "b"]).where(F.getbit("_in", F.col("i").bitwiseAND(63)) == 1)
    return inside.select(*AT, "label"), found
