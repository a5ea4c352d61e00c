"""Labelled volumes as rows: voxels (case, k, j, i, label) for crops, runs along i for whole volumes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from volcohort.operators.storage import forget, staged

AT = ["case_id", "k", "j", "i"]


def runs(voxels: DataFrame) -> DataFrame:
    """(case_id, k, j, i0, i1, label): runs of equal labels along i, background (0) left out."""
    w = Window.partitionBy("case_id", "k", "j", "label").orderBy("i")
    g = voxels.where("label <> 0").withColumn("_g", F.col("i") - F.row_number().over(w))
    return g.groupBy("case_id", "k", "j", "label", "_g").agg(F.min("i").alias("i0"), F.max("i").alias("i1")).drop("_g")


def volumes(r: DataFrame) -> DataFrame:
    return r.groupBy("case_id", "label").agg(F.sum(F.col("i1") - F.col("i0") + 1).alias("voxels"))


def _dice(both: DataFrame, a: DataFrame, b: DataFrame, empty: float | None) -> DataFrame:
    sizes = a.withColumnRenamed("voxels", "na").join(b.withColumnRenamed("voxels", "nb"), ["case_id", "label"], "full_outer")
    out = sizes.join(both, ["case_id", "label"], "left").fillna(0, ["na", "nb", "both"])
    total = F.col("na") + F.col("nb")
    return out.select("case_id", "label", "na", "nb", F.when(total > 0, F.round(2 * F.col("both") / total, 9)).otherwise(F.lit(empty)).alias("dice"))


def dice_of_runs(a: DataFrame, b: DataFrame, empty: float | None = 1.0) -> DataFrame:
    """(case_id, label, na, nb, dice): runs meet on (case, k, j, label), so the overlap is an equi-join with a residue."""
    x, y = a, b.select("case_id", "k", "j", "label", F.col("i0").alias("b0"), F.col("i1").alias("b1"))
    cut = F.least("i1", "b1") - F.greatest("i0", "b0") + 1
    both = x.join(y, ["case_id", "k", "j", "label"]).where(cut > 0).groupBy("case_id", "label").agg(F.sum(cut).alias("both"))
    return _dice(both, volumes(a), volumes(b), empty)


def confusion(a: DataFrame, b: DataFrame) -> DataFrame:
    """(case_id, truth, pred, n) over voxels with a truth; a voxel that b lacks is background."""
    x = a.where("label <> 0").select(*AT, F.col("label").alias("truth"))
    y = b.select(*AT, F.col("label").alias("pred"))
    return x.join(y, AT, "left").groupBy("case_id", "truth", F.coalesce("pred", F.lit(0)).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def identified(c: DataFrame) -> DataFrame:
    """(case_id, truth, best, n, offset): the prediction that covers most of each truth; ties go to the smaller label."""
    found = c.where("pred <> 0").groupBy("case_id", "truth").agg(F.max(F.struct(F.col("n"), (-F.col("pred")).alias("p"))).alias("m"))
    return found.select("case_id", "truth", (-F.col("m.p")).alias("best"), "m.n", (-F.col("m.p") - F.col("truth")).alias("offset"))


def changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(case_id, k, j, i, before, after, kind): voxels that differ; kind 1 removed, 2 added, 3 relabelled."""
    x = a.where("label <> 0").select(*AT, F.col("label").alias("before"))
    y = b.where("label <> 0").select(*AT, F.col("label").alias("after"))
    out = x.join(y, AT, "full_outer").fillna(0, ["before", "after"]).where("before <> after")
    return out.withColumn("kind", F.when(F.col("after") == 0, 1).when(F.col("before") == 0, 2).otherwise(3))


def box(df: DataFrame, pad: int = 0, keys: tuple[str, ...] = ("case_id",)) -> DataFrame:
    """(keys, k0, k1, j0, j1, i0, i1): the bounding box of rows with the same keys, grown by pad and cut at zero."""
    ends = [e for c in "kji" for e in (F.greatest(F.lit(0), F.min(c) - pad).alias(f"{c}0"), (F.max(c) + pad).alias(f"{c}1"))]
    return df.groupBy(*keys).agg(*ends)


def beside(*tables: DataFrame) -> DataFrame:
    """Tables (case_id, k, j, i, others) of one row a place, each with other columns, side by side: a full outer join by one aggregate
    of their union, which tables dealt by case go through without a shuffle."""
    more = {f.name: f.dataType for t in tables for f in t.schema.fields if f.name not in AT}
    rows = [t.select(*AT, *[F.col(c) if c in t.columns else F.lit(None).cast(kind).alias(c) for c, kind in more.items()]) for t in tables]
    return reduce(DataFrame.union, rows).groupBy(*AT).agg(*[F.max(c).alias(c) for c in more])


#: What three_way says of a place, in the order of the alphabet.
STATES = ("agree", "conflict", "only_a", "only_b")


def merged_beside(merged: DataFrame, also: tuple[str, ...], *tables: DataFrame) -> DataFrame:
    """`beside` at the places of `merged` (place, label, state, also). The state goes through the aggregate as its number: of numbers
    Spark hashes the greatest, of texts it sorts for them."""
    names = F.array(*[F.lit(x) for x in STATES])
    m = beside(merged.select(*AT, "label", F.array_position(names, F.col("state")).alias("_state"), *also), *tables).where("_state is not null")
    return m.withColumn("state", F.get(names, (F.col("_state") - 1).cast("int"))).drop("_state")


def three_way(base: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(case_id, k, j, i, label, state): agree, only_a, only_b or conflict; a conflict has no label."""
    m = beside(*[d.where("label <> 0").select(*AT, F.col("label").alias(n)) for n, d in (("o", base), ("x", a), ("y", b))]).fillna(0, ["o", "x", "y"])
    state = F.when(F.col("x") == F.col("y"), "agree").when(F.col("y") == F.col("o"), "only_a").when(F.col("x") == F.col("o"), "only_b").otherwise("conflict")
    label = F.when(F.col("x") == F.col("y"), F.col("x")).when(F.col("y") == F.col("o"), F.col("x")).when(F.col("x") == F.col("o"), F.col("y"))
    return m.select(*AT, label.alias("label"), state.alias("state"))


def overlay(under: DataFrame, over: DataFrame, yields: list[int]) -> DataFrame:
    """`over` wins, but its labels in `yields` only where nothing is."""
    x = under.where("label <> 0").select(*AT, F.col("label").alias("u"))
    y = over.where("label <> 0").select(*AT, F.col("label").alias("v"))
    m = x.join(y, AT, "full_outer")
    return m.select(*AT, F.when(F.col("v").isin(yields), F.coalesce("u", "v")).otherwise(F.coalesce("v", "u")).alias("label"))


def remap(voxels: DataFrame, table: dict[int, int], others: Column | None = None) -> DataFrame:
    """Rewrite labels all at once by the table; others stay, or become `others`."""
    lut = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return voxels.withColumn("label", F.coalesce(lut[F.col("label")], F.col("label") if others is None else others))


def _near(reach: list[tuple[int, int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{c}") for c, d in zip("kji", t, strict=True)]) for t in reach]))


ALL_26 = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0)]
FACES = [t for t in ALL_26 if sum(map(abs, t)) == 1]


def _moved(df: DataFrame, reach: list[tuple[int, int, int]], label: str) -> DataFrame:
    out = df.select("case_id", "k", "j", "i", F.col("label").alias(label), _near(reach).alias("d"))
    return out.select("case_id", *[(F.col(c) + F.col(f"d.d{c}")).alias(c) for c in "kji"], label)


def touching(voxels: DataFrame) -> DataFrame:
    """(case_id, a, b, n): voxels of b with a voxel of a < b among the 26 around."""
    v = voxels.where("label <> 0")
    m = _moved(v, ALL_26, "a").distinct()
    t = v.select(*AT, F.col("label").alias("b")).join(m, AT).where("a < b")
    return t.groupBy("case_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def with_neighbours(voxels: DataFrame, reach: list[tuple[int, int, int]]) -> DataFrame:
    """(case_id, k, j, i, label, _own): each labelled voxel at its place, and at those it reaches with `_own` false. One aggregate by
    place then takes what a join of the voxels with their neighbours would, and volumes dealt by case aren't shuffled for it."""
    v = voxels.where("label <> 0").select(*AT, "label", _near([(0, 0, 0), *reach]).alias("d"))
    own = reduce(lambda a, b: a & b, [F.col(f"d.d{c}") == 0 for c in "kji"])
    return v.select("case_id", *[(F.col(c) + F.col(f"d.d{c}")).alias(c) for c in "kji"], "label", own.alias("_own"))


def surface(voxels: DataFrame) -> DataFrame:
    """(case_id, k, j, i, label): voxels of which at least one of six neighbours has another label."""
    near = with_neighbours(voxels, FACES).groupBy(*AT, "label").agg(F.count_if("_own").alias("_o"), F.count(F.lit(1)).alias("_n"))
    return near.where("_o > 0 and _n - _o < 6").drop("_o", "_n")


def run_components(r: DataFrame, reach: list[tuple[int, int, int]] = ALL_26) -> DataFrame:
    """Runs (case_id, k, j, label, i0, i1) with `component`: parts of a label that hang together, named by their least place.

    A run meets those of the lines beside it in an equi-join on the line with a residue. The least name of a neighbourhood
    spreads round by round, with a jump to the name of the named run; each round is written to the shared folder."""
    near: dict[tuple[int, int], list[int]] = {}
    for dk, dj, di in reach:
        if (dk, dj) != (0, 0):
            near.setdefault((dk, dj), []).append(di)
    key = ["case_id", "label"]
    own = staged(r.select(*key, F.struct("k", "j", F.col("i0").alias("i")).alias("node"), "k", "j", "i0", "i1"), "runs")
    cur = own.select(*key, "node", F.col("node").alias("component"))
    if near:
        both = all((-dk, -dj, -di) in reach for dk, dj, di in reach)  # then a link is found from one end
        near = {at: d for at, d in near.items() if at > (0, 0)} if both else near
        steps = F.array(*[F.struct(F.lit(dk).alias("dk"), F.lit(dj).alias("dj"), F.lit(min(d)).alias("lo"), F.lit(max(d)).alias("hi")) for (dk, dj), d in near.items()])
        a = own.select(*key, F.col("node").alias("a"), "k", "j", "i0", "i1", F.explode(steps).alias("d"))
        a = a.select(*key, "a", (F.col("k") + F.col("d.dk")).alias("k"), (F.col("j") + F.col("d.dj")).alias("j"), (F.col("i0") + F.col("d.lo")).alias("a0"), (F.col("i1") + F.col("d.hi")).alias("a1"))
        links = a.join(own, [*key, "k", "j"]).where("a0 <= i1 and i0 <= a1").select(*key, "node", "a")
        if both:
            ends = F.explode(F.array(F.struct("node", "a"), F.struct(F.col("a").alias("node"), F.col("node").alias("a"))))
            links = links.select(*key, ends.alias("_e")).select(*key, "_e.node", "_e.a")
        links = staged(links, "run-links")
        settled, before = False, None
        while not settled:  # the rounds grow with the logarithm of the longest path
            low = links.join(cur.withColumnRenamed("node", "a"), [*key, "a"]).groupBy(*key, "node").agg(F.min("component").alias("low"))
            new = cur.join(low, [*key, "node"], "left").withColumn("low", F.least("component", "low"))
            named = new.select(*key, F.col("node").alias("low"), F.col("low").alias("jump"))
            new = staged(new.join(named, [*key, "low"]).select(*key, "node", "component", F.least("low", "jump").alias("next")), "run-names")
            settled = new.where("next <> component").isEmpty()
            cur = new.select(*key, "node", F.col("next").alias("component"))
            if before is not None:
                forget(before)
            before = new
        forget(links)
    return own.join(cur, [*key, "node"]).select("case_id", "k", "j", "label", "i0", "i1", "component").hint("merge")


def components(voxels: DataFrame, reach: list[tuple[int, int, int]] = ALL_26) -> DataFrame:
    """(case_id, k, j, i, label, component): parts of a label that hang together, named by their least place. The work is done on
    runs, which are the voxels between their ends: named, they are made places again. Places that come twice are in one run."""
    line = ["case_id", "k", "j", "label"]
    v = voxels.where("label <> 0").select(*AT, "label").where(" and ".join(f"{c} is not null" for c in AT))
    if (0, 0, 1) in reach:
        w = Window.partitionBy(*line).orderBy("i")
        v = v.withColumn("_d", F.col("i") - F.lag("i").over(w)).withColumn("_s", F.when(F.col("_d").isNull() | (F.col("_d") > 1), F.col("i")))
        v = v.withColumn("i0", F.last("_s", ignorenulls=True).over(w)).drop("_d", "_s")  # a run's first place names it
    else:
        v = v.withColumn("i0", F.col("i"))
    found = run_components(v.groupBy(*line, "i0").agg(F.max("i").alias("i1")), reach)
    # Written, as it is read several times, and as Spark takes exploded tables for small: it would send all voxels to the driver.
    return staged(found.select("case_id", "k", "j", F.explode(F.sequence("i0", "i1")).alias("i"), "label", "component"), "parts")


def settle_conflicts(merged: DataFrame, a: DataFrame, b: DataFrame, hu: DataFrame, keep: int = 200, drop: int = 100, also: tuple[str, ...] = ()) -> DataFrame:
    """Conflicts between a label and background, decided by density: `keep` or more takes the label, under `drop` the
    background; all others stay open (NULL). also: other columns of `merged` that stay."""
    x, y = a.select(*AT, F.col("label").alias("x")), b.select(*AT, F.col("label").alias("y"))
    m = merged_beside(merged, also, x, y, hu.select(*AT, "hu")).fillna(0, ["x", "y"])
    one = (F.col("state") == "conflict") & ((F.col("x") == 0) != (F.col("y") == 0))
    label = F.when(one & (F.col("hu") >= keep), F.greatest("x", "y")).when(one & (F.col("hu") < drop), 0).otherwise(F.col("label"))
    return m.select(*AT, label.alias("label"), "state", *also)


def component_sizes(parts: DataFrame) -> DataFrame:
    """(case_id, label, component, voxels)."""
    return parts.groupBy("case_id", "label", "component").agg(F.count(F.lit(1)).alias("voxels"))


def largest_share(parts: DataFrame) -> DataFrame:
    """(case_id, label, parts, share): the share of a label's largest component."""
    s = component_sizes(parts).groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("parts"), (F.max("voxels") / F.sum("voxels")).alias("share"))
    return s.select("case_id", "label", "parts", F.round("share", 9).alias("share"))


def without_specks(parts: DataFrame, least: int) -> DataFrame:
    """Voxels of components of at least `least` voxels, and of labels in one piece, however small."""
    sizes = component_sizes(parts)
    several = sizes.groupBy("case_id", "label").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    small = sizes.where(F.col("voxels") < least).join(several, ["case_id", "label"], "left_semi")
    return parts.join(small, ["case_id", "label", "component"], "left_anti").select(*AT, "label")


def majority(parts: DataFrame, labels: DataFrame, purity: float) -> DataFrame:
    """(case_id, component, winner): the label of most voxels of a component, if it has that share; ties go to the smaller."""
    c = parts.select(*AT, "component").join(labels.where("label <> 0").select(*AT, F.col("label").alias("l")), AT)
    n = c.groupBy("case_id", "component", "l").agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy("case_id", "component").agg(F.max(F.struct("n", (-F.col("l")).alias("m"))).alias("b"), F.sum("n").alias("t"))
    return g.where(F.col("b.n") >= purity * F.col("t")).select("case_id", "component", (-F.col("b.m")).alias("winner"))


def box_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(case_id, a, b, share): the part of each box of a that a box of b of the case covers. Boxes: (case_id, id, k0 ... i1)."""
    y = b.select(F.col("case_id").alias("_c"), F.col("id").alias("b"), *[F.col(f"{c}{e}").alias(f"y{c}{e}") for c in "kji" for e in "01"])
    meets = [(F.col(f"{c}0") <= F.col(f"y{c}1")) & (F.col(f"y{c}0") <= F.col(f"{c}1")) for c in "kji"]
    size = [F.col(f"{c}1") - F.col(f"{c}0") + 1 for c in "kji"]
    cut = [F.least(f"{c}1", f"y{c}1") - F.greatest(f"{c}0", f"y{c}0") + 1 for c in "kji"]
    out = a.join(y, (F.col("case_id") == F.col("_c")) & meets[0] & meets[1] & meets[2])
    return out.select("case_id", F.col("id").alias("a"), "b", F.round(cut[0] * cut[1] * cut[2] / (size[0] * size[1] * size[2]), 9).alias("share"))
