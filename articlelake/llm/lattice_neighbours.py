"""Near-duplicate vectors by lattice hashing: random projections, E8 cells, several tables.

A table projects each unit vector to eight dimensions, twice, scales and shifts it, and takes the
two nearest points of the lattice E8 as its cell.  Each vector also probes the next nearest cells.  Vectors that
meet in a cell are compared by their exact cosine.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import bound_batches, connected_components
from articlelake.session import settle

TABLES = 8
PROBES = 4  # further cells that a vector looks into
SCALE = 0.5  # cells per unit of the projection
SIMILAR = 0.9
GROUP = 8192  # visits of small cells that one call compares
BLOCK = 2048  # vectors that one task compares with as many others
SEED = 20
_DIMS = 8
HALVES = 2  # lattice points that name a cell


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The nearest point of E8, doubled to whole numbers, for each row of ``points``.

    E8 is D8, the whole-number points of even sum, and D8 moved by one half
    everywhere; the nearest point of D8 is found by rounding and, if the sum is
    odd, rounding the worst coordinate the other way.
    """
    best, far = None, None
    for shift in (0.0, 0.5):
        moved = points - shift
        near = np.rint(moved)
        off = moved - near
        odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        point = near + shift
        distance = ((points - point) ** 2).sum(axis=1)
        if best is None:
            best, far = point, distance
        else:
            closer = distance < far
            best[closer] = point[closer]
    return np.rint(2 * best).astype(np.int64)


def _roots() -> np.ndarray:
    """The 240 shortest steps from a point of E8 to another, doubled."""
    steps = []
    for i in range(_DIMS):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    step = np.zeros(_DIMS, np.int64)
                    step[i], step[j] = a, b
                    steps.append(step)
    for bits in range(1 << _DIMS):
        signs = np.array([1 if bits >> k & 1 else -1 for k in range(_DIMS)])
        if (signs < 0).sum() % 2 == 0:
            steps.append(signs)
    return np.array(steps)


_ROOTS = _roots()
_MIX = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1 for k in range(1, _DIMS + 1)], np.uint64)


def _cell(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit name of each lattice point in this table."""
    mixed = (points.astype(np.uint64) * _MIX).sum(axis=-1, dtype=np.uint64) + np.uint64(table * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Names of the cells of each row of ``unit``: ``(rows, tables, 1 + probes)``, its own cell first.

    A cell is a pair of lattice points, from two projections; a probe takes the
    step that comes nearest, over both of them.
    """
    out = np.zeros((len(unit), tables, 1 + probes), np.int64)
    lengths = 0.5 * (_ROOTS ** 2).sum(axis=1)
    for table in range(tables):
        own, names, gains = [], [], []
        for half in range(HALVES):
            random = np.random.default_rng([SEED, table, half, unit.shape[1]])
            project = random.standard_normal((unit.shape[1], _DIMS))
            projected = (unit @ project) * SCALE + random.random(_DIMS)
            own.append(nearest_e8(projected))
            names.append(_cell(own[half], HALVES * table + half))
            gains.append((2 * projected - own[half]) @ _ROOTS.T - lengths)
        whole = sum(name.view(np.uint64) for name in names)
        out[:, table, 0] = whole.view(np.int64)
        if probes:
            gain = np.concatenate(gains, axis=1)
            ahead = np.argpartition(-gain, probes, axis=1)[:, :probes]
            for k in range(probes):
                half, step = np.divmod(ahead[:, k], len(_ROOTS))
                for h in range(HALVES):
                    at = np.flatnonzero(half == h)
                    moved = _cell(own[h][at] + _ROOTS[step[at]], HALVES * table + h).view(np.uint64)
                    out[at, table, 1 + k] = (whole[at] - names[h][at].view(np.uint64) + moved).view(np.int64)
    return out


def _usable(value: list | None) -> bool:
    return value is not None and len(value) > 0 and None not in value


def _hashed(vectors: DataFrame, tables: int, probes: int) -> DataFrame:
    """``cls, unit, own, seen``: one row for each distinct vector that has a direction."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[int, list] = {}
            for at, value in enumerate(batch.column(1).to_pylist()):
                if _usable(value):
                    vector = np.array(value, np.float64)
                    with np.errstate(over="ignore", invalid="ignore"):
                        top = np.abs(vector).max()
                        vector = vector / top if np.isfinite(top) and top > 0 else vector * np.nan
                        vector = vector / np.sqrt((vector ** 2).sum())
                    if np.isfinite(vector).all():
                        rows.setdefault(len(vector), []).append((at, vector))
            for found in rows.values():
                unit = np.stack([vector for _, vector in found])
                named = cells(unit, tables, probes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([at for at, _ in found])),
                     pa.array([v.tobytes() for v in unit], pa.binary()),
                     pa.array([c.tobytes() for c in named], pa.binary())], ["cls", "unit", "cells"])

    return vectors.mapInArrow(run, "cls long, unit binary, cells binary")


def _visits(hashed: DataFrame) -> DataFrame:
    """One row for each vector and cell that it is in or looks into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [np.frombuffer(value.as_py(), np.int64) for value in batch.column(1)]
            if not named:
                continue
            flat = np.concatenate(named)
            at = np.repeat(np.arange(len(named)), [len(c) for c in named])
            own = np.concatenate([np.arange(len(c)) % (1 + PROBES) == 0 for c in named])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(flat, pa.int64()), pa.array(own)], ["cls", "cell", "own"])

    return hashed.select("cls", "cells").mapInArrow(run, "cls long, cell long, own boolean")


def _compare(table: pa.Table) -> pa.Table:
    """The cells of one group, each compared by itself; rows as of ``_compare_cell``."""
    cell = table["cell"].to_numpy()
    cls, weight, block, own = (table[name].to_numpy() for name in ("cls", "weight", "block", "own"))
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    named = np.stack([np.frombuffer(value.as_py(), np.int64) for value in table["cells"]]).reshape(len(cls), -1, 1 + PROBES)
    units = [np.frombuffer(value.as_py(), np.float64) for value in table["unit"]]
    order = np.lexsort((cls, cell))
    cuts = np.flatnonzero(np.diff(cell[order])) + 1
    made = []
    for rows in np.split(order, cuts):
        if len(rows) > 1:
            for size in {len(units[row]) for row in rows}:
                alike = rows[[len(units[row]) == size for row in rows]]
                if len(alike) > 1:
                    made.append(_compare_cell(
                        cell[alike[0]], cls[alike], weight[alike], block[alike], own[alike], named[alike],
                        np.stack([units[row] for row in alike]), first, second))
    found = [np.concatenate(column) for column in zip(*made, strict=True)] if made else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("cls", "links", "near"), found, strict=True)))


def _compare_cell(cell, cls, weight, block, own, named, units, first, second) -> tuple[np.ndarray, ...]:
    """Exact comparison of two blocks of a cell, rows in the order of ids; each pair counts in the
    first cell where it meets.

    Gives, for each vector with links here, the weight of the vectors that it links with, and the
    smallest member of what is connected here.
    """
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    links, label = np.zeros(len(cls), np.int64), np.arange(len(cls))
    x, y = [], []
    for start in range(0, len(left), 512):
        part = left[start:start + 512]
        a, b = np.nonzero(units[part] @ units[right].T >= SIMILAR)
        x.append(part[a])
        y.append(right[b])
    x, y = np.concatenate([*x, left[:0]]), np.concatenate([*y, left[:0]])
    keep = own[x] | own[y]
    if first == second:
        keep &= x < y
    x, y = np.minimum(x[keep], y[keep]), np.maximum(x[keep], y[keep])  # one order of a pair in every cell
    fresh = np.zeros(len(x), bool)
    for start in range(0, len(x), 50_000):
        p, q = named[x[start:start + 50_000]], named[y[start:start + 50_000]]
        forth = p[:, :, :1] == q  # the own cell of one against any cell of the other
        met = (forth | (p == q[:, :, :1])).reshape(len(p), -1)
        name = np.where(forth, q, p).reshape(len(p), -1)
        fresh[start:start + 50_000] = name[np.arange(len(p)), met.argmax(axis=1)] == cell
    x, y = x[fresh], y[fresh]
    np.add.at(links, x, weight[y])
    np.add.at(links, y, weight[x])
    while len(x):
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        if (label == before).all():
            break
    linked = np.flatnonzero(links)
    return cls[linked], links[linked], cls[label[linked]]


def near_duplicates(vectors: DataFrame, tables: int = TABLES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors`` (``vec_id, embedding``).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing.  Equal vectors are one class whose members are linked
    without being compared.  A row without id has no component, is not kept and
    links with nothing; rows that repeat an id are members like any other.
    """
    bound_batches(vectors.sparkSession)
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    known = given.where("vec_id is not null and embedding is not null and size(embedding) > 0")
    classes = settle(known.groupBy("embedding").agg(F.min("vec_id").alias("cls"), F.count("*").alias("weight")))
    # an id that stands for two vectors names the first of them only
    hashed = settle(_hashed(classes.select("cls", "embedding"), tables, PROBES).join(classes.select("cls", "weight"), "cls"))
    visits = settle(_visits(hashed).groupBy("cell", "cls").agg(F.max("own").alias("own")))
    used = visits.groupBy("cell").agg(F.count("*").alias("n"), F.max("own").alias("any")).where("n > 1 and any")
    used = used.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = settle(visits.join(used.select("cell", "blocks"), "cell"))
    groups = max(1, -(-placed.count() // GROUP))
    # small cells share a group; a cell of several blocks has a group for each two of them
    met = (
        placed.withColumn("block", F.pmod(F.xxhash64("cls", "cell"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.when(F.col("blocks") > 1, F.col("cell")).otherwise(F.pmod("cell", F.lit(groups))).alias("group"),
                "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "own", "cls")
    )
    compared = settle(
        met.join(hashed, "cls").groupBy("group", "i", "j").applyInArrow(_compare, "cls long, links long, near long"))
    counts = compared.groupBy("cls").agg(F.sum("links").alias("links"))
    components = connected_components(compared.select(F.col("cls").alias("a"), F.col("near").alias("b")))
    usable = hashed.select("cls", F.lit(True).alias("usable"))
    named = settle(
        classes.join(usable, "cls", "left").join(counts, "cls", "left")
        .join(components.withColumnRenamed("node", "cls"), "cls", "left")
        .where("usable")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "cls").alias("component_id")))
    out = given.join(named, "embedding", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
