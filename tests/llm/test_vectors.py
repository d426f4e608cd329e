import math

import numpy as np
import pytest

from articlelake.llm import lattice_neighbours, pivot_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(120)]
    for i in range(0, 60, 3):  # near ones, at several angles
        for k, noise in enumerate((0.02, 0.1, 0.4)):
            rows.append((200 + 3 * i + k, (np.array(rows[i][1]) + noise * rng.standard_normal(16)).tolist()))
    base = rows[0][1]
    rows += [(500 + i, (np.array(base) * (1 + i) + 0.01 * rng.standard_normal(16)).tolist()) for i in range(40)]  # a hot group
    rows += [(600, base), (601, base), (602, base), (603, [0.0] * 16), (604, None), (605, []), (606, [float("nan")] + [1.0] * 15),
             (607, [float("inf")] + [1.0] * 15), (608, [None] + [1.0] * 15), (609, [1.0, 2.0]), (610, [1.0, 2.0]),
             (None, base), (611, [1e-30] * 16), (612, [1e30] * 16), (650, [1e6] * 16), (651, [3e14] * 16),
             (652, [-1e6] * 15 + [1.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def unit(value):
    if not value or None in value:
        return None
    v = np.array(np.array(value, np.float32), np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / np.sqrt((v ** 2).sum())


def links_of(rows):
    units = [(i, unit(v)) for i, v in rows if i is not None]
    links = {i: set() for i, _ in units}
    for a, x in units:
        for b, y in units:
            if a < b and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.9:
                links[a].add(b)
                links[b].add(a)
    return links


@pytest.mark.parametrize("block", [2048, 8])
def test_near_duplicates(spark, monkeypatch, block):
    """No wrong link; nearly all true ones; the same where cells are cut into blocks."""
    monkeypatch.setattr(lattice_neighbours, "BLOCK", block)
    rows = vectors()
    links = links_of(rows)
    found = {r.vec_id: r for r in lattice_neighbours.near_duplicates(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    want, got = sum(map(len, links.values())), sum(r.n_links for r in found.values())
    assert 0.9 * want <= got <= want
    for i, linked in links.items():
        assert found[i].n_links <= len(linked)
        assert found[i].kept == (found[i].component_id == i)
        if not linked:
            assert found[i].component_id == i and found[i].n_links == 0
    assert {found[i].component_id for i in (600, 601, 602)} == {0}
    assert found[None].component_id is None and not found[None].kept and found[None].n_links == 0


def test_near_duplicates_of_no_rows(spark):
    assert lattice_neighbours.near_duplicates(frame(spark, [])).count() == 0
    assert lattice_neighbours.near_duplicates(frame(spark, [(1, None), (2, [])])).count() == 2


def test_nearest_lattice_point():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((300, 8)) * 2
    near = lattice_neighbours.nearest_e8(points)
    assert ((near % 2 == 0).all(axis=1) | (near % 2 == 1).all(axis=1)).all()
    assert (near.sum(axis=1) % 4 == 0).all()
    far = ((2 * points - near) ** 2).sum(axis=1)
    for step in lattice_neighbours._ROOTS:  # no neighbour is nearer
        assert (far <= ((2 * points - near - step) ** 2).sum(axis=1) + 1e-9).all()
    assert len(lattice_neighbours._ROOTS) == 240 and far.max() <= 4 + 1e-9


def best(rows, k):
    whole = sorted({(i, tuple(math.floor(256 * np.float64(np.float32(x))) for x in v)) for i, v in rows
                    if i is not None and v and None not in v and np.isfinite(np.array(v, np.float32)).all()
                    and (np.abs(np.array(v, np.float32).astype(np.float64)) * 256 < 2.0 ** 63).all()})
    out = []
    for i, q in whole:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, rank + 1, j, -score if -2 ** 63 <= -score < 2 ** 63 else None, -score)
                    for rank, (score, j) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize(("step", "block"), [(256, 16_384), (3, 40)])
def test_top_k_is_exact(spark, monkeypatch, step, block):
    monkeypatch.setattr(pivot_search, "STEP", step)
    monkeypatch.setattr(pivot_search, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 3)
    rows = vectors() + [(700 + i, vectors()[50][1]) for i in range(8)]  # ties
    given = pivot_search.whole_numbers(frame(spark, rows))
    for k in (5, 1000):
        found = pivot_search.top_k(given, given.where("vec_id % 50 = 0"), k)
        got = sorted((r.query_id, r.rank, r.vec_id, r.score, int(r.score_exact)) for r in found.collect())
        assert got == sorted(best(rows, k), key=lambda row: row[:3])


def test_top_k_of_no_rows(spark):
    given = pivot_search.whole_numbers(frame(spark, []))
    assert pivot_search.top_k(given, given).count() == 0
