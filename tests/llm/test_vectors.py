"""Vector near-duplicates against brute force: planted families, and how far lists are probed."""

import math

import numpy as np
import pyarrow as pa
import pytest

from pagelore.llm import queries, vector_dedup

SIZE, FAMILIES, MEMBERS = 64, 60, 12


def family_rows(seed=3):
    """Families whose members lie around 0.93 from each other, chains, copies and loners."""
    rng = np.random.default_rng(seed)
    rows, vec_id = [], 5000
    for family in range(FAMILIES):
        centre = rng.normal(size=SIZE)
        for i in range(MEMBERS):
            noise = rng.normal(size=SIZE) * (0.1, 0.2, 0.25, 0.3)[i % 4]
            rows.append((vec_id, (centre + noise).tolist(), family % 4))
            vec_id -= 1
    step = rng.normal(size=SIZE)
    chain = rng.normal(size=SIZE)
    for i in range(8):  # each links with its neighbours only
        rows.append((vec_id, (chain + i * 0.25 * step).tolist(), 1))
        vec_id -= 1
    rows += [(vec_id - i, rows[0][1], rows[0][2]) for i in range(5)]
    rows += [(100 + i, rng.normal(size=SIZE).tolist(), i % 4) for i in range(600)]
    return rows


def brute(rows, threshold=0.93):
    """{vec_id: (n_links, component_id, kept)} and the links, pair by pair."""
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    smallest = np.array([r[0] for r in rows])
    while True:  # the smallest id spreads along the links until nothing changes
        around = np.where(near, smallest[None, :], smallest.max()).min(1)
        after = np.minimum(smallest, around)
        if (after == smallest).all():
            break
        smallest = after
    of = {r[0]: (int(n), int(c), r[0] == c) for r, n, c in zip(rows, near.sum(1), smallest)}
    return of, near


def found(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in frame.collect()}


@pytest.fixture(scope="module")
def planted(spark):
    rows = family_rows()
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def as_stored(rows):
    return [(i, np.array(v, dtype=np.float32).astype(float).tolist(), label) for i, v, label in rows]


def test_all_lists_within_reach_give_brute_force(planted):
    rows, table = planted
    wanted, near = brute(as_stored(rows))
    assert near.sum() > 2000 and len({c for _, c, _ in wanted.values()}) > 600
    assert found(vector_dedup.near_duplicate_vectors(table, spread=None, block_rows=64)) == wanted


def test_registered_query(spark, planted, tmp_path):
    """The narrower probes of the query find what brute force finds here, copies included."""
    rows, table = planted
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    frame = queries.QUERIES["op7_vector_dedup"](spark, str(tmp_path))
    assert frame.dtypes == [
        ("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean"),
    ]
    wanted, _ = brute(as_stored(rows))
    got = found(frame)
    assert got.keys() == wanted.keys()
    assert all(got[i][0] <= wanted[i][0] for i in wanted)  # no link that is none
    assert sum(n for n, _, _ in got.values()) >= 0.99 * sum(n for n, _, _ in wanted.values())
    assert sum(got[i][1:] == wanted[i][1:] for i in wanted) >= 0.99 * len(wanted)


def test_recall_and_share_of_lists():
    """Lists of one true pair each are found by the probes; most other lists are not visited."""
    rng = np.random.default_rng(11)
    points = rng.normal(size=(4000, SIZE))
    points /= np.linalg.norm(points, axis=1)[:, None]
    quantiser = vector_dedup.Quantiser.fit(points, 40)
    reach = math.sqrt(2 - 2 * 0.93)
    noise = rng.normal(size=points.shape)
    noise -= (noise * points).sum(1)[:, None] * points
    others = 0.93 * points + math.sqrt(1 - 0.93**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    own, theirs = quantiser.encode(points)[0], quantiser.encode(others)[0]
    sizes = np.full(len(points), SIZE)
    probes = quantiser.probes(points, own, vector_dedup.probe_reach(reach, sizes))
    everything = quantiser.probes(points, own, vector_dedup.probe_reach(reach, sizes, None))
    rows = np.arange(len(points))
    assert everything[rows, theirs].all() and not (probes & ~everything).any()
    assert probes[rows, theirs].mean() >= 0.99  # all at the limit, the hardest ones
    assert probes.mean() <= 0.5 * everything.mean()
    few = vector_dedup.probe_reach(reach, np.array([1, 4, 9, 16]))
    assert few.tolist() == pytest.approx([reach, reach, reach, 0.75 * reach])


def test_usable_vectors():
    big, nan, inf = 1e200, float("nan"), float("inf")
    rows = [
        None, [], [0.0, 0.0], [1.0, 2.0], [nan], [inf, 1.0], [1.0, None], [big], [3.0], [-inf, inf], [4.0, 5.0, 6.0], [],
    ]
    for lists in (pa.array(rows, pa.list_(pa.float64())), pa.array([[9.0], *rows, [8.0]], pa.list_(pa.float64()))[1:-1]):
        sizes, vectors = vector_dedup._usable(lists)
        kept = [None if v is None else np.frombuffer(v, "<f8").tolist() for v in vectors.to_pylist()]
        assert kept == [r if r in ([1.0, 2.0], [3.0], [4.0, 5.0, 6.0]) else None for r in rows]
        assert sizes.to_pylist() == [len(k) if k else 0 for k in kept]
    sizes, vectors = vector_dedup._usable(pa.array([], pa.list_(pa.float64())))
    assert len(sizes) == len(vectors) == 0
