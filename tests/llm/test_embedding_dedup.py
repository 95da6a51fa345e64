import numpy as np

from stridelake.llm import hnsw
from stridelake.llm.embedding_dedup import THRESHOLD, embedding_groups
from stridelake.llm.hnsw import Graph, near_points, unit


def brute(rows):
    n, roots = [0] * len(rows), list(range(len(rows)))

    def usable(e, label):
        return label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)

    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                x, y = unit(np.array([a, b], float))
                if x @ y >= THRESHOLD:
                    n[i] += 1
                    n[j] += 1
                    low, high = sorted((roots[i], roots[j]))
                    roots = [low if r == high else r for r in roots]
    ids = {}
    for r, (v, _, _) in zip(roots, rows):
        if v is not None:
            ids[r] = min(v, ids.get(r, v))
    return [(v, k, ids.get(r), v is not None and v == ids.get(r)) for (v, _, _), k, r in zip(rows, n, roots)]


def order(rows):
    return sorted(rows, key=str)


def test_links_like_brute_force_over_shards(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(16).tolist(), i % 3) for i in range(120)]
    for i in range(60):  # near copies, scaled copies, exact copies
        base = np.array(rows[i % 7][1])
        rows.append((200 + i, (base * (1 + i % 3) + 0.12 * rng.standard_normal(16) * (i % 4)).tolist(), rows[i % 7][2]))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None], 1), (303, [float("nan")] * 16, 1), (304, [], 1), (305, [1e38] * 16, 1),
             (306, [1e38] * 16, 1), (307, [1.0] * 16, None), (308, [1.0] * 16, None), (309, [1.0, 2.0], 1), (310, [1.0, 2.0], 1),
             (310, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, [3.0, -2.0, 1.0], 2)]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, point int, root int")
    small = embedding_groups(vectors, shard_points=20)
    assert order(tuple(r) for r in small.collect()) == order(brute(rows))
    assert embedding_groups(vectors.limit(0)).count() == 0


def test_graph_finds_dense_groups(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((1500, 32))
    group = base[0] + 0.05 * rng.standard_normal((400, 32))
    wide = unit(np.vstack([base, group]))
    graph, by = Graph.build(wide)
    own = wide[by]
    rows, points = near_points(graph, own, own, 0.98, 64, 0.99)
    want = own @ own.T >= 0.98
    assert len(rows) >= 0.99 * want.sum() and want[rows, points].all()


class Counting:
    def __init__(self, graph):
        self.graph, self.rows = graph, 0

    def search(self, queries, beam):
        self.rows += len(queries)
        return self.graph.search(queries, beam)


def test_rare_links_come_from_the_graph(monkeypatch):
    """Every row is searched in the graph, and few are compared with all points."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((3000, 32))
    wide = unit(np.vstack([base, base[:20] + 0.05 * rng.standard_normal((20, 32))]))
    graph, by = Graph.build(wide)
    own, compared = wide[by], []
    real = hnsw._compared
    monkeypatch.setattr(hnsw, "_compared", lambda o, q, rows, *how: compared.append(len(rows)) or real(o, q, rows, *how))
    counting = Counting(graph)
    rows, points = near_points(counting, own, own, 0.98, 64, 0.99, same=True)
    assert len(rows) == 40 and counting.rows >= 2 * len(own) and sum(compared) <= 2 * 64
    other = unit(np.vstack([base[:500] + 0.01 * rng.standard_normal((500, 32)), rng.standard_normal((500, 32))]))
    rows, points = near_points(Counting(graph), own, other, 0.98, 64, 0.99)
    assert len(rows) >= 0.99 * (other @ own.T >= 0.98).sum()


def test_links_over_shards_of_over_a_thousand_points(spark):
    """Rare links, over several shards, as comparison finds them; each shard's graph is searched."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal((4200, 24))
    base = np.vstack([base, base[:60] + 0.03 * rng.standard_normal((60, 24)), base[:30] + 0.03 * rng.standard_normal((30, 24))])
    wide = unit(base.astype(np.float32))
    rows = [(i, e.tolist(), 0) for i, e in enumerate(base)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embedding_groups(vectors, shard_points=1400).collect()}
    near = wide @ wide.T >= THRESHOLD
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    assert want.sum() >= 200 and sum(got[i]["n_links"] for i in got) >= 0.99 * want.sum()
    assert all(got[i]["n_links"] <= want[i] for i in got)
    for i in range(30):
        if near[i, 4200 + i] and near[i, 4260 + i] and got[i]["n_links"] == want[i]:
            assert got[4200 + i]["component_id"] == got[4260 + i]["component_id"] == i and got[i]["kept"]


class Forgetful:
    """A graph in which beams under 64 miss half of the points' links to others, always from one side."""

    def __init__(self, graph):
        self.graph = graph

    def search(self, queries, beam):
        ids, sims = self.graph.search(queries, beam)
        if beam < 64:
            other = sims < 0.999999
            sims = np.where(other & (ids // 2 % 2 == 0), -np.inf, sims)
        return np.where(sims == -np.inf, -1, ids), sims


def test_rare_links_are_audited():
    """4,000 points of which 1 % have a near copy; recall is counted without pairs of a point with itself."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((4000, 32))
    wide = unit(np.vstack([base, base[:40] + 0.05 * rng.standard_normal((40, 32))]))
    graph, by = Graph.build(wide)
    own = wide[by]
    want = own @ own.T >= 0.98
    np.fill_diagonal(want, False)
    assert want.sum() == 80
    for searched in (graph, Forgetful(graph)):
        rows, points = near_points(searched, own, own, 0.98, 64, 0.99, same=True)
        assert len(rows) >= 0.99 * want.sum() and want[rows, points].all()
        assert set(zip(rows, points)) == set(zip(points, rows))


def test_lost_links_of_many_are_found_again():
    """Links enough that the audit is a part of the rows; the lost ones are seen, and a useless graph ends in comparison."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((1000, 32))
    wide = unit(np.repeat(base, 3, axis=0) + 0.02 * rng.standard_normal((3000, 32)))
    graph, by = Graph.build(wide)
    own = wide[by]
    want = own @ own.T >= 0.98
    np.fill_diagonal(want, False)

    class Blind(Forgetful):
        def search(self, queries, beam):
            ids, sims = self.graph.search(queries, min(beam, 32))
            return ids, np.where(sims < 0.999999, -np.inf, sims)

    for searched in (Forgetful(graph), Blind(graph)):
        rows, points = near_points(searched, own, own, 0.98, 64, 0.99, same=True)
        assert len(rows) >= 0.99 * want.sum() and want[rows, points].all()
        assert set(zip(rows, points)) == set(zip(points, rows))
