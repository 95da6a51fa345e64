"""A hierarchical navigable small-world graph in numpy, built and searched in batches."""

from __future__ import annotations

import numpy as np

LINKS = 16
BUILD_BEAM = 64
_BATCH = 512
_STEP = 4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; rows must be finite and not zero."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


class Graph:
    """Layers over unit vectors, by inner product. Points stand in the order of their level, highest
    first, so each layer holds a prefix of them and an upper layer is complete before the next one starts."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None):
        self.vectors, self.layers = np.ascontiguousarray(vectors, np.float32), layers or []

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> tuple[Graph, np.ndarray]:
        """The graph and the order of its points as positions in ``vectors``."""
        level = (np.random.default_rng(seed).exponential(1 / np.log(LINKS), len(vectors))).astype(np.int64)
        order = np.argsort(-level, kind="stable")
        graph, level = cls(vectors[order]), level[order]
        for at in range(int(level[0]), -1, -1):
            graph._add_layer(int(np.searchsorted(-level, -at, side="right")), 2 * LINKS if at == 0 else LINKS)
        return graph, order

    def _add_layer(self, n: int, width: int) -> None:
        table = np.full((n, width), -1, np.int32)
        self.layers.append(table)
        done = 0
        while done < n:
            size = min(n - done, _BATCH, max(32, done))
            new = np.arange(done, done + size)
            queries = self.vectors[new]
            near = queries @ queries.T
            near[np.tri(size, dtype=bool)] = -np.inf  # earlier points of the batch meet later ones as reverse links
            near = near.T
            k = min(size, BUILD_BEAM)
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            sims = np.take_along_axis(near, best, 1)
            found = np.where(sims > -np.inf, best + done, -1)
            if done:
                beam, beam_sims = self.search(queries, BUILD_BEAM, n_of_last=done)
                found, sims = np.hstack([found, beam]), np.hstack([sims, beam_sims])
            table[new] = self._diverse(found, sims, width // 2 if n > 1 else width, width)
            self._link_back(table, new)
            done += size

    def _diverse(self, found: np.ndarray, sims: np.ndarray, most: int, width: int) -> np.ndarray:
        """Of each row's candidates those nearer to the row's point than to one chosen before; free
        places go to the nearest of the rest."""
        sims = np.where(found < 0, -np.inf, sims)
        by = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * width]
        found, sims = np.take_along_axis(found, by, 1), np.take_along_axis(sims, by, 1)
        vectors = self.vectors[np.maximum(found, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        taken, nearest = np.zeros(found.shape, bool), np.full(sims.shape, -np.inf, np.float32)
        count = np.zeros(len(found), np.int64)
        for j in range(found.shape[1]):
            take = (sims[:, j] > nearest[:, j]) & (count < most)
            taken[:, j], count = take, count + take
            nearest = np.where(take[:, None], np.maximum(nearest, between[:, j]), nearest)
        rank = np.where(sims == -np.inf, 2, np.where(taken, 0, 1))
        by = np.argsort(rank, axis=1, kind="stable")[:, :width]
        chosen = np.where(np.take_along_axis(rank, by, 1) == 2, -1, np.take_along_axis(found, by, 1))
        if chosen.shape[1] < width:
            chosen = np.hstack([chosen, np.full((len(chosen), width - chosen.shape[1]), -1)])
        keep = np.arange(width) < np.maximum(most, count)[:, None]
        return np.where(keep, chosen, -1).astype(np.int32)

    def _link_back(self, table: np.ndarray, new: np.ndarray) -> None:
        width = table.shape[1]
        source, target = np.repeat(new, width), table[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        sims = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        by = np.lexsort((-sims, target))
        source, target, sims = source[by], target[by], sims[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(first, count)
        rows, inside = np.repeat(np.arange(len(nodes)), count), rank < 2 * width
        extra = np.full((len(nodes), 2 * width), -1, np.int64)
        extra[rows[inside], rank[inside]] = source[inside]
        old = table[nodes].astype(np.int64)
        extra[(extra[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        merged = np.hstack([old, extra])
        packed = np.take_along_axis(merged, np.argsort(merged < 0, axis=1, kind="stable"), 1)
        fits = (packed >= 0).sum(axis=1) <= width
        table[nodes[fits]] = packed[fits, :width]
        full = np.flatnonzero(~fits)
        for at in range(0, len(full), _BATCH):
            part = full[at : at + _BATCH]
            centre, found = self.vectors[nodes[part]], packed[part]
            near = (self.vectors[np.maximum(found, 0)] @ centre[:, :, None])[:, :, 0]
            table[nodes[part]] = self._diverse(found, near, width, width)

    def search(self, queries: np.ndarray, beam: int, n_of_last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and similarities (rows x beam, -1 where there are fewer) of the points nearest to each query
        that the beams reach, from the top layer down. ``n_of_last``: points of the last layer so far."""
        entry = np.zeros((len(queries), 1), np.int64)
        found = sims = None
        for at, table in enumerate(self.layers):
            last = at == len(self.layers) - 1
            n = n_of_last if last and n_of_last else len(table)
            found, sims = self._search_layer(table, n, queries, entry, beam if last else 8)
            entry = found
        return found, sims

    def _search_layer(self, table, n, queries, entry, beam):
        beam = min(beam, n)
        rows = len(queries)
        seen = np.zeros((rows, n), bool)
        ids = np.full((rows, beam), -1, np.int64)
        sims = np.full((rows, beam), -np.inf, np.float32)
        open_ = np.zeros((rows, beam), bool)
        entry = np.where(entry < n, entry, -1)
        k = min(beam, entry.shape[1])
        ids[:, :k] = entry[:, :k]
        near = (self.vectors[np.maximum(ids[:, :k], 0)] @ queries[:, :, None])[:, :, 0]
        sims[:, :k] = np.where(ids[:, :k] >= 0, near, -np.inf)
        open_[:, :k] = ids[:, :k] >= 0
        r, c = np.nonzero(ids >= 0)
        seen[r, ids[r, c]] = True
        live = np.arange(rows)
        while len(live):
            score = np.where(open_[live], sims[live], -np.inf)
            step = min(max(_STEP, beam // 16), beam)
            pick = np.argpartition(-score, step - 1, axis=1)[:, :step] if step < beam else np.tile(np.arange(beam), (len(live), 1))
            usable = np.take_along_axis(score, pick, 1) > -np.inf
            going = usable.any(axis=1)
            live, pick, usable = live[going], pick[going], usable[going]
            if not len(live):
                break
            open_[live[:, None], pick] = False
            nodes = np.where(usable, ids[live[:, None], pick], 0)
            nexts = np.where(usable[:, :, None], table[nodes], -1).reshape(len(live), -1).astype(np.int64)
            nexts.sort(axis=1)
            fresh = (nexts >= 0) & (nexts < n)
            fresh[:, 1:] &= nexts[:, 1:] != nexts[:, :-1]
            safe = np.where(fresh, nexts, 0)
            fresh &= ~seen[live[:, None], safe]
            r, c = np.nonzero(fresh)
            seen[live[r], nexts[r, c]] = True
            near = np.full(nexts.shape, -np.inf, np.float32)
            near[r, c] = np.einsum("ij,ij->i", self.vectors[nexts[r, c]], queries[live[r]])
            all_ids = np.hstack([ids[live], np.where(fresh, nexts, -1)])
            all_sims, all_open = np.hstack([sims[live], near]), np.hstack([open_[live], fresh])
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            open_[live] = np.take_along_axis(all_open, top, 1)
        ids = np.where(sims == -np.inf, -1, ids)
        by = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)


def near_points(graph: Graph, own: np.ndarray, queries: np.ndarray, threshold: float, audit: int, recall: float, same: bool = False):
    """(rows of ``queries``, positions) of the pairs with cosine >= threshold in double precision.

    ``own`` and ``queries`` are unit vectors in double precision, ``own`` in the graph's order. A beam whose
    last place is still above the threshold is widened for its row until it isn't. With ``same`` the queries are
    the graph's own points: a pair of a point with itself is neither returned nor audited, and a link found from
    one side holds for both.

    All rows are searched with beams twice as wide again and again, until two things hold: the wider beams found less
    than 1 - ``recall`` of new links, and of the links that a comparison with all points finds for some rows, ``recall``
    are among them. These rows are spread over all (``audit``, and one in a hundred where that is more) or have links
    (``audit``); each part must pass. Only where beams as wide as the graph don't do are all rows compared.
    """
    n, beam, loose = len(own), 32, threshold - 1e-5
    order = np.random.default_rng(11).permutation(len(queries))
    spread = order[: max(audit, len(queries) // 100)]
    true = np.full(len(queries), -1)

    def audited(part: np.ndarray, found: np.ndarray) -> bool:
        new = part[true[part] < 0]
        true[new] = np.bincount(_compared(own, queries, new, threshold, same)[0], minlength=len(queries))[new]
        return found[part].sum() >= recall * true[part].sum()

    pairs, before = None, -1
    while True:
        more = _all_rows(graph, own, queries, threshold, loose, min(beam, n))
        if same:
            more = tuple(x[more[0] != more[1]] for x in more)
            more = with_pairs(more, more[::-1], n)
        pairs = more if pairs is None else with_pairs(more, pairs, n)
        found = np.bincount(pairs[0], minlength=len(queries))
        settled = beam >= n or before >= recall * len(pairs[0])
        if settled and audited(spread, found) and audited(order[found[order] > 0][:audit], found):
            return pairs
        if beam >= n:
            pairs = _compared(own, queries, np.arange(len(queries)), threshold, same)
            return with_pairs(pairs, pairs[::-1], n) if same else pairs
        before, beam = len(pairs[0]), 2 * beam


def with_pairs(pairs, more, n: int):
    """``pairs`` and those of ``more`` that are not among them; second members are below ``n``."""
    keys = pairs[0] * n + pairs[1]
    keys.sort()
    lost = []
    for at in range(0, len(more[0]) if len(keys) else 0, 1 << 20):
        part = more[0][at : at + (1 << 20)] * n + more[1][at : at + (1 << 20)]
        lost.append(at + np.flatnonzero(keys[np.minimum(np.searchsorted(keys, part), len(keys) - 1)] != part))
    if not len(keys):
        return more
    lost = np.concatenate(lost or [np.zeros(0, np.int64)])
    return tuple(np.concatenate([a, b[lost]]) if len(lost) else a for a, b in zip(pairs, more))


def _compared(own, queries, rows, threshold, same):
    """The pairs of the given rows, by comparison with all points."""
    a, b = [rows[:0]], [rows[:0]]
    step = max(1, (1 << 22) // max(1, len(own)))
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        r, c = np.nonzero(queries[part] @ own.T >= threshold)
        keep = part[r] != c if same else slice(None)
        a.append(part[r][keep])
        b.append(c[keep])
    return np.concatenate(a), np.concatenate(b)


def _all_rows(graph, own, queries, threshold, loose, beam):
    rows, points = [], []
    waiting = np.arange(len(queries))
    while len(waiting):
        wider = []
        batch = max(16, min(_BATCH, (1 << 24) // max(1, len(own)), (1 << 18) // beam))
        for at in range(0, len(waiting), batch):
            part = waiting[at : at + batch]
            ids, sims = graph.search(queries[part].astype(np.float32), beam)
            ids, sims = ids[:, :beam], sims[:, :beam]
            full = (sims[:, -1] >= loose) & (ids.shape[1] < len(own))
            wider.append(part[full])
            r, c = np.nonzero((sims >= loose) & ~full[:, None])
            exact = np.empty(len(r))
            for i in range(0, len(r), 1 << 15):
                j = slice(i, i + (1 << 15))
                exact[j] = np.einsum("ij,ij->i", queries[part[r[j]]], own[ids[r[j], c[j]]])
            good = exact >= threshold
            rows.append(part[r[good]])
            points.append(ids[r[good], c[good]])
        waiting, beam = np.concatenate(wider), min(4 * beam, len(own))
    return np.concatenate(rows or [waiting]), np.concatenate(points or [waiting])
