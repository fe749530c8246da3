"""Hierarchical navigable small-world graphs, built and searched in batches.

All vectors are unit rows of float32. Each level's graph holds a random subset
of the level below; a batch of queries descends together, one array operation
for all of them.
"""

from __future__ import annotations

import numpy as np

LINKS = 12  # chosen for a new node; a node keeps twice as many
BATCH = 512
AT_ONCE = 4  # beam entries expanded in a step


class Graph:
    """One level: ``nodes`` (rows of the vectors) and, by row, up to 2 * LINKS neighbours."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.links = np.full((len(vectors), 2 * LINKS), -1, dtype=np.int32)

    def search(self, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and similarities of the ``beam`` best found for each query, best first, -1 where none."""
        count, every = len(queries), np.arange(len(queries))[:, None]
        seen = np.zeros((count, len(self.vectors)), dtype=bool)
        ids = np.full((count, beam), -1, dtype=np.int64)
        sims = np.full((count, beam), -np.inf, dtype=np.float32)
        fresh = np.zeros((count, beam), dtype=bool)
        ids[:, : entry.shape[1]] = entry
        sims[:, : entry.shape[1]] = np.where(entry >= 0, np.einsum("qkd,qd->qk", self.vectors[entry], queries), -np.inf)
        fresh[:, : entry.shape[1]] = entry >= 0
        seen[every, np.where(entry < 0, entry[:, :1], entry)] = True
        active = np.arange(count)
        step = min(AT_ONCE, beam)
        while len(active):
            rank = np.where(fresh[active], sims[active], -np.inf)
            best = np.argpartition(-rank, step - 1, axis=1)[:, :step]
            usable = np.take_along_axis(rank, best, axis=1) > -np.inf
            going = usable.any(axis=1)
            active, best, usable = active[going], best[going], usable[going]
            if not len(active):
                break
            fresh[active[:, None], best] = False
            near = self.links[ids[active[:, None], best]]
            near = np.where(usable[:, :, None], near, -1).reshape(len(active), -1).astype(np.int64)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[active[:, None], near]] = -1
            row, col = np.nonzero(near >= 0)
            found = near[row, col]
            seen[active[row], found] = True
            near_sims = np.full(near.shape, -np.inf, dtype=np.float32)
            near_sims[row, col] = np.einsum("nd,nd->n", self.vectors[found], queries[active[row]])
            all_sims = np.concatenate([sims[active], near_sims], axis=1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[active] = np.take_along_axis(all_sims, keep, axis=1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), keep, axis=1)
            fresh[active] = np.take_along_axis(np.concatenate([fresh[active], near_sims > -np.inf], axis=1), keep, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        sims = np.take_along_axis(sims, order, axis=1)
        return np.where(sims > -np.inf, np.take_along_axis(ids, order, axis=1), -1), sims

    def choose(self, queries: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of each row's candidates: those nearer to the query than to one chosen before, then the rest."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        valid = sims > -np.inf
        own = self.vectors[ids]
        between = np.einsum("qkd,qjd->qkj", own, own)
        chosen = np.zeros(ids.shape, dtype=bool)
        for k in range(ids.shape[1]):
            shadowed = (chosen & (between[:, k] > sims[:, k : k + 1])).any(axis=1)
            chosen[:, k] = valid[:, k] & ~shadowed & (chosen.sum(axis=1) < most)
        rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(valid, rank, axis=1), np.take_along_axis(ids, rank, axis=1), -1)

    def insert(self, rows: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Link new ``rows`` with the candidates found for them, and those back."""
        links = self.choose(self.vectors[rows], ids, sims, LINKS)
        self.links[rows, :LINKS] = links
        to, source = links.ravel(), np.repeat(rows, links.shape[1])
        source, to = source[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        source, to = source[order], to[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        for a in range(0, len(targets), BATCH):
            t, f, c = targets[a : a + BATCH], first[a : a + BATCH], count[a : a + BATCH]
            width = c.max()
            new = np.where(np.arange(width) < c[:, None], source[np.minimum(f[:, None] + np.arange(width), len(source) - 1)], -1)
            both = np.concatenate([self.links[t].astype(np.int64), new], axis=1)
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near = np.where(both >= 0, np.einsum("qkd,qd->qk", self.vectors[both], self.vectors[t]), -np.inf)
            if both.shape[1] > 4 * LINKS:  # the nearest are enough to choose from
                keep = np.argpartition(-near, 4 * LINKS - 1, axis=1)[:, : 4 * LINKS]
                both, near = np.take_along_axis(both, keep, axis=1), np.take_along_axis(near, keep, axis=1)
            self.links[t] = self.choose(self.vectors[t], both, near, 2 * LINKS)


class Hnsw:
    """Levels from the top down; the top one is entered at its first row."""

    def __init__(self, vectors: np.ndarray, levels: list[Graph], top: int):
        self.vectors, self.levels, self.top = vectors, levels, top

    @classmethod
    def build(cls, vectors: np.ndarray, beam: int = 40, seed: int = 7) -> Hnsw:
        height = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(vectors))) / np.log(LINKS)).astype(int)
        order = np.argsort(-height, kind="stable")
        self = cls(vectors, [], int(order[0]))
        for level in range(int(height.max()), -1, -1):
            graph, rows = Graph(vectors), order[: int((height >= level).sum())]
            done = 1  # the first row has nothing to link with
            while done < len(rows):
                new = rows[done : done + min(BATCH, max(1, done))]
                queries = vectors[new]
                ids, sims = graph.search(queries, self.descend(queries, rows[:1]), min(beam, 4 * LINKS))
                among = queries @ queries.T
                among[np.arange(len(new)) <= np.arange(len(new))[:, None]] = -np.inf
                most = min(LINKS, len(new))
                near = np.argpartition(-among, most - 1, axis=1)[:, :most]
                graph.insert(new, np.concatenate([ids, new[near]], axis=1), np.concatenate([sims, np.take_along_axis(among, near, axis=1)], axis=1))
                done += len(new)
            self.levels.append(graph)
        return self

    def descend(self, queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """One entry into the next level for each query."""
        at = np.full((len(queries), 1), self.top if self.levels else entry[0])
        for graph in self.levels:
            at = graph.search(queries, at, 1)[0]
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        beam = min(beam, len(self.vectors))
        at = np.full((len(queries), 1), self.top)
        for graph in self.levels[:-1]:
            at = graph.search(queries, at, 1)[0]
        return self.levels[-1].search(queries, at, beam)
