"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Nodes enter in blocks and are searched in blocks, so that each step of a beam
search is one array operation over many queries.
"""

from __future__ import annotations

import numpy as np


class Graph:
    """``layers[l]`` has the neighbours of each node, -1 where there are fewer."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray], entry: int):
        self.unit, self.layers, self.entry = unit, layers, entry

    @staticmethod
    def build(unit: np.ndarray, m: int = 12, beam: int = 48, block: int = 512, seed: int = 7) -> Graph:
        """Nodes enter in a random order, so that blocks are mixed; ids stay those of ``unit``."""
        n = len(unit)
        rng = np.random.default_rng(seed)
        order = rng.permutation(n)
        level = np.minimum((-np.log(1 - rng.random(n)) / np.log(m)).astype(int), 6)
        top = int(level.max(initial=0))
        g = Graph(unit, [np.full((n, 2 * m if lv == 0 else m), -1, dtype=np.int32) for lv in range(top + 1)], -1)
        at, entry_level = 0, -1
        while at < n:
            ids = order[at:at + min(block, max(1, at))]
            for lv in range(top, -1, -1):
                members = ids[level[ids] >= lv]
                if len(members):
                    g._insert(members, lv, entry_level, beam, m)
            highest = ids[np.argmax(level[ids])]
            if level[highest] > entry_level:
                g.entry, entry_level = int(highest), int(level[highest])
            at += len(ids)
        return g

    def _insert(self, ids, lv, entry_level, beam, m):
        q = self.unit[ids]
        cand = np.empty((len(ids), 0), dtype=np.int64)
        sims = np.empty((len(ids), 0), dtype=q.dtype)
        if self.entry >= 0 and lv <= entry_level:
            cand, sims = self.search_layer(q, self.descend(q, lv), beam, lv)
        own = q @ q.T
        np.fill_diagonal(own, -np.inf)
        k = min(len(ids) - 1, beam)
        if k > 0:
            near = np.argpartition(-own, k - 1, axis=1)[:, :k]
            cand = np.hstack([cand, ids[near]])
            sims = np.hstack([sims, np.take_along_axis(own, near, 1)])
        if not cand.shape[1]:
            return
        chosen = self._diverse(cand, sims, m)
        layer = self.layers[lv]
        layer[ids, :m] = chosen
        # Back links: a neighbour keeps its most diverse links when it has too many.
        src, dst = np.repeat(ids, m), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        back = np.argsort(dst, kind="stable")
        src, dst = src[back], dst[back]
        node, first, count = np.unique(dst, return_index=True, return_counts=True)
        width = int(count.max(initial=0))
        for lo in range(0, len(node), 512):
            part = slice(lo, lo + 512)
            slot = np.arange(width)
            new = np.where(slot < count[part, None], src[np.minimum(first[part, None] + slot, len(src) - 1)], -1)
            old = layer[node[part]]
            new = np.where((new[:, :, None] == old[:, None, :]).any(2), -1, new)
            both = np.hstack([old, new])
            s = np.einsum("nd,nkd->nk", self.unit[node[part]], self.unit[both])
            s = np.where(both >= 0, s, -np.inf)
            layer[node[part]] = self._diverse(both, s, layer.shape[1])

    def _diverse(self, cand, sims, m):
        """Up to m candidates of each row: first those nearer to the row than to any chosen one, then the nearest of the rest."""
        n, width = cand.shape
        order = np.argsort(-sims, axis=1, kind="stable")[:, :max(4 * m, 32)]
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        width = cand.shape[1]
        out, n_out = np.full((n, m), -1, dtype=np.int64), np.zeros(n, dtype=int)
        taken = np.zeros((n, width), dtype=bool)
        rows = np.arange(n)
        vec = self.unit[np.maximum(out, 0)]
        for k in range(width):
            ok = (sims[:, k] > -np.inf) & (n_out < m)
            if not ok.any():
                break
            to_chosen = np.einsum("nd,nmd->nm", self.unit[cand[:, k]], vec)
            to_chosen = np.where(out >= 0, to_chosen, -np.inf).max(1)
            r = rows[ok & (sims[:, k] > to_chosen)]
            out[r, n_out[r]] = cand[r, k]
            vec[r, n_out[r]] = self.unit[cand[r, k]]
            n_out[r] += 1
            taken[r, k] = True
        for k in range(width):
            r = rows[(sims[:, k] > -np.inf) & (n_out < m) & ~taken[:, k]]
            out[r, n_out[r]] = cand[r, k]
            n_out[r] += 1
        return out

    def descend(self, q, down_to: int):
        at = np.full(len(q), self.entry)
        for lv in range(len(self.layers) - 1, down_to, -1):
            ids, sims = self.search_layer(q, at, 1, lv)
            at = ids[:, 0]
        return at

    def search_layer(self, q, entry, beam: int, lv: int, wide: int = 4):
        """(ids, similarities) of the nearest nodes found from ``entry``; -1 and -inf where there are fewer."""
        n, layer = len(q), self.layers[lv]
        wide = min(wide, beam)
        seen = np.zeros((n, len(self.unit)), dtype=bool)
        ids = np.full((n, beam), -1, dtype=np.int64)
        sims = np.full((n, beam), -np.inf, dtype=q.dtype)
        done = np.zeros((n, beam), dtype=bool)
        ids[:, 0], sims[:, 0] = entry, np.einsum("nd,nd->n", q, self.unit[entry])
        seen[np.arange(n), entry] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(done[live] | (ids[live] < 0), -np.inf, sims[live])
            pick = np.argpartition(-waiting, wide - 1, axis=1)[:, :wide]
            real = np.take_along_axis(waiting, pick, 1) > -np.inf
            keep = real.any(1)
            live, pick, real = live[keep], pick[keep], real[keep]
            if not len(live):
                break
            mark = done[live]
            np.put_along_axis(mark, pick, np.take_along_axis(mark, pick, 1) | real, 1)
            done[live] = mark
            nodes = np.where(real, np.take_along_axis(ids[live], pick, 1), -1)
            new = np.where((nodes >= 0)[:, :, None], layer[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
            new = np.sort(new, axis=1)
            fresh = new >= 0
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            fresh &= ~seen[live[:, None], np.maximum(new, 0)]
            r, c = np.nonzero(fresh)
            seen[live[r], new[r, c]] = True
            s = np.full(new.shape, -np.inf, dtype=q.dtype)
            s[r, c] = np.einsum("nd,nd->n", q[live[r]], self.unit[new[r, c]])
            all_ids = np.hstack([ids[live], np.where(fresh, new, -1)])
            all_sims = np.hstack([sims[live], s])
            all_done = np.hstack([done[live], np.zeros(new.shape, dtype=bool)])
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live] = np.take_along_axis(all_ids, best, 1)
            sims[live] = np.take_along_axis(all_sims, best, 1)
            done[live] = np.take_along_axis(all_done, best, 1)
        return ids, sims

    def within(self, q: np.ndarray, least: float, beam: int, block: int = 256):
        """(query, node) pairs found with similarity of at least ``least``.

        A query whose whole beam lies within the radius is searched again with
        twice the beam, until the beam reaches past the radius or all nodes.
        """
        out = []
        for lo in range(0, len(q), block):
            rows, width = np.arange(lo, min(lo + block, len(q))), min(beam, len(self.unit))
            while len(rows):
                ids, sims = self.search_layer(q[rows], self.descend(q[rows], 0), width, 0)
                full = (sims >= least).all(1) & (width < len(self.unit))
                r, c = np.nonzero((sims >= least) & ~full[:, None])
                out.append((rows[r], ids[r, c]))
                rows, width = rows[full], min(2 * width, len(self.unit))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, int), np.empty(0, int))
