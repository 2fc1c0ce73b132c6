"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Rows must be in random order: layer l holds the first n / SHRINK^l rows, so a row's level has the usual
geometric law. Many rows are inserted and searched side by side, in lockstep.
"""

from __future__ import annotations

import numpy as np

LINKS, BASE_LINKS = 12, 24
SHRINK = 12
SEED_ROWS = 128
BATCH = 512
BUILD_BEAM = 40
EXPAND = 4


def layer_sizes(n: int) -> list[int]:
    """Rows of each layer, the base first."""
    sizes = [n]
    while sizes[-1] > SEED_ROWS:
        sizes.append(-(-sizes[-1] // SHRINK))
    return sizes


def search_layer(vectors, graph, queries, entries, beam):
    """Beam search of many queries: ids (-1 where empty) and similarities, unordered."""
    rows, n = len(queries), len(graph)
    beam = max(1, min(beam, n))
    ids = np.full((rows, max(beam, entries.shape[1])), -1, np.int32)
    sims = np.full(ids.shape, -np.inf, np.float32)
    seen = np.zeros((rows, n), bool)
    ids[:, : entries.shape[1]] = entries
    r, c = np.nonzero(entries >= 0)
    sims[r, c] = np.einsum("ij,ij->i", queries[r], vectors[entries[r, c]])
    seen[r, entries[r, c]] = True
    done = ids < 0
    active = np.arange(rows)
    while len(active):
        left = np.where(done[active], -np.inf, sims[active])
        k = min(EXPAND, left.shape[1])
        pick = np.argpartition(-left, k - 1, axis=1)[:, :k]
        here = np.arange(len(active))[:, None]
        live = left[here, pick] > -np.inf
        some = live.any(1)
        active, pick, live = active[some], pick[some], live[some]
        if not len(active):
            break
        done[active[:, None], pick] = True
        near = graph[ids[active[:, None], pick]]
        near[~live] = -1
        near = np.sort(near.reshape(len(active), -1), axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[active[:, None], near]
        r, c = np.nonzero(fresh)
        found = near[r, c]
        seen[active[r], found] = True
        new = np.full(near.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("ij,ij->i", queries[active[r]], vectors[found])
        all_sims = np.concatenate([sims[active], new], 1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], 1)
        all_done = np.concatenate([done[active], ~fresh], 1)
        width = ids.shape[1]
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        here = np.arange(len(active))[:, None]
        sims[active], ids[active], done[active] = all_sims[here, keep], all_ids[here, keep], all_done[here, keep]
    return ids, sims


def diverse(vectors, ids, sims, most):
    """Up to ``most`` neighbours of each row: first those nearer to it than to any chosen one, best
    first, then the best of the others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    own = vectors[np.maximum(ids, 0)]
    among = own @ own.transpose(0, 2, 1)
    chosen, closest = np.zeros(ids.shape, bool), np.full(ids.shape, -np.inf, np.float32)
    count = np.zeros(len(ids), int)
    for k in range(ids.shape[1]):
        take = (ids[:, k] >= 0) & (sims[:, k] > closest[:, k]) & (count < most)
        chosen[take, k] = True
        count += take
        closest[take] = np.maximum(closest[take], among[take, k])
    rank = np.argsort(np.where(ids < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, rank, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _add_back_links(vectors, graph, new_ids, chosen):
    """Link the chosen neighbours back to the new rows; full lists are chosen anew."""
    r, c = np.nonzero(chosen >= 0)
    target, source = chosen[r, c], new_ids[r]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, begin, counts = np.unique(target, return_index=True, return_counts=True)
    most = graph.shape[1]
    extra = np.full((len(nodes), min(int(counts.max(initial=0)), 2 * most)), -1, np.int32)
    place = np.arange(len(target)) - np.repeat(begin, counts)
    fits = place < extra.shape[1]
    extra[np.repeat(np.arange(len(nodes)), counts)[fits], place[fits]] = source[fits]
    ids = np.concatenate([graph[nodes], extra], 1)
    sims = np.einsum("id,ikd->ik", vectors[nodes], vectors[np.maximum(ids, 0)])
    graph[nodes] = diverse(vectors, ids, np.where(ids < 0, -np.inf, sims).astype(np.float32), most)


def descend(vectors, layers, queries, down_to):
    """Entry points into layer ``down_to``, by narrow beams through the layers above it."""
    entries = np.zeros((len(queries), 1), np.int32)
    for graph in layers[:down_to:-1]:
        ids, sims = search_layer(vectors, graph, queries, entries, 8)
        best = np.argsort(-sims, axis=1)[:, : min(4, ids.shape[1])]
        entries = np.take_along_axis(ids, best, 1)
    return entries


def build(vectors: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of each layer, the base first; -1 where there are fewer."""
    sizes = layer_sizes(len(vectors))
    layers = [np.full((size, BASE_LINKS if i == 0 else LINKS), -1, np.int32) for i, size in enumerate(sizes)]
    for level in range(len(sizes) - 1, -1, -1):
        graph, size = layers[level], sizes[level]
        first = min(size, SEED_ROWS)
        exact = vectors[:first] @ vectors[:first].T
        np.fill_diagonal(exact, -np.inf)
        every = np.where(np.eye(first, dtype=bool), -1, np.arange(first)[None, :]).astype(np.int32)
        graph[:first] = diverse(vectors, every, exact.astype(np.float32), graph.shape[1])
        while first < size:
            stop = min(size, first + min(BATCH, first))
            queries = vectors[first:stop]
            entries = descend(vectors, layers, queries, level)
            # Rows of the layer above that are not in this one yet are no way in.
            entries = np.where(entries < first, entries, -1)
            entries[(entries < 0).all(1), 0] = 0
            ids, sims = search_layer(vectors, graph[:first], queries, entries, BUILD_BEAM)
            chosen = diverse(vectors, ids, sims, graph.shape[1])
            graph[first:stop] = chosen
            _add_back_links(vectors, graph, np.arange(first, stop, dtype=np.int32), chosen)
            first = stop
    return layers


def search(vectors, layers, queries, beam):
    """Beam search of the base layer."""
    return search_layer(vectors, layers[0], queries, descend(vectors, layers, queries, 0), beam)


def pack_layers(layers: list[np.ndarray]) -> bytes:
    return b"".join(graph.astype("<i4").tobytes() for graph in layers)


def unpack_layers(raw: bytes, n: int) -> list[np.ndarray]:
    layers, at = [], 0
    for i, size in enumerate(layer_sizes(n)):
        width = BASE_LINKS if i == 0 else LINKS
        layers.append(np.frombuffer(raw, "<i4", size * width, at).reshape(size, width))
        at += 4 * size * width
    return layers
