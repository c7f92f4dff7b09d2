"""Cover trees in numpy, and dual-tree search for the largest inner products.

The points of a node lie within its radius of its centre, which is one of them.
A child's centre covers points within a smaller radius. For a group of queries
(centre q, radius r) and a node (centre p, radius s) no inner product exceeds
q.p + |q| s + |p| r + r s; a pair of nodes whose bound is below the worst kth
score of the group is dropped.
"""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass

import numpy as np

LEAF = 512
CENTRES = 16
SHRINK = 0.6
EXACT = float(1 << 53)
# Score and id of a place that no candidate has taken; the score can be negated.
NOTHING = np.iinfo(np.int64).min + 1
NOBODY = np.iinfo(np.int64).max


@dataclass(frozen=True)
class CoverTree:
    """Points in tree order; node i holds the points ``begin[i]`` to ``end[i]`` and
    has the nodes ``child[i]`` to ``child[i] + children[i]`` below it. ``least`` is
    the smallest id in a node."""

    points: np.ndarray
    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    least: np.ndarray

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> "CoverTree":
        with np.load(io.BytesIO(data)) as parts:
            return CoverTree(**{k: parts[k] for k in parts.files})


def _cover(points: np.ndarray, centre: int, radius: float) -> np.ndarray:
    """Child of each point: centres are chosen one by one among points that no
    centre covers yet, the farthest from all centres first; every point goes to
    its nearest centre."""
    owner = np.full(len(points), centre)
    nearest = np.linalg.norm(points - points[centre], axis=1)
    for _ in range(CENTRES - 1):
        far = int(nearest.argmax())
        if nearest[far] <= radius * SHRINK:
            break
        distance = np.linalg.norm(points - points[far], axis=1)
        closer = distance < nearest
        owner[closer] = far
        nearest[closer] = distance[closer]
    return owner


def build(points: np.ndarray, ids: np.ndarray, leaf: int) -> CoverTree:
    """Tree over rows of whole numbers (held as doubles)."""
    order = np.lexsort((ids,))
    points, ids = np.asarray(points, float)[order], np.asarray(ids)[order]
    at = np.arange(len(points))
    nodes: list[list] = []
    # Breadth first, so that the children of a node stand side by side.
    queue = [(0, len(points), 0)] if len(points) else []
    head = 0
    while head < len(queue):
        begin, end, centre = queue[head]
        head += 1
        own = points[at[begin:end]]
        where = int(np.flatnonzero(at[begin:end] == centre)[0]) if head > 1 else 0
        if head == 1:
            centre = at[begin]
        distance = np.linalg.norm(own - points[centre], axis=1)
        radius = float(distance.max()) * (1 + 1e-12)
        first, count = len(queue), 0
        if end - begin > leaf and radius > 0:
            owner = _cover(own, where, radius)
            inner = np.argsort(owner, kind="stable")
            members = at[begin:end][inner]
            centres, starts = np.unique(owner[inner], return_index=True)
            heads = at[begin:end][centres]
            at[begin:end] = members
            stops = np.append(starts[1:], end - begin)
            for h, a, b in zip(heads.tolist(), starts.tolist(), stops.tolist()):
                queue.append((begin + a, begin + b, h))
                count += 1
        nodes.append([begin, end, first, count, centre, radius])
    if not nodes:
        none = np.zeros(0, np.int64)
        return CoverTree(points, ids, none, none, none, none, none, none.astype(float), none)
    begin, end, child, children, centre, radius = (np.array(c) for c in zip(*nodes))
    place = np.empty(len(at), np.int64)
    place[at] = np.arange(len(at))
    ids = ids[at]
    least = np.array([ids[b:e].min() for b, e in zip(begin, end)])
    return CoverTree(
        points[at], ids, begin, end, child, children, place[centre], radius.astype(float), least
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    top = (np.abs(a).max(initial=0.0)) * (np.abs(b).max(initial=0.0)) * max(a.shape[1], 1)
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class TopK:
    """Best k candidates of each query so far: higher score, then smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), NOTHING)
        self.ids = np.full((n, k), NOBODY)

    def add(self, rows: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        ids = np.concatenate(
            [self.ids[rows], np.broadcast_to(ids, (len(scores), len(ids)))], axis=1
        )
        order = np.lexsort((ids, -scores), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)


def no_floor(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of the kth candidate of ``n`` queries that have none yet."""
    return np.full(n, NOTHING), np.full(n, NOBODY)


def outer_bounds(queries: tuple, data: tuple) -> np.ndarray:
    """What no inner product exceeds, for groups of queries and groups of points:
    each a pair of centres (one a row, equally wide) and radii."""
    (q, r), (p, s) = queries, data
    q_norm, p_norm = np.linalg.norm(q, axis=1)[:, None], np.linalg.norm(p, axis=1)[None, :]
    bound = q @ p.T + q_norm * s + p_norm * r[:, None] + r[:, None] * s
    return bound + 1e-9 * np.abs(bound) + 1e-3


def search(queries: CoverTree, data: CoverTree, k: int, floor: tuple | None = None) -> TopK:
    """The k largest inner products of each query with points of another id.

    ``floor``: score and id of each query's kth candidate found elsewhere; what comes
    after it may be left out.
    """
    best = TopK(len(queries.ids), k)
    floor_scores, floor_ids = floor or no_floor(len(queries.ids))
    if not len(queries.ids) or not len(data.ids):
        return best
    q_norm = np.linalg.norm(queries.points[queries.centre], axis=1)
    p_centre = data.points[data.centre]
    p_norm = np.linalg.norm(p_centre, axis=1)

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        centre = p_centre[nodes] @ queries.points[queries.centre[q]]
        rest = q_norm[q] * data.radius[nodes] + p_norm[nodes] * queries.radius[q]
        bound = centre + rest + data.radius[nodes] * queries.radius[q]
        return bound + 1e-9 * np.abs(bound) + 1e-3

    def alive(q: int, nodes: np.ndarray, bound: np.ndarray) -> np.ndarray:
        rows = slice(queries.begin[q], queries.end[q])
        own, elsewhere = best.scores[rows, -1], floor_scores[rows]
        worst = np.maximum(own, elsewhere)
        least = worst.min()
        # At the worst score itself only a smaller id could matter.
        own_ids = np.where(own == worst, best.ids[rows, -1], NOBODY)
        other_ids = np.where(elsewhere == worst, floor_ids[rows], NOBODY)
        last_id = np.minimum(own_ids, other_ids)[worst == least].max()
        whole = np.floor(bound)
        return (whole > least) | ((whole == least) & (data.least[nodes] < last_id))

    def base_case(q: int, node: int) -> None:
        rows = slice(queries.begin[q], queries.end[q])
        ids = data.ids[data.begin[node] : data.end[node]]
        scores = products(queries.points[rows], data.points[data.begin[node] : data.end[node]])
        scores[queries.ids[rows][:, None] == ids[None, :]] = NOTHING
        best.add(rows, scores, ids)

    def leaf_search(q: int, nodes: np.ndarray) -> None:
        """Best bound first, until no node is left that could still matter."""
        found = bounds(q, nodes)
        heap = [(-b, n) for b, n in zip(found.tolist(), nodes.tolist())]
        heapq.heapify(heap)
        while heap:
            bound, node = heapq.heappop(heap)
            if not alive(q, np.array([node]), np.array([-bound]))[0]:
                continue
            if data.children[node] == 0:
                base_case(q, node)
                continue
            below = np.arange(data.child[node], data.child[node] + data.children[node])
            found = bounds(q, below)
            kept = alive(q, below, found)
            for b, n in zip(found[kept].tolist(), below[kept].tolist()):
                heapq.heappush(heap, (-b, n))

    # Both trees go down together: a query node hands the nodes it cannot drop,
    # one level deeper, to its children.
    stack = [(0, np.array([0]))]
    while stack:
        q, nodes = stack.pop()
        nodes = nodes[alive(q, nodes, bounds(q, nodes))]
        if not len(nodes):
            continue
        if queries.children[q] == 0:
            leaf_search(q, nodes)
            continue
        inner = nodes[data.children[nodes] > 0]
        deeper = [np.arange(data.child[n], data.child[n] + data.children[n]) for n in inner]
        below = np.concatenate([nodes[data.children[nodes] == 0], *deeper])
        for child in range(queries.child[q], queries.child[q] + queries.children[q]):
            stack.append((child, below))
    return best
