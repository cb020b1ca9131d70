"""Binary labelling of a small graph by minimum cut.

``unary[i] > 0`` is what it costs to label node i false, ``-unary[i]`` what it
costs to label it true; an edge (i, j, w) costs w where the labels differ."""

from __future__ import annotations

from collections import deque


def label(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost; between equal ones, true where it must be.

    A node whose terminal capacity is at least that of its edges is on its own
    side in some minimum cut: it is settled and its edges move to its neighbours'
    terminals. What is left is cut by maximum flow, component by component."""
    near: list[dict[int, float]] = [{} for _ in unary]
    for i, j, w in edges:
        if i != j and w > 0:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    pull = list(unary)
    side: list[bool | None] = [None] * len(unary)
    queue = deque(range(len(unary)))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(pull[i]) >= sum(near[i].values()):
            side[i] = pull[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                pull[j] += w if side[i] else -w
                if side[j] is None:
                    queue.append(j)
            near[i] = {}
    for i, s in enumerate(side):
        if s is None:
            part, todo = [], [i]
            side[i] = False
            while todo:
                k = todo.pop()
                part.append(k)
                for j in near[k]:
                    if side[j] is None:
                        side[j] = False
                        todo.append(j)
            for k in max_flow(part, pull, near):
                side[k] = True
    return side


def max_flow(part: list[int], pull: list[float], near: list[dict[int, float]]) -> list[int]:
    """The nodes of ``part`` on the source side of a minimum cut (Dinic's algorithm)."""
    place = {k: i for i, k in enumerate(part)}
    n, source, sink = len(part) + 2, len(part), len(part) + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]

    def edge(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)
    for i, k in enumerate(part):
        if pull[k] > 0:
            edge(source, i, pull[k], 0.0)
        elif pull[k] < 0:
            edge(i, sink, -pull[k], 0.0)
        for j, w in near[k].items():
            if place[j] > i:
                edge(i, place[j], w, w)
    tiny = 1e-9
    while True:
        level = [-1] * n
        level[source] = 0
        todo = deque([source])
        while todo:
            a = todo.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    todo.append(to[e])
        if level[sink] < 0:
            return [k for i, k in enumerate(part) if level[i] >= 0]
        nth = [0] * n
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                first = len(path)
                for x, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= tiny and x < first:
                        first = x
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while nth[a] < len(out[a]):
                e = out[a][nth[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                nth[a] += 1
            if nth[a] < len(out[a]):
                path.append(out[a][nth[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                a = to[path.pop() ^ 1]
                nth[a] += 1
