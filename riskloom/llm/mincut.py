"""Two-label minimum cuts of small graphs."""

from __future__ import annotations

from collections import deque


def label(lean: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labels with the least total cost, True or False for each node.

    lean: what label False costs a node more than True (negative: the other way). edges: (a, b, cost) is paid
    when the labels of a and b differ. Nodes whose lean outweighs all their open edges are settled first, which
    changes nothing of the optimum; maximum flow settles the rest.
    """
    lean = list(lean)
    around: list[list[tuple[int, int]]] = [[] for _ in lean]
    open_cost = [0] * len(lean)
    for a, b, cost in edges:
        if a != b and cost > 0:
            around[a].append((b, cost))
            around[b].append((a, cost))
            open_cost[a] += cost
            open_cost[b] += cost
    out: list[bool | None] = [None] * len(lean)
    waiting = deque(range(len(lean)))
    while waiting:
        a = waiting.popleft()
        if out[a] is None and abs(lean[a]) >= open_cost[a]:
            out[a] = lean[a] > 0
            for b, cost in around[a]:
                if out[b] is None:
                    lean[b] += cost if out[a] else -cost
                    open_cost[b] -= cost
                    waiting.append(b)
    rest = [a for a, x in enumerate(out) if x is None]
    if rest:
        place = {a: k for k, a in enumerate(rest)}
        links = [(place[a], place[b], cost) for a, b, cost in edges if a != b and cost > 0 and a in place and b in place]
        for a, side in zip(rest, _cut([lean[a] for a in rest], links), strict=True):
            out[a] = side
    return [bool(x) for x in out]


def _cut(lean: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source of a minimum cut; flows go along shortest paths, level by level."""
    n = len(lean)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: int, back: int) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for a, x in enumerate(lean):
        if x > 0:
            arc(source, a, x, 0)
        elif x < 0:
            arc(a, sink, -x, 0)
    for a, b, cost in edges:
        arc(a, b, cost, cost)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        row = deque([source])
        while row:
            a = row.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    row.append(to[e])
        if level[sink] < 0:
            return [level[a] >= 0 for a in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                path, a = [], source
                continue
            while tried[a] < len(out[a]):
                e = out[a][tried[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(out[a]):
                path.append(out[a][tried[a]])
                a = to[path[-1]]
            elif not path:
                break
            else:
                a = to[path.pop() ^ 1]
                tried[a] += 1
