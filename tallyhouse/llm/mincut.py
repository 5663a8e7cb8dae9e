"""Minimum cut of a graph with two terminals (Dinic's blocking flows, iterative)."""

from __future__ import annotations

from collections import deque

EPS = 1e-9


class Cut:
    """``n`` nodes between a source and a sink; ``side()`` tells which stay with the source."""

    def __init__(self, n: int):
        self.n, self.source, self.sink = n, n, n + 1
        self.out: list[list[int]] = [[] for _ in range(n + 2)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.room.append(forth)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def terminal(self, a: int, to_source: float, to_sink: float) -> None:
        """Cost of leaving the source's side, and of leaving the sink's."""
        shared = min(to_source, to_sink)  # paid on any cut
        if to_source > shared:
            self.edge(self.source, a, to_source - shared)
        elif to_sink > shared:
            self.edge(a, self.sink, to_sink - shared)

    def _levels(self) -> list[int]:
        level = [-1] * (self.n + 2)
        level[self.source] = 0
        queue = deque([self.source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] > EPS and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def side(self) -> list[bool]:
        while True:
            level = self._levels()
            if level[self.sink] < 0:
                return [x >= 0 for x in level[: self.n]]
            at = [0] * (self.n + 2)
            path: list[int] = []
            a = self.source
            while True:
                if a == self.sink:
                    flow = min(self.room[e] for e in path)
                    cut = 0
                    for k, e in enumerate(path):
                        self.room[e] -= flow
                        self.room[e ^ 1] += flow
                    cut = next(k for k, e in enumerate(path) if self.room[e] <= EPS)
                    a = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                edges = self.out[a]
                while at[a] < len(edges):
                    e = edges[at[a]]
                    if self.room[e] > EPS and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(edges):
                    path.append(edges[at[a]])
                    a = self.to[path[-1]]
                elif path:
                    e = path.pop()
                    a = self.to[e ^ 1]
                    at[a] += 1
                else:
                    break
