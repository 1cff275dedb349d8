"""Minimum-cost flow from membership patterns to source quotas."""

from __future__ import annotations

from collections import deque
from collections.abc import Hashable, Sequence


class Network:
    """Arcs with whole capacities and costs; an arc and its reverse are neighbours in the lists."""

    def __init__(self) -> None:
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.arcs: list[list[int]] = []

    def node(self) -> int:
        self.arcs.append([])
        return len(self.arcs) - 1

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for tail, head, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[tail].append(len(self.head))
            self.head.append(head)
            self.room.append(r)
            self.cost.append(c)
        return len(self.head) - 2

    def _distances(self, source: int) -> list[float]:
        """Least cost of a way from ``source`` to each node; costs of reverse arcs may be negative."""
        least = [float("inf")] * len(self.arcs)
        least[source] = 0
        queue, waiting = deque([source]), {source}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in self.arcs[a]:
                b = self.head[e]
                if self.room[e] and least[a] + self.cost[e] < least[b]:
                    least[b] = least[a] + self.cost[e]
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        return least

    def _layers(self, source: int, least: list[float]) -> list[int]:
        """Steps from ``source`` over cheapest ways only."""
        steps = [-1] * len(self.arcs)
        steps[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.arcs[a]:
                b = self.head[e]
                if self.room[e] and steps[b] < 0 and least[a] + self.cost[e] == least[b]:
                    steps[b] = steps[a] + 1
                    queue.append(b)
        return steps

    def _push(self, source: int, sink: int, steps: list[int], least: list[float]) -> None:
        """A blocking flow over the layers."""
        at = [0] * len(self.arcs)
        way: list[int] = []
        a = source
        while True:
            if a == sink:
                much = min(self.room[e] for e in way)
                cut = len(way)
                for i, e in enumerate(way):
                    self.room[e] -= much
                    self.room[e ^ 1] += much
                    if not self.room[e]:
                        cut = min(cut, i)
                a = self.head[way[cut] ^ 1]
                del way[cut:]
                continue
            while at[a] < len(self.arcs[a]):
                e = self.arcs[a][at[a]]
                b = self.head[e]
                if self.room[e] and steps[b] == steps[a] + 1 and least[a] + self.cost[e] == least[b]:
                    way.append(e)
                    a = b
                    break
                at[a] += 1
            else:
                if a == source:
                    return
                steps[a] = -1
                a = self.head[way.pop() ^ 1]

    def run(self, source: int, sink: int) -> None:
        """The largest flow, and of these the cheapest: one cost of the cheapest way after the other."""
        while True:
            least = self._distances(source)
            if least[sink] == float("inf"):
                return
            while True:
                steps = self._layers(source, least)
                if steps[sink] < 0:
                    break
                self._push(source, sink, steps, least)


def route(patterns: Sequence[tuple[Sequence[Hashable], int]], quotas: dict[Hashable, int], repeats: int = 3) -> list[dict[Hashable, int]]:
    """How many words of each pattern (its sources, its words) go to each of its sources.

    The n-th use of a word costs n - 1, up to ``repeats`` uses: costs are convex, so
    nothing is used again before all that can take its place has been used.
    Quotas are met as far as the patterns reach, then at least cost.
    """
    net = Network()
    start, end = net.node(), net.node()
    gate = {}
    for s, quota in quotas.items():
        gate[s] = net.node()
        net.arc(gate[s], end, quota)
    ways = []
    for members, words in patterns:
        here = net.node()
        for use in range(repeats):
            net.arc(start, here, words, use)
        ways.append({s: net.arc(here, gate[s], repeats * words) for s in members})
    net.run(start, end)
    return [{s: net.room[e ^ 1] for s, e in way.items()} for way in ways]
