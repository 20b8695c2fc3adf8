"""A small min-cost flow: capacities of document patterns to quotas of sources."""

from __future__ import annotations

import heapq


def route(
    capacity: list[int], members: list[list[int]], quota: list[int], epochs: int
) -> list[list[int]]:
    """Words each pattern gives to each of its sources, as rows by pattern.

    A pattern's words can be used up to ``epochs`` times; the k-th use of a word
    costs k * k, a convex price, so every word is used once before any that could
    serve the same quota is used again. Successive shortest paths with potentials.
    The flow fills as much of the quotas as the patterns allow, at the least cost.
    """
    given = [[0] * len(m) for m in members]
    for group in linked_patterns(members):
        _augment(group, capacity, members, quota, epochs, given)
    return given


def linked_patterns(members: list[list[int]]) -> list[list[int]]:
    """Patterns in groups that share sources, directly or by others of the group.

    No words flow between groups, so each is a flow of its own.
    """
    users: dict[int, list[int]] = {}
    for p, own in enumerate(members):
        for s in own:
            users.setdefault(s, []).append(p)
    groups, seen = [], [False] * len(members)
    for first in range(len(members)):
        if seen[first]:
            continue
        seen[first] = True
        group = [first]
        for p in group:
            for s in members[p]:
                for other in users.pop(s, []):
                    if not seen[other]:
                        seen[other] = True
                        group.append(other)
        groups.append(sorted(group))
    return groups


def _augment(
    patterns: list[int],
    capacity: list[int],
    members: list[list[int]],
    quota: list[int],
    epochs: int,
    given: list[list[int]],
) -> None:
    graph: dict[str, list[list]] = {}

    def arc(a: str, b: str, room: int, cost: int) -> list:
        forth, back = [b, room, cost, None], [a, 0, -cost, None]
        forth[3], back[3] = back, forth
        graph.setdefault(a, []).append(forth)
        graph.setdefault(b, []).append(back)
        return forth

    given_arcs = []
    for p in patterns:
        for k in range(1, epochs + 1):
            arc("start", f"p{p}", capacity[p], k * k)
        for place, s in enumerate(members[p]):
            given_arcs.append((p, place, arc(f"p{p}", f"s{s}", epochs * capacity[p], 0)))
    for s in sorted({s for p in patterns for s in members[p]}):
        arc(f"s{s}", "end", quota[s], 0)
    potential = dict.fromkeys(graph, 0)
    while True:
        distance, came = {"start": 0}, {}
        heap = [(0, "start")]
        while heap:
            d, a = heapq.heappop(heap)
            if d > distance[a]:
                continue
            for edge in graph[a]:
                b, room, cost, _ = edge
                if room > 0:
                    reach = d + cost + potential[a] - potential[b]
                    if reach < distance.get(b, reach + 1):
                        distance[b] = reach
                        came[b] = edge
                        heapq.heappush(heap, (reach, b))
        if "end" not in distance:
            break
        for node, d in distance.items():
            potential[node] += min(d, distance["end"])
        for node in graph:
            if node not in distance:
                potential[node] += distance["end"]
        path, node = [], "end"
        while node != "start":
            path.append(came[node])
            node = came[node][3][0]
        amount = min(edge[1] for edge in path)
        for edge in path:
            edge[1] -= amount
            edge[3][1] += amount
    for p, place, edge in given_arcs:
        given[p][place] = edge[3][1]
