"""Freezing a sample: stratified selection, then exact marginal quotas with the fewest changes.

Rows are aggregated to (stratum, origin) cells in Spark; only cells, whose number does not depend
on the rows, reach the driver. There a cheap pass swaps inside strata, and a maximum flow settles
the rest; the cells' counts go back as a small table and choose rows by windows.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.operators.quota import first_rows, largest_remainder, round_robin, stratified_head

Cell = tuple[tuple, str]
MOST_CELLS = 1_000_000


class Network:
    """Directed graph with capacities; maximum flow by layered breadth-first search and blocking flows, without recursion."""

    def __init__(self, nodes: int) -> None:
        self.arcs: list[list[list[int]]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, room: int) -> tuple[int, int]:
        """An arc; returns its handle."""
        self.arcs[a].append([b, room, len(self.arcs[b])])
        self.arcs[b].append([a, 0, len(self.arcs[a]) - 1])
        return a, len(self.arcs[a]) - 1

    def used(self, handle: tuple[int, int]) -> int:
        """Flow over an arc: the room of its opposite."""
        to, _, back = self.arcs[handle[0]][handle[1]]
        return self.arcs[to][back][1]

    def _layers(self, source: int, sink: int) -> list[int] | None:
        level = [-1] * len(self.arcs)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for b, room, _ in self.arcs[a]:
                if room and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level if level[sink] >= 0 else None

    def fill(self, source: int, sink: int) -> int:
        """Adds as much flow as fits; returns how much."""
        total = 0
        while (level := self._layers(source, sink)) is not None:
            nxt, path = [0] * len(self.arcs), []
            at = source
            while True:
                if at == sink:
                    push = min(self.arcs[a][k][1] for a, k in path)
                    total += push
                    for a, k in path:
                        arc = self.arcs[a][k]
                        arc[1] -= push
                        self.arcs[arc[0]][arc[2]][1] += push
                    cut = next(i for i, (a, k) in enumerate(path) if self.arcs[a][k][1] == 0)
                    at, path = path[cut][0], path[:cut]
                    continue
                while nxt[at] < len(self.arcs[at]):
                    b, room, _ = self.arcs[at][nxt[at]]
                    if room and level[b] == level[at] + 1:
                        path.append((at, nxt[at]))
                        at = b
                        break
                    nxt[at] += 1
                else:
                    if at == source:
                        break
                    at, _ = path.pop()
                    nxt[at] += 1
        return total


def balanced(available: dict[Cell, int], chosen: dict[Cell, int], quotas: dict[str, int]) -> dict[Cell, int]:
    """New counts for each cell: origin totals meet ``quotas``, strata keep their totals if possible, overlap with ``chosen`` is favoured."""
    now = dict(chosen)
    totals: dict[str, int] = {}
    for (_, o), n in now.items():
        totals[o] = totals.get(o, 0) + n
    gap = {o: quotas.get(o, 0) - totals.get(o, 0) for o in sorted({*quotas, *totals})}
    # swaps inside a stratum, against what is free by now
    for (s, o) in sorted(now):
        for other in sorted(gap):
            while gap[o] < 0 < gap[other] and now[(s, o)] and available.get((s, other), 0) > now.get((s, other), 0):
                step = min(-gap[o], gap[other], now[(s, o)], available[(s, other)] - now.get((s, other), 0))
                now[(s, o)] -= step
                now[(s, other)] = now.get((s, other), 0) + step
                gap[o] += step
                gap[other] -= step
    if not any(gap.values()):
        return now
    strata = sorted({s for s, _ in available})
    margins = {s: sum(n for (t, _), n in chosen.items() if t == s) for s in strata}
    return _by_flow(available, chosen, quotas, margins) or _by_flow(available, chosen, quotas, {s: sum(n for (t, _), n in available.items() if t == s) for s in strata}) or _infeasible(quotas)


def _infeasible(quotas: dict[str, int]) -> dict[Cell, int]:
    raise ValueError(f"the rows cannot meet the origin quotas {quotas}")


def _by_flow(available: dict[Cell, int], chosen: dict[Cell, int], quotas: dict[str, int], margins: dict) -> dict[Cell, int] | None:
    """Origins feed strata through cells; arcs of the first choice are filled before the others open."""
    origins, strata = sorted(quotas), sorted(margins)
    node = {("o", o): 1 + i for i, o in enumerate(origins)} | {("s", s): 1 + len(origins) + i for i, s in enumerate(strata)}
    net, sink = Network(len(node) + 2), len(node) + 1
    for o in origins:
        net.add(0, node["o", o], quotas[o])
    for s in strata:
        net.add(node["s", s], sink, margins[s])
    cells = sorted(c for c in available if c[1] in quotas)
    first = {c: net.add(node["o", c[1]], node["s", c[0]], min(available[c], chosen.get(c, 0))) for c in cells}
    sent = net.fill(0, sink)
    more = {c: net.add(node["o", c[1]], node["s", c[0]], available[c] - min(available[c], chosen.get(c, 0))) for c in cells}
    sent += net.fill(0, sink)
    if sent != sum(quotas.values()):
        return None
    return {c: net.used(first[c]) + net.used(more[c]) for c in cells}


def frozen(df: DataFrame, strata: list[str], origin: str, id_col: str, slots: int, mode: str = "round_robin") -> DataFrame:
    """A sample of ``slots`` rows: stratified by ``mode`` (proportional or round_robin), then with exact origin quotas.

    Quotas are the largest remainder of the origins in ``df``. Inside a cell, rows of the first
    selection stay before others come in, both by id. The result is not ordered; sort at the sink.
    """
    first = stratified_head(df, strata, [origin, id_col], slots) if mode == "proportional" else round_robin(df, strata, [origin, id_col], slots).drop("depth")
    sizes = df.groupBy(origin).agg(F.count(F.lit(1)).alias("n"))
    quotas = {r[origin]: int(r["quota"]) for r in largest_remainder(sizes, [origin], "n", slots).collect()}
    marked = df.join(first.select(id_col).withColumn("__first", F.lit(True)), id_col, "left")
    cells = marked.groupBy(*strata, origin).agg(F.count(F.lit(1)).alias("n"), F.count("__first").alias("k")).limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS:
        raise ValueError("too many (stratum, origin) cells for the driver; choose coarser strata")
    available = {(tuple(r[s] for s in strata), r[origin]): int(r["n"]) for r in cells}
    chosen = {(tuple(r[s] for s in strata), r[origin]): int(r["k"]) for r in cells if r["k"]}
    counts = balanced(available, chosen, quotas)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*strata, origin).schema.fields) + ", `__take` long"
    take = df.sparkSession.createDataFrame([(*s, o, n) for (s, o), n in sorted(counts.items(), key=repr) if n], schema)
    marked = marked.withColumn("__late", F.col("__first").isNull())
    return first_rows(marked, [*strata, origin], ["__late", id_col], take, "__take").select(*df.columns)
