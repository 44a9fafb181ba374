"""Brute-force reference answers for small graph fixtures (pure Python)."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict, deque


def pagerank(nodes, edges, alpha=0.85, iters=100):
    n = len(nodes)
    out = defaultdict(float)
    for u, v, w in edges:
        out[u] += w
    x = {v: 1.0 / n for v in nodes}
    for _ in range(iters):
        nx_ = {v: 0.0 for v in nodes}
        dang = sum(x[v] for v in nodes if out[v] == 0)
        for u, v, w in edges:
            if out[u] > 0:
                nx_[v] += alpha * x[u] * w / out[u]
        x = {v: nx_[v] + alpha * dang / n + (1 - alpha) / n for v in nodes}
    return x


def closeness(nodes, edges):
    n = len(nodes)
    rev = defaultdict(set)
    for u, v, _ in edges:
        if u != v:
            rev[v].add(u)
    res = {}
    for t in nodes:
        dist = {t: 0}
        q = deque([t])
        while q:
            x = q.popleft()
            for y in rev[x]:
                if y not in dist:
                    dist[y] = dist[x] + 1
                    q.append(y)
        tot = sum(dist.values())
        r = len(dist)
        res[t] = (r - 1) / tot * (r - 1) / (n - 1) if tot > 0 and n > 1 else 0.0
    return res


def betweenness(nodes, edges):
    adj = defaultdict(list)
    for u, v, w in edges:
        if u != v:
            adj[u].append((v, w))
    bc = {v: 0.0 for v in nodes}
    for s in nodes:
        dist, sigma, preds, order = {}, defaultdict(float), defaultdict(list), []
        seen = {s: 0.0}
        sigma[s] = 1.0
        heap = [(0.0, s)]
        while heap:
            d, v = heapq.heappop(heap)
            if v in dist:
                continue
            dist[v] = d
            order.append(v)
            for w, wt in adj[v]:
                vw = d + wt
                if w not in dist and (w not in seen or vw < seen[w]):
                    seen[w] = vw
                    heapq.heappush(heap, (vw, w))
                    sigma[w] = sigma[v]
                    preds[w] = [v]
                elif w in seen and vw == seen[w] and w not in dist:
                    sigma[w] += sigma[v]
                    preds[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in preds[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    n = len(nodes)
    scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {v: b * scale for v, b in bc.items()}


def undirected(edges):
    und = set()
    for u, v, _ in edges:
        if u != v:
            und.add((min(u, v), max(u, v)))
    return und


def clustering(nodes, edges):
    nb = defaultdict(set)
    for a, b in undirected(edges):
        nb[a].add(b)
        nb[b].add(a)
    res = {}
    for v in nodes:
        d = len(nb[v])
        if d < 2:
            res[v] = 0.0
            continue
        t = sum(1 for x in nb[v] for y in nb[v] if x < y and y in nb[x])
        res[v] = 2.0 * t / (d * (d - 1))
    return res


def _components(nodes, und):
    nb = defaultdict(set)
    for a, b in und:
        nb[a].add(b)
        nb[b].add(a)
    seen, count = set(), 0
    for v in nodes:
        if v in seen:
            continue
        count += 1
        stack = [v]
        seen.add(v)
        while stack:
            x = stack.pop()
            for y in nb[x]:
                if y not in seen:
                    seen.add(y)
                    stack.append(y)
    return count


def bridges(nodes, edges):
    und = undirected(edges)
    base = _components(nodes, und)
    return {e for e in und if _components(nodes, und - {e}) > base}


def articulation_points(nodes, edges):
    und = undirected(edges)
    out = set()
    for v in nodes:
        rest = [x for x in nodes if x != v]
        sub = {e for e in und if v not in e}
        touched = any(v in e for e in und)
        if touched and _components(rest, sub) > _components(nodes, und) - (0 if touched else 1):
            out.add(v)
    return out


def modularity(edges, community):
    """Q on the undirected weighted graph (reciprocal weights summed, loops dropped)."""
    w = defaultdict(float)
    for u, v, wt in edges:
        if u != v:
            w[(min(u, v), max(u, v))] += wt
    m = sum(w.values())
    if m == 0:
        return 0.0
    deg = defaultdict(float)
    inside = defaultdict(float)
    for (a, b), wt in w.items():
        deg[a] += wt
        deg[b] += wt
        if community[a] == community[b]:
            inside[community[a]] += wt
    tot = defaultdict(float)
    for v, d in deg.items():
        tot[community[v]] += d
    return sum(inside[c] / m - (tot[c] / (2 * m)) ** 2 for c in tot)


def isclose(a, b, tol=1e-9):
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)
