"""Plain, single-machine restatement of the published algorithm, for small fixtures."""

from __future__ import annotations

import numpy as np


def core_and_reach(x: np.ndarray, k: int):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    off = d + np.where(np.eye(len(x)) > 0, np.inf, 0)
    core = np.sort(off, axis=1)[:, k - 1]
    reach = np.maximum(np.maximum(core[:, None], core[None, :]), d)
    np.fill_diagonal(reach, np.inf)
    return core, reach


def tree_weight(reach: np.ndarray) -> float:
    n = len(reach)
    best, out, total = reach[0].copy(), np.ones(n, bool), 0.0
    out[0] = False
    for _ in range(n - 1):
        at = int(np.argmin(np.where(out, best, np.inf)))
        total += best[at]
        out[at] = False
        best = np.minimum(best, reach[at])
    return total


def _parts(members: np.ndarray, reach: np.ndarray, below: float):
    """Connected components of the members through distances smaller than `below`."""
    left, parts = set(members.tolist()), []
    while left:
        todo, part = [left.pop()], []
        while todo:
            p = todo.pop()
            part.append(p)
            near = [q for q in left if reach[p, q] < below]
            left.difference_update(near)
            todo.extend(near)
        parts.append(np.array(sorted(part)))
    return parts


def hdbscan(x: np.ndarray, m: int) -> list[int]:
    """Labels: -1 for noise, clusters numbered by first member. Ties split at once."""
    _, reach = core_and_reach(x, min(m, len(x) - 1))
    nodes = []  # dicts: members, birth distance, stability, children

    def grow(members: np.ndarray, birth: float) -> int:
        """Follow one cluster down to its death, then its children."""
        node = {"members": members, "children": [], "stability": 0.0}
        nodes.append(node)
        me = len(nodes) - 1
        lam_birth = 1.0 / birth if np.isfinite(birth) else 0.0
        now = members
        while True:
            # Largest distance that holds the current component together.
            level = _connecting(now, reach)
            if level is None:
                break
            parts = _parts(now, reach, level)
            big = [p for p in parts if len(p) >= m]
            lam = 1.0 / max(level, 1e-150)
            if len(big) == 1:
                node["stability"] += (len(now) - len(big[0])) * (lam - lam_birth)
                now = big[0]
                continue
            node["stability"] += len(now) * (lam - lam_birth)
            if len(big) > 1:
                for part in big:
                    node["children"].append(grow(part, level))
            break
        return me

    grow(np.arange(len(x)), np.inf)
    chosen = [False] * len(nodes)
    value = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        inner = sum(value[c] for c in nodes[i]["children"])
        chosen[i] = inner <= nodes[i]["stability"] * (1 + 1e-9)
        value[i] = max(inner, nodes[i]["stability"])
    label = np.full(len(x), -1)

    def assign(i: int):
        if i and chosen[i]:
            label[nodes[i]["members"]] = i
        else:
            for c in nodes[i]["children"]:
                assign(c)

    assign(0)
    return renumber(label)


def _connecting(members: np.ndarray, reach: np.ndarray):
    """Smallest distance at which the members are connected; None for a single row."""
    if len(members) < 2:
        return None
    sub = reach[np.ix_(members, members)]
    best, out, worst = sub[0].copy(), np.ones(len(members), bool), 0.0
    out[0] = False
    for _ in range(len(members) - 1):
        at = int(np.argmin(np.where(out, best, np.inf)))
        worst = max(worst, best[at])
        out[at] = False
        best = np.minimum(best, sub[at])
    return worst


def renumber(label) -> list[int]:
    seen: dict[int, int] = {}
    return [-1 if c == -1 else seen.setdefault(int(c), len(seen)) for c in label]
