"""A linear-chain conditional random field: training by gradient, decoding by Viterbi."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np


class Chain:
    """Emission weights [features, labels] by feature name, transitions [labels, labels], start weights."""

    def __init__(self, labels: Sequence[str], features: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.labels, self.features, self.emit, self.move, self.start = list(labels), features, emit, move, start

    def scores(self, nodes: list[list[str]]) -> np.ndarray:
        """Emission scores [nodes, labels]; unknown features count nothing."""
        known = self.features
        ids, at = [], []
        for i, names in enumerate(nodes):
            for f in names:
                if (k := known.get(f)) is not None:
                    ids.append(k)
                    at.append(i)
        out = np.zeros((len(nodes), len(self.labels)))
        if ids:
            np.add.at(out, at, self.emit[ids])
        return out

    def decode(self, chains: list[list[list[str]]]) -> list[list[str]]:
        """Best label sequence of every chain, all chains advancing together."""
        if not chains:
            return []
        sizes = np.array([len(c) for c in chains])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = self.scores([n for c in chains for n in c])
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        best = self.start + flat[first[order]] if len(order) else np.zeros((0, len(self.labels)))
        back = np.zeros((len(flat), len(self.labels)), np.int16)
        final = np.zeros((len(chains), len(self.labels)))
        for t in range(1, int(sizes.max(initial=0))):
            live = int((sizes[order] > t).sum())
            final[order[live : len(best)]] = best[live:]
            step = best[:live, :, None] + self.move
            at = first[order[:live]] + t
            back[at] = step.argmax(axis=1)
            best = step.max(axis=1) + flat[at]
        final[order[: len(best)]] = best
        out = []
        for i, n in enumerate(sizes.tolist()):
            path = [0] * n
            if n:
                k = int(final[i].argmax())
                for t in range(n - 1, -1, -1):
                    path[t] = k
                    k = int(back[first[i] + t, k])
            out.append([self.labels[k] for k in path])
        return out


def train(chains: list[list[list[str]]], tags: list[list[str]], labels: Sequence[str], rounds: int = 40, rate: float = 0.3, ridge: float = 1e-4, least: int = 2) -> Chain:
    """Maximum conditional likelihood by full-batch adaptive gradient steps; deterministic.

    Features seen fewer than ``least`` times are left out.
    """
    counts = Counter(f for c in chains for n in c for f in n)
    features = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= least))}
    k = len(labels)
    number = {x: i for i, x in enumerate(labels)}
    kept = [(c, t) for c, t in zip(chains, tags) if c]
    kept.sort(key=lambda x: -len(x[0]))
    sizes = np.array([len(c) for c, _ in kept])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    gold = np.array([number[x] for _, t in kept for x in t])
    ids, at, node = [], [], 0
    for c, _ in kept:
        for names in c:
            for f in names:
                if f in features:
                    ids.append(features[f])
                    at.append(node)
            node += 1
    ids, at = np.array(ids, np.int64), np.array(at, np.int64)
    total = node
    # Sums by node and by feature over sorted runs; both are far faster than scattered adds.
    filled, node_runs = np.unique(at, return_index=True)
    by_feature = np.argsort(ids, kind="stable")
    used, feature_runs = np.unique(ids[by_feature], return_index=True)
    emit, move, start = np.zeros((len(features), k)), np.zeros((k, k)), np.zeros(k)
    memory = [np.full_like(x, 1e-8) for x in (emit, move, start)]
    spans = [int((sizes > t).sum()) for t in range(int(sizes.max()))]
    inner = np.ones(total, bool)
    inner[first] = False
    gold_move = np.zeros((k, k))
    np.add.at(gold_move, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    gold_start = np.bincount(gold[first], minlength=k).astype(float)
    one = np.eye(k)[gold]
    for _ in range(rounds):
        flat = np.zeros((total, k))
        flat[filled] = np.add.reduceat(emit[ids], node_runs)
        ahead, behind = np.zeros((total, k)), np.zeros((total, k))
        ahead[first] = start + flat[first]
        for t in range(1, len(spans)):
            p = first[: spans[t]] + t
            prev = ahead[p - 1][:, :, None] + move
            top = prev.max(axis=1)
            ahead[p] = top + np.log(np.exp(prev - top[:, None, :]).sum(axis=1)) + flat[p]
        for t in range(len(spans) - 2, -1, -1):
            p = first[: spans[t + 1]] + t
            nxt = move + (flat[p + 1] + behind[p + 1])[:, None, :]
            top = nxt.max(axis=2)
            behind[p] = top + np.log(np.exp(nxt - top[:, :, None]).sum(axis=2))
        belief = ahead + behind
        norm = belief.max(axis=1)
        norm = norm + np.log(np.exp(belief - norm[:, None]).sum(axis=1))
        belief = np.exp(belief - norm[:, None])
        p = np.flatnonzero(inner)
        pair = np.exp(ahead[p - 1][:, :, None] + move + (flat[p] + behind[p])[:, None, :] - norm[p][:, None, None])
        slope = np.zeros_like(emit)
        slope[used] = np.add.reduceat((belief - one)[at[by_feature]], feature_runs)
        steps = [slope / total + ridge * emit, (pair.sum(axis=0) - gold_move) / total + ridge * move, (belief[first].sum(axis=0) - gold_start) / total + ridge * start]
        for x, g, m in zip((emit, move, start), steps, memory):
            m += g * g
            x -= rate * g / np.sqrt(m)
    return Chain(labels, features, emit, move, start)
