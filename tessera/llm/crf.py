"""A skip-chain conditional random field over the tokens of documents.

Nodes are tokens; their labels are "outside" or the beginning / inside of an entity of
some kind. Chain edges join neighbours, skip edges join distant tokens of a document
that repeat or resemble each other; all edges of a sort share one table of potentials.
Marginals come from loopy belief propagation: all messages of all documents at hand are
passed at once, in numpy, until they settle or for a fixed number of rounds. Weights are fitted by gradient
ascent on the likelihood with those marginals.

Label 0 is "outside"; label 1 + 2 k begins and 2 + 2 k continues an entity of kind k.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

NEVER = -1e4
SETTLED = 1e-4


@dataclass
class Graph:
    """Tokens of any number of documents: feature ids of each token (the same number for
    all), whether a token opens a chain, chain edges (left, right), skip edges (earlier,
    later, sort)."""
    features: np.ndarray
    opens: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def slices(n: int, size: int):
    return (slice(low, min(n, low + size)) for low in range(0, n, size))


@dataclass
class SkipChain:
    """Weights: per feature and label, per feature and kind (shared by beginning and
    inside), per pair of neighbouring labels, and per sort of skip edge a value for
    agreeing on "outside" and one for agreeing on a kind."""
    n_kinds: int
    n_features: int
    n_sorts: int
    rounds: int = 12
    weights: dict = field(default_factory=dict)

    def __post_init__(self):
        labels = 1 + 2 * self.n_kinds
        self.kind = np.array([0] + [1 + k // 2 for k in range(2 * self.n_kinds)])
        self.inside = np.array([False] + [bool(k % 2) for k in range(2 * self.n_kinds)])
        same = self.kind[:, None] == self.kind[None, :]
        self.allowed = np.where(self.inside[None, :] & ~same, NEVER, 0.0)
        self.agree_out = np.zeros((labels, labels))
        self.agree_out[0, 0] = 1
        self.agree_kind = same.astype(float) - self.agree_out
        if not self.weights:
            self.weights = {"label": np.zeros((self.n_features, labels)), "kind": np.zeros((self.n_features, self.n_kinds + 1)),
                            "next": np.zeros((labels, labels)), "skip": np.zeros((self.n_sorts, 2))}

    def _potentials(self, graph: Graph, at_once: int = 1 << 62):
        w = self.weights["label"] + self.weights["kind"][:, self.kind]
        unary = np.zeros((len(graph.features), len(self.kind)))
        for s in slices(len(unary), at_once):
            unary[s] = w[graph.features[s]].sum(axis=1)
        unary = unary + np.where(graph.opens[:, None] & self.inside[None, :], NEVER, 0.0)
        tables = [self.weights["next"] + self.allowed]
        tables += [a * self.agree_out + b * self.agree_kind for a, b in self.weights["skip"]]
        left = np.concatenate([graph.chain[:, 0], graph.skip[:, 0]])
        right = np.concatenate([graph.chain[:, 1], graph.skip[:, 1]])
        sort = np.concatenate([np.zeros(len(graph.chain), int), 1 + graph.skip[:, 2]])
        return unary, np.stack(tables), left, right, sort

    def infer(self, graph: Graph, at_once: int = 1 << 62, pairs: bool = True):
        """(marginals of every token, marginals of every edge with its sort). Tables of
        labels by labels are held for ``at_once`` edges at a time, which changes no result;
        without ``pairs`` the marginals of edges are left out."""
        unary, tables, left, right, sort = self._potentials(graph, at_once)
        n, labels = unary.shape
        e = len(left)
        to_right, to_left = np.zeros((e, labels)), np.zeros((e, labels))

        def beliefs():
            out = unary.copy()
            for k in range(labels if e else 0):
                out[:, k] += np.bincount(right, to_right[:, k], n) + np.bincount(left, to_left[:, k], n)
            return out

        for _ in range(self.rounds if e else 0):
            b, moved = beliefs(), 0.0
            for s in slices(e, at_once):  # beliefs are those before the round, so edges do not wait for each other
                table = tables[sort[s]]
                new_right = log_sum((b[left[s]] - to_left[s])[:, :, None] + table, 1)
                new_left = log_sum((b[right[s]] - to_right[s])[:, None, :] + table, 2)
                new_right -= log_sum(new_right, 1)[:, None]
                new_left -= log_sum(new_left, 1)[:, None]
                moved = max(moved, np.abs(new_right - to_right[s]).max(), np.abs(new_left - to_left[s]).max())
                to_right[s], to_left[s] = new_right, new_left
            if moved < SETTLED:
                break
        b = beliefs()
        nodes = np.exp(b - log_sum(b, 1)[:, None])
        if not pairs:
            return nodes, None, sort
        table = tables[sort]
        pair = (b[left] - to_left)[:, :, None] + (b[right] - to_right)[:, None, :] + table
        pair = np.exp(pair - log_sum(pair.reshape(e, labels * labels), 1)[:, None, None]) if e else pair
        return nodes, pair, sort

    def fit(self, graph: Graph, labels: np.ndarray, steps: int = 150, rate: float = 0.1, decay: float = 1e-4) -> SkipChain:
        """Adam on the mean log likelihood less ``decay`` times the squared weights."""
        n, n_labels = len(labels), len(self.kind)
        if not n:
            return self
        truth = np.zeros((n, n_labels))
        truth[np.arange(n), labels] = 1
        kinds = np.zeros((n_labels, self.n_kinds + 1))
        kinds[np.arange(n_labels), self.kind] = 1
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        flat = graph.features.ravel()
        for t in range(1, steps + 1):
            nodes, pair, sort = self.infer(graph)
            off = np.repeat(truth - nodes, graph.features.shape[1], axis=0)
            by_label = np.stack([np.bincount(flat, off[:, k], self.n_features) for k in range(n_labels)], 1)
            left = np.concatenate([graph.chain[:, 0], graph.skip[:, 0]])
            right = np.concatenate([graph.chain[:, 1], graph.skip[:, 1]])
            both = -pair
            if len(left):
                np.add.at(both, (np.arange(len(left)), labels[left], labels[right]), 1)
            by_sort = [both[sort == s].sum(axis=0) for s in range(1 + self.n_sorts)]
            slope = {"label": by_label, "kind": by_label @ kinds, "next": by_sort[0],
                     "skip": np.array([[(g * self.agree_out).sum(), (g * self.agree_kind).sum()] for g in by_sort[1:]]).reshape(self.n_sorts, 2)}
            for k, w in self.weights.items():
                g = slope[k] / n - 2 * decay * w
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w += rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        return self
