"""A generative model of voters: how far each can be trusted, and which vote together.

Each document has a hidden class. Voters say 1, 0 or nothing (-1), with probabilities that
depend on the class. Voters that agree more than the first guess at the class explains are joined to a
clique, whose votes have one table of probabilities together. The model is then estimated by
expectation-maximisation from the counts of vote patterns alone, so it sees all documents
at the cost of one small table.
"""

import numpy as np

SMOOTHING = 0.5
ROUNDS = 100
RELATED = 0.2
#: Voters in a clique at most, and cliques kept at least: fewer than three tell nothing of a class.
CLIQUE, LEAST_CLIQUES = 3, 4


class LabelModel:
    def __init__(self, patterns, counts, anchors, rounds=ROUNDS, related=RELATED):
        """`patterns`: one row for each vote pattern; `anchors`: a first guess at each one's posterior."""
        self.patterns = np.asarray(patterns, np.int64).reshape(len(counts), -1)
        self.counts = np.asarray(counts, float)
        self.posterior = np.asarray(anchors, float)
        voters = range(self.patterns.shape[1])
        # judged before the fit: voters that copy one another would be taken for the class itself
        self.cliques = self._related(related)
        self._estimate(rounds)
        votes, p = self.patterns, self.posterior
        said = [np.where(votes[:, v] == 1, p, 1 - p)[votes[:, v] >= 0] for v in voters]
        cast = [self.counts[votes[:, v] >= 0] for v in voters]
        #: share of its votes that each voter is expected to have right
        self.accuracies = [float(np.average(s, weights=c)) if c.sum() else 0.5 for s, c in zip(said, cast)]

    def _codes(self, clique):
        """The joint vote of a clique as one number."""
        code = np.zeros(len(self.patterns), np.int64)
        for v in clique:
            code = code * 3 + self.patterns[:, v] + 1
        return np.unique(code, return_inverse=True)

    def _estimate(self, rounds):
        codes = [self._codes(c) for c in self.cliques]
        for _ in range(rounds if len(self.counts) else 0):
            weight = np.stack([self.counts * (1 - self.posterior), self.counts * self.posterior])
            odds = np.log((weight[1].sum() + SMOOTHING) / (weight[0].sum() + SMOOTHING))
            odds = np.full(len(self.counts), odds)
            for values, code in codes:
                table = np.stack([np.bincount(code, w, len(values)) + SMOOTHING for w in weight])
                table /= table.sum(1, keepdims=True)
                odds += np.log(table[1] / table[0])[code]
            fresh = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
            moved = np.abs(fresh - self.posterior).max()
            self.posterior = fresh
            if moved < 1e-7:
                break

    def _related(self, limit):
        """Voters joined by correlations that the class leaves unexplained."""
        votes, n = self.patterns.astype(float), self.counts.sum()
        left = np.zeros_like(votes)
        for share in (self.posterior, 1 - self.posterior):
            weight = self.counts * share
            if weight.sum():
                left += share[:, None] * np.average(votes, axis=0, weights=weight)
        residual = votes - left
        cover = (residual * self.counts[:, None]).T @ residual / max(n, 1)
        spread = np.sqrt(np.maximum(np.diag(cover), 1e-12))
        self.correlations = cover / np.outer(spread, spread)
        group = list(range(votes.shape[1]))
        pairs = [(a, b) for a in group for b in range(a) if self.correlations[a, b] > limit]
        for a, b in sorted(pairs, key=lambda ab: -self.correlations[ab]):
            together = sum(g in (group[a], group[b]) for g in group)
            if group[a] != group[b] and together <= CLIQUE and len(set(group)) > LEAST_CLIQUES:
                group = [group[b] if g == group[a] else g for g in group]
        return [[v for v in range(len(group)) if group[v] == g] for g in sorted(set(group))]
