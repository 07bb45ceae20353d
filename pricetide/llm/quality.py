"""Text quality by logistic regression over hashed word n-grams.

N-grams of one and two words are taken from the words, lower-cased, and one to three from
their shapes (runs of small letters, capitals and digits shrink to one sign, all others
stand for themselves) and from the marks "like the word before", which tell repetition in
words never seen. A feature's value is its share of the words of the text, so a score is a
sparse dot product summed over the words.
"""

import numpy as np

from pricetide.llm.learning import fit, labelled_sample, scored
from pricetide.llm.words import mix, pieces, running_hash, span_hashes, word_bounds

BITS = 18
SAMPLE_ROWS = 8192
EPOCHS = 3
THRESHOLD = 0.3
_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def shape_hashes(data, starts, ends):
    """Hash of each word's shape."""
    shape = _SHAPE[data]
    kept = np.ones(len(data), bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[starts] = True
    places = np.concatenate([[0], np.cumsum(kept)])
    return span_hashes(running_hash(shape[kept], lower=False), places[starts], places[ends])


def runs(tokens, of_text, size, kind):
    """(index, text) of the n-grams of `size` tokens."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.full(n, _U(1000 * kind + size))
    for k in range(size):
        total = mix(total * _STEP + tokens[k : k + n])
    inside = of_text[:n] == of_text[size - 1 :]
    return (total[inside] >> _U(64 - BITS)).astype(np.int64), of_text[:n][inside]


def occurrences(data, offsets):
    """(index, text) of every feature of a piece, and the number of words of each text."""
    with np.errstate(over="ignore"):
        starts, ends, firsts = word_bounds(data, offsets)
        counts = np.diff(firsts)
        of_text = np.repeat(np.arange(len(counts)), counts)
        words = span_hashes(running_hash(data), starts, ends)
        shapes = shape_hashes(data, starts, ends)
        again = np.zeros(len(words), np.uint64)
        again[1:] = (words[1:] == words[:-1]) & (of_text[1:] == of_text[:-1])
        found = [runs(words, of_text, k, 1) for k in (1, 2)]
        found += [runs(shapes, of_text, k, 2) for k in (1, 2, 3)]
        found += [runs(again, of_text, k, 3) for k in (1, 2, 3)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), counts


def features(column):
    for _, data, offsets in pieces(column):
        index, of_text, counts = occurrences(data, offsets)
        order = np.argsort(of_text, kind="stable")
        index = index[order]
        bounds = np.searchsorted(of_text[order], np.arange(len(counts) + 1))
        for i, words in enumerate(counts):
            found, times = np.unique(index[bounds[i] : bounds[i + 1]], return_counts=True)
            yield found, times / max(words, 1)


def scorer(weights):
    def score(column):
        parts = [np.zeros(0)]
        for _, data, offsets in pieces(column):
            index, of_text, counts = occurrences(data, offsets)
            total = np.bincount(of_text, weights[index], len(counts)) / np.maximum(counts, 1) + weights[-1]
            parts.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return np.concatenate(parts)

    return score


def quality_scores(docs, labels, rows=SAMPLE_ROWS, threshold=THRESHOLD, text="text", key="doc_id", label="quality"):
    """A quality score for every row of `docs`: doc_id, held_out, score, predicted.

    Learned from at most `rows` labelled documents (see `labelled_sample`); the label, the
    text and the fold of the id are all that is used. A text without words (null, empty,
    white space) gets the score of the bias alone. Without labels every score is 0.5. Rows
    that repeat an id are scored each; a null id is scored too and not held out.
    """
    weights = fit(
        labelled_sample(docs, labels, label, rows, text, key), features, 1 << BITS, EPOCHS, alpha=2.0, l1=0.02, l2=0.05
    )
    return scored(docs, scorer(weights), threshold, text, key)
