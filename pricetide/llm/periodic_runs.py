"""Periodic runs of words, found with suffix trees of a text and of its reversal.

Ukkonen's construction gives both trees. The depths met on an Euler tour answer, by a
range-minimum table, how far two places agree: the lowest common ancestor of two leaves, in
constant time. The order of the leaves gives the longest Lyndon word at every place, for the
order of the words and for its inverse. Each run has such a word as its root, so every
Lyndon word is a candidate: it is extended forwards by the tree of the text and backwards by
that of the reversal, and what reaches enough periods is a run.

A run of k periods holds each of its words k times. A text is therefore first cut at words
that occur more rarely in their stretch, until nothing is cut any more; the stretches long
enough to hold a run get their trees, no run lies across a cut.
"""

import hashlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.shipping import map_batches

LEAST_WORDS = 24
LEAST_PERIODS = 3
ROWS_AT_ONCE = 500
BLOCK = 16
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class SuffixTree:
    """Ukkonen's tree of a list of symbols from 1 on; 0 ends it.

    Edge labels are spans of the symbols, node 0 is the root, leaves have no children.
    """

    def __init__(self, symbols):
        self.symbols = s = [*symbols, 0]
        size = len(s)
        starts, ends, links, children = [0], [0], [0], [{}]
        node, edge, length, waiting = 0, 0, 0, 0
        for at, symbol in enumerate(s):
            unlinked = 0
            waiting += 1
            while waiting:
                if not length:
                    edge = at
                below = children[node]
                child = below.get(s[edge])
                if child is None:
                    below[s[edge]] = len(starts)
                    starts.append(at)
                    ends.append(size)
                    links.append(0)
                    children.append(None)
                    if unlinked:
                        links[unlinked] = node
                        unlinked = 0
                else:
                    begin = starts[child]
                    span = ends[child] - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[begin + length] == symbol:
                        if unlinked:
                            links[unlinked] = node
                        length += 1
                        break
                    # cut the edge and hang a leaf on the new node
                    middle = len(starts)
                    starts += [begin, at]
                    ends += [begin + length, size]
                    links += [0, 0]
                    children += [{s[begin + length]: child, symbol: middle + 1}, None]
                    below[s[edge]] = middle
                    starts[child] = begin + length
                    if unlinked:
                        links[unlinked] = middle
                    unlinked = middle
                waiting -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1
        self.starts, self.ends, self.children = starts, ends, children

    def tour(self):
        """Depths in symbols along an Euler tour, where each suffix's leaf stands, and the suffixes in order."""
        starts, ends, children, size = self.starts, self.ends, self.children, len(self.symbols)
        depth = [0] * len(starts)
        depths, place, order, todo = [], [0] * size, [], [0]
        while todo:
            node = todo.pop()
            if node < 0:
                depths.append(depth[~node])
                continue
            here = depth[node]
            below = children[node]
            if below is None:
                suffix = size - here
                place[suffix] = len(depths)
                order.append(suffix)
                depths.append(here)
                continue
            depths.append(here)
            back = ~node
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                depth[child] = here + ends[child] - starts[child]
                todo += (back, child)
        return np.array(depths, np.int64), np.array(place, np.int64), order

    def inverse_order(self):
        """The suffixes in the order of the inverse alphabet; an end stays before everything."""
        starts, ends, children, size = self.starts, self.ends, self.children, len(self.symbols)
        order, todo = [], [(0, 0)]
        while todo:
            node, here = todo.pop()
            below = children[node]
            if below is None:
                order.append(size - here)
                continue
            symbols = sorted(below)
            if symbols[0] == 0:
                symbols = [*symbols[1:], 0]
            for symbol in symbols:
                child = below[symbol]
                todo.append((child, here + ends[child] - starts[child]))
        return order


class RangeMinimum:
    """Minima of any spans of an array, in constant time each and linear memory.

    Minima from and to each place inside blocks of `BLOCK`, and a sparse table over blocks.
    """

    def __init__(self, values):
        self.values = values
        rows = -(-len(values) // BLOCK)
        padded = np.full(rows * BLOCK, np.iinfo(np.int64).max)
        padded[: len(values)] = values
        padded = padded.reshape(rows, BLOCK)
        self.upto = np.minimum.accumulate(padded, 1).ravel()
        self.onward = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [padded.min(1)]
        width = 1
        while 2 * width <= rows:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, first, last):
        """Minimum from `first` to `last`, both included, for arrays of places."""
        low, high = first // BLOCK, last // BLOCK
        result = np.minimum(self.onward[first], self.upto[last])
        near = np.flatnonzero(low == high)
        if len(near):
            a, b = first[near], last[near]
            found = self.values[a]
            for step in range(1, BLOCK):
                found = np.minimum(found, self.values[np.minimum(a + step, b)])
            result[near] = found
        inner = high - low - 1
        for level in range(len(self.table)):
            these = np.flatnonzero((inner >> level) == 1)
            if len(these):
                table, a, b = self.table[level], low[these] + 1, high[these] - (1 << level)
                result[these] = np.minimum(result[these], np.minimum(table[a], table[b]))
        return result


class CommonExtension:
    """How many symbols two suffixes of a text share."""

    def __init__(self, tree):
        depths, self.place, self.order = tree.tour()
        self.minimum = RangeMinimum(depths)

    def of(self, one, two):
        a, b = self.place[one], self.place[two]
        return self.minimum.of(np.minimum(a, b), np.maximum(a, b))


def lyndon_ends(order):
    """For each place the next one whose suffix comes earlier, which ends the longest Lyndon word there."""
    size = len(order) - 1
    rank = [0] * (size + 1)
    for at, suffix in enumerate(order):
        rank[suffix] = at
    ends = [size] * size
    behind = [size]
    for place in range(size - 1, -1, -1):
        mine = rank[place]
        while rank[behind[-1]] > mine:
            behind.pop()
        ends[place] = behind[-1]
        behind.append(place)
    return np.array(ends, np.int64)


def runs_of(symbols, least_words=LEAST_WORDS, least_periods=LEAST_PERIODS):
    """Sorted (start, length, period) of the runs of a list of symbols from 1 on."""
    size = len(symbols)
    tree = SuffixTree(symbols)
    forwards = CommonExtension(tree)
    ends = [lyndon_ends(forwards.order), lyndon_ends(tree.inverse_order())]
    del tree
    backwards = CommonExtension(SuffixTree(symbols[::-1]))
    places = np.arange(size)
    found = set()
    for end in ends:
        period = end - places
        # the first root of a run has a whole period behind it
        at = np.flatnonzero((end < size) & (period * least_periods <= size))
        period = period[at]
        ahead = forwards.of(at, at + period)
        before = backwards.of(size - at, size - at - period)
        length = ahead + period + before
        good = length >= np.maximum(least_words, period * least_periods)
        found.update(zip((at - before)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(words, least_words, least_periods):
    """(start, end) of the spans whose words all occur often enough inside them to be in a run."""
    todo, whole = [(0, len(words))], []
    while todo:
        first, last = todo.pop()
        if last - first < least_words:
            continue
        span = words[first:last]
        counts = np.fromiter(map(Counter(span).__getitem__, span), np.int64, len(span))
        rare = np.flatnonzero(counts < least_periods)
        if not len(rare):
            whole.append((first, last))
            continue
        edges = np.concatenate([[-1], rare, [len(span)]])
        for k in np.flatnonzero(np.diff(edges) > least_words):
            todo.append((first + int(edges[k]) + 1, first + int(edges[k + 1])))
    return sorted(whole)


def runs_of_words(words, least_words=LEAST_WORDS, least_periods=LEAST_PERIODS):
    """Sorted (start, length, period) of the runs of a list of words."""
    found = []
    for first, last in stretches(words, least_words, least_periods):
        span = words[first:last]
        # numbered in the order in which they come up; any order of the words gives the same runs
        numbers = {word: k for k, word in enumerate(dict.fromkeys(span), 1)}
        runs = runs_of([numbers[w] for w in span], least_words, least_periods)
        found += [(first + start, length, period) for start, length, period in runs]
    return found


def collapsed(words, runs):
    """The words without those that lie in a run behind its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


def _hex(content):
    return hashlib.sha256(content).hexdigest()


def periodic_runs(docs, text="text", key="doc_id", least_words=LEAST_WORDS, least_periods=LEAST_PERIODS, digests=False):
    """The periodic runs of the words (`[^\\x20\\x09-\\x0D]+`) of every whole text.

    A run is a stretch of words with smallest period q and at least
    max(`least_words`, `least_periods` * q) words, `least_periods` from 2 on, that no
    neighbouring word extends. Gives doc_id, n_words, runs (start, length, period, sorted by
    start, then period) and collapsed: the words joined by spaces without those that any run
    holds behind its first period. With `digests` instead n_runs; start, length, period and
    exponent_milli of the run with most periods (of ties the first, then the one of least
    period; null without runs); runs_sha256 of `start,length,period` lines; collapsed_sha256.

    A null text and one of white space have no words, no runs and an empty collapsed text.
    Every row gives one row, rows with a repeated or null id too; no rows give none. Other
    columns are not looked at. A text is worked on whole, with some 700 bytes of memory for
    each word of its longest stretch of recurring words.
    """

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                out = []
                for content in part.column(1).to_pylist():
                    words = content.split() if content else []  # of bytes: at space and \t to \r
                    runs = runs_of_words(words, least_words, least_periods)
                    rest = collapsed(words, runs)
                    out.append(_summary(runs, rest) if digests else (len(words), runs, rest.decode()))
                yield _batch(part.column(0), out, digests)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return map_batches(rows, run, DIGESTS if digests else RUNS)


def _summary(runs, rest):
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join("%d,%d,%d\n" % r for r in runs).encode()
    return len(runs), *best, milli, _hex(lines), _hex(rest)


def _batch(ids, rows, digests):
    columns = list(zip(*rows))
    if digests:
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.string()) for c in columns[5:]]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    else:
        run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        found = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in columns[1]]
        arrays = [pa.array(columns[0], pa.int64()), pa.array(found, pa.list_(run)), pa.array(columns[2], pa.string())]
        names = ["doc_id", "n_words", "runs", "collapsed"]
    return pa.RecordBatch.from_arrays([ids, *arrays], names=names)
