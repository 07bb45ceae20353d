"""Lengths in word pieces by a linear longest-match automaton.

Every word is split into the longest piece that begins it, the longest that begins the
rest, and so on. Instead of building pieces a trie of the vocabulary is walked once: where
no piece goes on, a failure link leads to the state of what is left after the pieces that
are certain by now, and the number of those pieces was counted when the trie was built.
"""

import json

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import functions as F

from pricetide.llm.bpe import byte_signs, ship_vocabulary
from pricetide.llm.shipping import map_batches

#: Words whose length a task remembers at most; the memory is emptied when it is full.
REMEMBERED = 400_000
ROWS_AT_ONCE = 500


class LongestMatch:
    """Greedy longest-match lengths over a set of pieces (byte strings)."""

    def __init__(self, pieces):
        children, is_piece = [{}], [False]
        for piece in pieces:
            state = 0
            for byte in piece:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                    is_piece.append(False)
                state = children[state][byte]
            is_piece[state] = bool(piece)
        self.children = children
        #: state of what is left after the certain pieces, -1 if there is none; number of those pieces
        self.link, self.popped = [-1] * len(children), [0] * len(children)
        #: pieces of the whole string of a state, -1 if it cannot be split
        self.whole = [-1] * len(children)
        self.whole[0] = 0
        level = [(0, byte, child) for byte, child in children[0].items()]
        while level:
            for parent, byte, state in level:
                if is_piece[state]:
                    self.link[state], self.popped[state] = 0, 1
                else:
                    back, count = self.link[parent], self.popped[parent]
                    while back >= 0 and byte not in children[back]:
                        count += self.popped[back]
                        back = self.link[back]
                    if back >= 0:
                        self.link[state], self.popped[state] = children[back][byte], count
                after = self.link[state]
                if after >= 0 and self.whole[after] >= 0:
                    self.whole[state] = self.popped[state] + self.whole[after]
            level = [(state, byte, child) for _, _, state in level for byte, child in children[state].items()]
        self.remembered = {}

    def length(self, word):
        """Number of pieces of a word, -1 if it cannot be split."""
        state, count = 0, 0
        children, link, popped = self.children, self.link, self.popped
        for byte in word:
            step = children[state].get(byte)
            while step is None:
                count += popped[state]
                state = link[state]
                if state < 0:
                    return -1
                step = children[state].get(byte)
            state = step
        rest = self.whole[state]
        return -1 if rest < 0 else count + rest

    def lengths(self, text, mark=b" "):
        """(words, pieces, words that cannot be split) of a text; such a word counts as one piece."""
        remembered, pieces, unknown = self.remembered, 0, 0
        words = text.split()
        for word in words:
            length = remembered.get(word)
            if length is None:
                length = self.length(mark + word)
                if len(word) < 100:
                    if len(remembered) >= REMEMBERED:
                        remembered.clear()
                    remembered[word] = length
            if length < 0:
                unknown, length = unknown + 1, 1
            pieces += length
        return len(words), pieces, unknown


def vocabulary_pieces(path):
    """The pieces of a byte-level vocabulary file as bytes; those that begin a word begin with a space."""
    signs = byte_signs()
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    special = {t["content"] for t in stored.get("added_tokens", [])}
    return [bytes(signs[c] for c in t) for t in stored["model"]["vocab"] if t not in special]


_loaded = {}


def matcher(name):
    if name not in _loaded:
        _loaded[name] = LongestMatch(vocabulary_pieces(SparkFiles.get(name)))
    return _loaded[name]


def piece_counts(docs, path, text="text", key="doc_id"):
    """Length of every whole text in word pieces: doc_id, n_words, n_pieces, n_unknown.

    Words are runs of other than space and \\t to \\r. A word with a space before it is
    split greedily into the longest pieces of the vocabulary in `path`; one that cannot be
    split counts as one piece and as unknown. Null and empty texts and white space have no
    words. Every row of `docs` gives one row, rows with a repeated or null id too; other
    columns are not looked at.
    """
    name = ship_vocabulary(docs.sparkSession, path)

    def run(batches):
        known = matcher(name)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found = [known.lengths(x) if x else (0, 0, 0) for x in part.column(1).cast(pa.binary()).to_pylist()]
                columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], names=["doc_id", "n_words", "n_pieces", "n_unknown"]
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, n_words long, n_pieces long, n_unknown long")
