"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets.

An automaton over the vocabulary (trie with failure links, as Aho and Corasick build it)
gives the longest token that ends at each byte of a piece. The longest token at the end of
the piece is tried first; a token is accepted before another if the two are compatible,
that is if merging their bytes from scratch would leave exactly these two. Otherwise the
next shorter token is tried, and places that were found dead are not tried twice. What
results is what the merges give, in time linear in the piece.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import functions as F

from pricetide.llm.shipping import map_batches

#: Pieces whose tokens a task remembers at most; the memory is emptied when it is full.
REMEMBERED = 200_000
#: Texts taken up at once in a task.
ROWS_AT_ONCE = 500
# fixed values: the pattern that byte-level vocabularies of this kind are split by
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_signs():
    """The sign that stands for each byte in the vocabulary: visible Latin-1 signs for themselves, others moved up."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, moved = {}, 256
    for byte in range(256):
        if byte in visible:
            signs[chr(byte)] = byte
        else:
            signs[chr(moved)] = byte
            moved += 1
    return signs


class Vocabulary:
    """Tokens, their merges and what encoding and decoding look up."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        signs = byte_signs()

        def as_bytes(token):
            return bytes(signs[c] for c in token)

        model = stored["model"]
        self.special = {t["content"]: t["id"] for t in stored.get("added_tokens", [])}
        names = {i: as_bytes(t) for t, i in model["vocab"].items() if t not in self.special}
        names.update({i: t.encode() for t, i in self.special.items()})
        ordered = [names.get(i, b"") for i in range(max(names) + 1)]
        self.data = np.frombuffer(b"".join(ordered), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in ordered])])
        self.ids = {t: i for i, t in names.items() if i not in self.special.values()}
        self.lengths = [len(t) for t in ordered]
        #: each id as it is written
        self.words = [i.to_bytes(4, "little") for i in range(len(ordered))]
        self.pair_rank, self.split = {}, {}
        for rank, merge in enumerate(model["merges"]):
            one, two = (as_bytes(t) for t in (merge.split(" ") if isinstance(merge, str) else merge))
            a, b, both = self.ids[one], self.ids[two], self.ids.get(one + two)
            if both is not None and (a, b) not in self.pair_rank:
                self.pair_rank[a, b] = (rank, both)
        self.compatible, self.remembered = {}, {}
        self._automaton()
        self._splits()
        self.pattern = regex.compile(PIECES)
        self.breaks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _automaton(self):
        """Trie with failure links; `longest` is the longest token that ends where a state is reached."""
        self.next, self.longest, self.fail = [{}], [-1], [0]
        for token, i in self.ids.items():
            state = 0
            for byte in token:
                if byte not in self.next[state]:
                    self.next[state][byte] = len(self.next)
                    self.next.append({})
                    self.longest.append(-1)
                    self.fail.append(0)
                state = self.next[state][byte]
            self.longest[state] = i
        level = list(self.next[0].values())
        while level:
            below = []
            for state in level:
                for byte, child in self.next[state].items():
                    back = self.fail[state]
                    while back and byte not in self.next[back]:
                        back = self.fail[back]
                    self.fail[child] = self.next[back].get(byte, 0)
                    below.append(child)
            for state in level:
                if self.longest[state] < 0:
                    self.longest[state] = self.longest[self.fail[state]]
            level = below
        # the next shorter token that ends a token, found through the failure links
        self.shorter = {}
        for token, i in self.ids.items():
            state = 0
            for byte in token:
                state = self.next[state][byte]
            self.shorter[i] = self.longest[self.fail[state]]

    def _splits(self):
        """The two tokens whose merge makes each token; a single byte has none."""
        for (a, b), (rank, both) in self.pair_rank.items():
            if both not in self.split or rank < self.split[both][2]:
                self.split[both] = (a, b, rank)

    def are_compatible(self, one, two):
        """Whether merging the bytes of the two tokens leaves them as they are.

        Goes back through the merges that made the two, later ones first, and asks whether
        one across the border would have come before. Answers are kept in a table.
        """
        known = self.compatible.get((one, two))
        if known is None:
            known = self._across(one, two)
            if len(self.compatible) > REMEMBERED:
                self.compatible.clear()
            self.compatible[one, two] = known
        return known

    def _across(self, one, two):
        none = (-1, -1, -1)
        limit = len(self.pair_rank) + 1
        while True:
            found = self.pair_rank.get((one, two))
            if found is not None and found[0] < limit:
                return False
            left, right = self.split.get(one, none), self.split.get(two, none)
            if left[2] < 0 and right[2] < 0:
                return True
            # undo the later of the two merges; of equal rank the right one, as merges go from left
            # to right. A border merge of the rank undone comes first only if it stands left of it.
            if left[2] > right[2]:
                limit, one = left[2], left[1]
            else:
                limit, two = right[2] + 1, right[0]

    def encode_piece(self, piece):
        """Token ids of the bytes of one piece, as bytes of little-endian 32-bit integers."""
        whole = self.ids.get(piece)
        if whole is not None and (whole in self.split or len(piece) == 1):
            return self.words[whole]
        state, longest, steps, fail, ends = 0, [], self.next, self.fail, self.longest
        for byte in piece:
            step = steps[state].get(byte)
            while step is None and state:
                state = fail[state]
                step = steps[state].get(byte)
            state = step or 0
            longest.append(ends[state])
        lengths, shorter, known, dead = self.lengths, self.shorter, self.compatible, set()
        end, found, after = len(piece), [], None
        token = longest[-1]
        while True:
            start = end - lengths[token]
            if start not in dead and (
                after is None or known.get((token, after)) or ((token, after) not in known and self.are_compatible(token, after))
            ):
                found.append(token)
                if start == 0:
                    words = self.words
                    return b"".join([words[t] for t in reversed(found)])
                end, after = start, token
                token = longest[end - 1]
                continue
            token = shorter[token]
            while token < 0:  # no token ends here: this end is dead, take back the one behind it
                dead.add(end)
                back = found.pop()
                end += lengths[back]
                after = found[-1] if found else None
                token = shorter[back]

    def encode(self, text):
        """Ids of a text as bytes of little-endian 32-bit integers."""
        remembered = self.remembered
        parts = [text] if self.breaks is None else self.breaks.split(text)
        out = []
        for part in parts:
            if part in self.special:
                out.append(self.words[self.special[part]])
                continue
            pieces = self.pattern.findall(part)
            for piece in pieces:
                ids = remembered.get(piece)
                if ids is None:
                    ids = self.encode_piece(piece.encode())
                    if len(piece) < 100:
                        if len(remembered) >= REMEMBERED:
                            remembered.clear()
                        remembered[piece] = ids
                out.append(ids)
        return b"".join(out)

    def decode(self, ids):
        """The bytes of an array of ids, copied through the table of offsets."""
        ids = np.asarray(ids, np.int64)
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        places = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(ids) else starts, lengths)
        return self.data[places + np.arange(len(places))].tobytes()


_loaded = {}


def vocabulary(name):
    """The vocabulary file as Spark has brought it to this executor, read once in a process."""
    if name not in _loaded:
        _loaded[name] = Vocabulary(SparkFiles.get(name))
    return _loaded[name]


def ship_vocabulary(spark, path):
    """Hand a vocabulary file to the executors; returns its name there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


IDS = "doc_id long, n_tokens long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded(docs, path, text="text", key="doc_id", digests=False):
    """Tokens of every whole text: doc_id, n_tokens and ids (little-endian 32-bit integers).

    `path` names a vocabulary file of byte-level byte-pair encoding; strings of its added
    tokens are those tokens. With `digests` the hexadecimal SHA-256 of the ids and of the
    text decoded from them stand in place of the ids, so that nothing long is moved.

    Null and empty texts have no tokens. Every row of `docs` gives one row, rows with a
    repeated or null id too; other columns are not looked at.
    """
    name = ship_vocabulary(docs.sparkSession, path)

    def run(batches):
        known = vocabulary(name)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids = [known.encode(x) if x else b"" for x in part.column(1).to_pylist()]
                out = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if digests:
                    texts = (known.decode(np.frombuffer(x, "<u4")) for x in ids)
                    out.append(pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()))
                    out.append(pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()))
                    yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([*out, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, DIGESTS if digests else IDS)


def decoded(rows, path):
    """Texts of `encoded` rows: doc_id, text. Bytes that are no UTF-8 become the replacement sign, null ids null."""
    name = ship_vocabulary(rows.sparkSession, path)

    def run(batches):
        known = vocabulary(name)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts = [
                    None if x is None else known.decode(np.frombuffer(x, "<u4")).decode(errors="replace")
                    for x in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(rows.select("doc_id", "ids"), run, "doc_id long, text string")
