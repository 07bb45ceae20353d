"""Tokens of two tokenizers aligned, with an inverted index of the linked pairs.

Both cut the same bytes; where a token of each ends, a group ends, and all tokens of one
group are linked. Every pair of ids has a posting: compressed bitmaps of the documents that
hold it linked. A task numbers its documents in chunks and writes, for each pair and chunk,
one container, which is a sorted list of 16-bit numbers or, where that is smaller, a bitmap.
Documents that hold a pair several times stand in planes too: plane j > 0 has those where bit
j - 1 of the number of further links is set. Population counts give the documents of a pair,
weighted ones its links. The counts go back over the postings: each container meets its
pair's count and is dealt by chunk, where the documents' sums are formed.
"""

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricetide.llm.bpe import PIECES, byte_signs
from pricetide.llm.scratch import Scratch
from pricetide.llm.shipping import hand_back_memory, map_batches

#: Characters of text taken up at once; a longer text is taken alone.
TEXT_AT_ONCE = 1 << 20
#: Links written out at once; groups are cut into such parts, never their results.
LINKS_AT_ONCE = 1 << 21
#: A group with more links has its ids counted before pairs are formed.
LARGE_GROUP = 4096
#: A chunk is closed behind the document that brings it to so many pairs, or at the documents 16 bits number.
CHUNK_PAIRS = 1 << 21
CHUNK_DOCS = 1 << 16
#: Bits of an id of the second vocabulary in a pair's number.
ID_BITS = 24
_LONG_PIECE = re.compile(r"\S{2000}|\s{2000}")
_INT_COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


class Texts:
    """Byte strings in one array, copied out by their numbers."""

    def __init__(self, strings):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, numbers):
        lengths = self.lengths[numbers]
        shift = self.starts[numbers] - (np.cumsum(lengths) - lengths)
        places = np.repeat(shift, lengths)
        places += np.arange(len(places))
        return self.data[places].tobytes()


class ByteVocabulary:
    """A byte-level vocabulary file, its special tokens taken as plain text."""

    def __init__(self, content):
        stored, signs = json.loads(content), byte_signs()
        special = {t["content"] for t in stored.get("added_tokens", [])}
        tokens = {bytes(signs[c] for c in t): i for t, i in stored["model"]["vocab"].items() if t not in special}
        strings = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            strings[i] = token
        self.bytes = Texts(strings)
        self.content, self.slow = content, None
        # ids are in the order of the merges, so they serve as ranks
        self.fast = tiktoken.Encoding("shipped", pat_str=PIECES, mergeable_ranks=tokens, special_tokens={})

    def encode(self, text):
        if _LONG_PIECE.search(text):  # the fast one takes the square of a piece's length
            if self.slow is None:
                self.slow = Tokenizer.from_str(self.content.decode())
                self.slow.encode_special_tokens = True
                self.slow.no_truncation()
                self.slow.no_padding()
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def encode_all(self, texts):
        """Ids of all texts with a space before each, and how many each has."""
        found = [self.encode(" " + t) for t in texts]
        return np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64), np.array([len(x) for x in found], np.int64)


class PieceVocabulary:
    """A sentence-piece model whose bytes are known piece by piece."""

    def __init__(self, content):
        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=content)
        strings = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            strings.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes = Texts(strings)

    def encode_all(self, texts):
        found = self.model.encode(texts, num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts


class Aligner:
    """Groups and links of the tokens of many texts."""

    def __init__(self, byte_vocabulary, piece_vocabulary):
        self.sides = ByteVocabulary(byte_vocabulary), PieceVocabulary(piece_vocabulary)
        decimals = []
        # numbers with what stands behind them inside a group and at the end of its side
        for side, last in zip(self.sides, (b"|", b";")):
            for i in range(len(side.bytes.lengths)):
                decimals += [b"%d," % i, b"%d" % i + last]
        self.decimals = Texts(decimals)

    def align(self, texts):
        """An `Alignment` of non-empty texts."""
        whole = [b" " + t.encode() for t in texts]
        ids, counts, good = [], [], np.ones(len(texts), bool)
        for side in self.sides:
            found, count = side.encode_all(texts)
            joined = side.bytes.joined(found)
            sizes = np.concatenate([[0], np.cumsum(side.bytes.lengths[found])])
            edges = sizes[np.concatenate([[0], np.cumsum(count)])].tolist()
            good &= np.array([joined[a:b] == w for a, b, w in zip(edges[:-1], edges[1:], whole)], bool)
            ids.append(found)
            counts.append(count)
        ids = [i[np.repeat(good, c)] for i, c in zip(ids, counts)]
        return Alignment(self, ids, [np.where(good, c, 0) for c in counts])


class Alignment:
    """Groups of the tokens of some texts, numbered through all of them."""

    def __init__(self, aligner, ids, counts):
        self.aligner, self.ids, self.counts = aligner, ids, counts
        ends = [np.cumsum(side.bytes.lengths[i]) for side, i in zip(aligner.sides, ids)]
        total = int(ends[0][-1]) if len(ends[0]) else 0
        marks = [np.zeros(total + 1, bool), np.zeros(total + 1, bool)]
        for mark, end in zip(marks, ends):
            mark[end] = True
        #: whether a token closes its group, the group of a token, and how many tokens groups have
        self.last = [marks[1][ends[0]], marks[0][ends[1]]]
        self.group = [np.cumsum(x) - x for x in self.last]
        n_groups = int(self.last[0].sum())
        self.sizes = [np.bincount(g, minlength=n_groups) for g in self.group]
        self.starts = [np.cumsum(s) - s for s in self.sizes]
        edges = np.concatenate([[0], np.cumsum(counts[0])])
        closed = np.concatenate([[0], np.cumsum(self.last[0])])[edges]
        #: per text
        self.n_groups = np.diff(closed)
        products = np.concatenate([[0], np.cumsum(self.sizes[0] * self.sizes[1])])
        self.n_links = np.diff(products[closed])

    def group_texts(self):
        """`a1,a2|b1;a3|b2` of every text as bytes."""
        (a, b), (last_a, last_b), (group_a, group_b) = self.ids, self.last, self.group
        merged = np.empty(len(a) + len(b), np.int64)
        merged[np.arange(len(a)) + self.starts[1][group_a]] = 2 * a + last_a
        offset = 2 * len(self.aligner.sides[0].bytes.lengths)
        merged[np.arange(len(b)) + (self.starts[0] + self.sizes[0])[group_b]] = offset + 2 * b + last_b
        joined = self.aligner.decimals.joined(merged)
        sizes = np.concatenate([[0], np.cumsum(self.aligner.decimals.lengths[merged])])
        edges = sizes[np.concatenate([[0], np.cumsum(self.counts[0] + self.counts[1])])].tolist()
        return [joined[a : max(a, b - 1)] for a, b in zip(edges[:-1], edges[1:])]

    def pairs(self, places):
        """(pair and place of the text in one number, links) of some groups at a time; the same number may come again."""
        (a, b), (size_a, size_b), (start_a, start_b) = self.ids, self.sizes, self.starts
        text = np.repeat(places, self.n_groups)
        products = size_a * size_b
        large = products > LARGE_GROUP
        for g in np.flatnonzero(large):
            ones, n_one = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
            twos, n_two = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
            step = max(1, LINKS_AT_ONCE // len(twos))
            for k in range(0, len(ones), step):
                numbers = (((ones[k : k + step, None] << ID_BITS) | twos[None, :]) << 16) | text[g]
                yield numbers.ravel(), (n_one[k : k + step, None] * n_two[None, :]).ravel()
        upto = np.cumsum(np.where(large, 0, products))
        first = 0
        while first < len(products):
            done = upto[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(upto, done + LINKS_AT_ONCE, "right")))
            groups = first + np.flatnonzero(~large[first:end])
            first = end
            if not len(groups):
                continue
            count = products[groups]
            of = np.repeat(np.arange(len(groups)), count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            g = groups[of]
            ones = a[start_a[g] + nth // size_b[g]]
            twos = b[start_b[g] + nth % size_b[g]]
            numbers, links = np.unique((((ones << ID_BITS) | twos) << 16) | text[g], return_counts=True)
            yield numbers, links


def combined(numbers, links):
    """Sorted distinct numbers with the sum of their links."""
    order = np.argsort(numbers, kind="stable")
    numbers, links = numbers[order], links[order]
    new = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[new], np.add.reduceat(links, new)


def containers(pairs, docs, n_docs):
    """(pairs, documents of each, dense, blobs) twice: lists of numbers, and bitmaps where those are smaller."""
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    count = np.diff(np.concatenate([first, [len(pairs)]]))
    width = -(-n_docs // 8)
    dense = 2 * count > width
    listed = docs[np.repeat(~dense, count)].astype("<u2")
    yield pairs[first[~dense]], count[~dense], False, _blobs(listed.tobytes(), 2 * count[~dense])
    of_dense = np.repeat(dense, count)
    row = np.repeat(np.cumsum(dense) - 1, count)[of_dense]
    bits, n_dense, step = [], int(dense.sum()), max(1, (1 << 24) // (8 * width))
    members = docs[of_dense]
    for k in range(0, n_dense, step):
        a, b = np.searchsorted(row, [k, k + step])
        block = np.zeros((min(step, n_dense - k), 8 * width), bool)
        block[row[a:b] - k, members[a:b]] = True
        bits.append(np.packbits(block, axis=1, bitorder="little").tobytes())
    yield pairs[first[dense]], count[dense], True, _blobs(b"".join(bits), np.full(n_dense, width))


def _blobs(data, lengths):
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class Chunk:
    """Documents numbered from 0 and the pairs that they link."""

    def __init__(self, number):
        self.number, self.docs, self.parts, self.size = number, 0, [], 0

    def add(self, alignment, places):
        """Texts that are the documents at `places` behind those that are here."""
        for numbers, links in alignment.pairs(self.docs + places):
            self.parts.append((numbers, links))
            self.size += len(numbers)

    def postings(self):
        """Batches of containers, plane by plane."""
        if not self.size:
            return
        numbers, links = combined(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts = []
        for plane, pairs, docs in planes(numbers >> 16, numbers & 0xFFFF, links):
            for some, count, dense, blobs in containers(pairs, docs, self.docs):
                yield _batch(
                    len(some),
                    chunk=np.full(len(some), self.number),
                    plane=np.full(len(some), plane, np.int32),
                    a=(some >> ID_BITS).astype(np.int32),
                    b=(some & ((1 << ID_BITS) - 1)).astype(np.int32),
                    n=count.astype(np.int64),
                    dense=np.full(len(some), dense),
                    docs=blobs,
                )


def planes(pairs, docs, links):
    """(plane, pairs, docs): first all, then for each bit of the number of further links those that have it."""
    yield 0, pairs, docs
    further, plane = links - 1, 1
    while True:
        left = further > 0
        if not left.any():
            return
        pairs, docs, further = pairs[left], docs[left], further[left]
        held = (further & 1) > 0
        if held.any():
            yield plane, pairs[held], docs[held]
        further, plane = further >> 1, plane + 1


INDEX = pa.schema(
    [
        # a container
        ("chunk", pa.int64()),
        ("plane", pa.int32()),
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("n", pa.int64()),
        ("dense", pa.bool_()),
        ("docs", pa.binary()),
        # or, without a plane, a document
        ("place", pa.int32()),
        ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in _INT_COLUMNS],
        ("groups", pa.string()),
    ]
)
INDEX_TYPES = "chunk long, plane int, a int, b int, n long, dense boolean, docs binary, place int, doc_id long, " + (
    "n_a long, n_b long, n_groups long, n_links long, groups string"
)


def _batch(rows, **columns):
    arrays = []
    for field in INDEX:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(rows, field.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=INDEX)


def _batches_of_texts(batch):
    """(ids, texts) of some rows at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if ids and (size + len(text or "") > TEXT_AT_ONCE or len(ids) == CHUNK_DOCS // 16):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id)
        texts.append(text or "")
        size += len(text or "")
    if ids:
        yield ids, texts


_loaded = {}


def aligner_of(byte_vocabulary, piece_vocabulary):
    """The aligner of two files' contents, made once in a process."""
    key = tuple(hashlib.sha256(x).digest() for x in (byte_vocabulary, piece_vocabulary))
    if key not in _loaded:
        _loaded[key] = Aligner(byte_vocabulary, piece_vocabulary)
    return _loaded[key]


def pair_index(docs, byte_path, piece_path, text="text", key="doc_id", digests=False, chunk_pairs=CHUNK_PAIRS):
    """Containers and documents as rows of `INDEX`, to be written before they are read twice."""
    spark = docs.sparkSession
    files = []
    for path in (byte_path, piece_path):
        with open(path, "rb") as file:
            files.append(file.read())
    # two vocabulary files, whose size is that of the vocabularies
    shipped = spark.sparkContext.broadcast(files)

    def run(batches):
        aligner = aligner_of(*shipped.value)
        number = TaskContext.get().partitionId() << 32
        chunk = Chunk(number)
        for batch in batches:
            for ids, texts in _batches_of_texts(batch):
                alignment = aligner.align([t for t in texts if t])
                if chunk.docs + len(ids) > CHUNK_DOCS or chunk.size >= chunk_pairs:
                    yield from chunk.postings()
                    number += 1
                    chunk = Chunk(number)
                yield _documents(chunk, ids, texts, alignment, digests)
                chunk.add(alignment, np.flatnonzero([bool(t) for t in texts]))
                chunk.docs += len(ids)
        yield from chunk.postings()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, INDEX_TYPES)


def _documents(chunk, ids, texts, alignment, digests):
    some = np.array([bool(t) for t in texts])
    groups = np.full(len(ids), "", object)
    found = alignment.group_texts()
    groups[some] = [hashlib.sha256(g).hexdigest() if g else "" for g in found] if digests else [g.decode() for g in found]
    columns = {}
    for name, values in zip(_INT_COLUMNS, (*alignment.counts, alignment.n_groups, alignment.n_links)):
        columns[name] = np.zeros(len(ids), np.int64)
        columns[name][some] = values
    return _batch(
        len(ids),
        chunk=np.full(len(ids), chunk.number),
        place=np.arange(chunk.docs, chunk.docs + len(ids), dtype=np.int32),
        doc_id=ids,
        groups=groups,
        **columns,
    )


def pair_counts(index):
    """(a, b, documents) of every linked pair, by the population of its bitmaps."""
    return index.where("plane = 0").groupBy("a", "b").agg(F.sum("n").alias("documents"))


def pair_links(index):
    """(a, b, documents, links) of every linked pair; each plane counts by its weight."""
    weight = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    return (
        index.where("plane is not null")
        .groupBy("a", "b")
        .agg(F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("documents"), F.sum(F.col("n") * weight).alias("links"))
    )


def _members(column, dense, size):
    """Numbers of the documents of many containers one after the other, and how many each has."""
    column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    if not dense:
        return data.view("<u2").astype(np.int64), np.diff(offsets) // 2
    bits = np.unpackbits(data.reshape(len(column), -1), axis=1, bitorder="little", count=size)
    rows, members = np.nonzero(bits)
    return members, np.bincount(rows, minlength=len(column))


def _sums_of_chunk(table):
    """The documents of one chunk with their sums over the postings that hold them."""
    documents = table.filter(pc.is_null(table["plane"])).sort_by("place")
    size = len(documents)
    count_sum, n_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for dense in (False, True):
        some = table.filter(pc.equal(table["dense"], dense))
        # bitmaps are spread out in parts of a bounded size
        step = max(1, (1 << 24) // size) if dense else max(1, len(some))
        for first in range(0, len(some), step):
            part = some.slice(first, step)
            members, held = _members(part["docs"], dense, size)
            weight = 1 << np.maximum(part["plane"].to_numpy().astype(np.int64) - 1, 0)
            np.add.at(count_sum, members, np.repeat(weight * part["documents"].to_numpy(), held))
            np.add.at(n_best, members, np.repeat(weight * part["best"].to_numpy().astype(np.int64), held))
    columns = [documents["doc_id"], *(documents[c] for c in _INT_COLUMNS)]
    out = pa.table([*columns, pa.array(n_best), pa.array(count_sum), documents["groups"]], names=ALIGNED)
    hand_back_memory()
    return out


ALIGNED = ["doc_id", *_INT_COLUMNS, "n_best", "count_sum", "groups"]


def aligned(docs, byte_path, piece_path, text="text", key="doc_id", digests=False, chunk_pairs=CHUNK_PAIRS):
    """How the tokens of two vocabularies fit in every whole text.

    The first vocabulary, a byte-level one, encodes a space and the text; the second, a
    sentence-piece model, the text, before which it sets the space itself. Strings of special
    tokens are plain text. Gives doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens
    in one group), n_best (links whose pair is in as many documents as any pair with its first
    id), count_sum (over the links, the documents that hold their pair) and groups
    (`a1,a2|b1;a3|b2`, ids in decimal). With `digests` groups has the hexadecimal SHA-256 of
    that, or '' for a text without tokens.

    Null and empty texts have no tokens, nor has a text that the tokens of either side do
    not spell byte for byte: zeros and ''. Every row gives one row, rows with a repeated or
    null id too, and each counts as a document. No rows give none. Other columns are not
    looked at. A text is worked on whole, with some 300 bytes of memory for each of its bytes.

    The vocabularies' ids have less than 24 bits. A chunk holds `chunk_pairs` pairs and those
    of one batch of texts more, and its containers meet in one task.
    """
    scratch = Scratch(docs.sparkSession)
    index = scratch.write(pair_index(docs, byte_path, piece_path, text, key, digests, chunk_pairs), "pair-index")
    counts = scratch.write(pair_counts(index), "pair-counts")
    # one row for each id of the first vocabulary
    best = counts.groupBy("a").agg(F.max("documents").alias("most"))
    marked = counts.join(F.broadcast(best), "a").select("a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))
    held = index.where("plane is not null").select("chunk", "plane", "a", "b", "dense", "docs").join(marked, ["a", "b"])
    rows = held.select("chunk", "plane", "dense", "docs", "documents", "best").unionByName(
        index.where("plane is null").select("chunk", "place", "doc_id", *_INT_COLUMNS, "groups"), allowMissingColumns=True
    )
    types = ", ".join(f"{c} {'string' if c == 'groups' else 'long'}" for c in ALIGNED)
    scratch.clear(index, counts)
    return rows.groupBy("chunk").applyInArrow(_sums_of_chunk, types)
