import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pricetide.llm import alignment
from pricetide.llm.alignment import _members, aligned, aligner_of, containers, pair_index, pair_links, planes
from pricetide.llm.bpe import Vocabulary, byte_signs
from pricetide.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, a long, chunk string"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ONE = Tokenizer.from_file(PATHS[0])
ONE.encode_special_tokens = True
TWO = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
SIGNS = byte_signs()


def tokens(text):
    """(id, bytes) of both sides as the libraries give them."""
    ones = [(i, bytes(SIGNS[c] for c in ONE.id_to_token(i))) for i in ONE.encode(" " + text, add_special_tokens=False).ids]
    twos = []
    for i in TWO.encode(text):
        piece = TWO.id_to_piece(i)
        twos.append((i, bytes([int(piece[3:5], 16)]) if TWO.is_byte(i) else piece.replace("▁", " ").encode()))
    spelled = [b"".join(b for _, b in side) for side in (ones, twos)]
    return (ones, twos) if text and spelled == [(" " + text).encode()] * 2 else ([], [])


def groups_of(ones, twos):
    found, a, b, ends = [], [], [], [0, 0]
    ones, twos = list(ones), list(twos)
    while ones or twos:
        side = 0 if ends[0] <= ends[1] and not (ends[0] == ends[1] and a) else 1
        i, content = (ones, twos)[side].pop(0)
        (a, b)[side].append(i)
        ends[side] += len(content)
        if ends[0] == ends[1]:
            found.append((a, b))
            a, b = [], []
    return found


def expected(docs):
    parts, holds = [], Counter()
    for doc_id, text in docs:
        ones, twos = tokens(text or "")
        groups = groups_of(ones, twos)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        holds.update(links.keys())
        parts.append((doc_id, len(ones), len(twos), groups, links))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    rows = []
    for doc_id, n_a, n_b, groups, links in parts:
        best = sum(n for p, n in links.items() if holds[p] == most[p[0]])
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        total = sum(n * holds[p] for p, n in links.items())
        rows.append((doc_id, n_a, n_b, len(groups), sum(links.values()), best, total, text))
    return rows


def hashed(rows):
    return [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in rows]


def same(got, docs, digests=False):
    rows = expected(docs)
    return sorted(map(tuple, got), key=repr) == sorted(hashed(rows) if digests else rows, key=repr)


ODD = [
    (None, "the cat sat on the mat"),
    (1, None),
    (2, ""),
    (3, "   \n\t  \u0085\xa0 "),
    (4, "the cat sat on the mat"),
    (4, "the cat sat on the mat"),
    (5, "<|endoftext|> <s> </s> <unk> <0x41> ▁ x"),
    (6, "plain <|endoftext|> <s> </s> <unk> <0x41> x"),
    (7, "中文😀 naïve é\x00 \r\n ﬁ  two  spaces "),
    (8, "=" * 3001 + " " * 2500 + "ab" * 1200 + "\n" * 2100),
    (9, "the the the the the the cat the cat"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*d, 1, "clash") for d in ODD], COLUMNS).repartition(3)


def test_odd_texts_against_brute_force(spark, odd):
    got = aligned(odd, *PATHS).collect()
    assert same(got, ODD)
    assert [r.n_a for r in got if r.doc_id == 5] == [0]
    assert aligned(spark.createDataFrame([], COLUMNS), *PATHS).collect() == []


def test_lists_bitmaps_and_many_chunks_give_the_same(spark):
    docs = [*ODD, *((i, f"word{i % 7} the common passage of all texts {'x' * (i % 30)}") for i in range(100, 400))]
    frame = spark.createDataFrame([(*d, 1, "") for d in docs], COLUMNS).repartition(2)
    index = pair_index(frame, *PATHS)
    assert index.where("plane = 0 and dense").count() and index.where("plane = 0 and not dense").count()
    assert same(aligned(frame, *PATHS).collect(), docs)
    # a chunk for each batch that Arrow brings
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert pair_index(frame, *PATHS, chunk_pairs=1).select("chunk").distinct().count() > 10
        assert same(aligned(frame, *PATHS, chunk_pairs=1).collect(), docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pairs_of_groups_of_any_size(monkeypatch):
    aligner = aligner_of(*(open(p, "rb").read() for p in PATHS))
    texts = ["=" * 777 + "a" * 500 + "é" * 90, "the cat", "ab" * 2000]
    found = aligner.align(texts)
    whole = alignment.combined(*(np.concatenate(x) for x in zip(*found.pairs(np.array([3, 4, 9])))))
    for large, at_once in ((3, 1 << 21), (4096, 5), (3, 5), (10**9, 100)):
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        monkeypatch.setattr(alignment, "LINKS_AT_ONCE", at_once)
        again = alignment.combined(*(np.concatenate(x) for x in zip(*found.pairs(np.array([3, 4, 9])))))
        assert all((a == b).all() for a, b in zip(whole, again))
    links = defaultdict(int)
    for text, place in zip(texts, (3, 4, 9)):
        for a, b in groups_of(*tokens(text)):
            for x in a:
                for y in b:
                    links[((x << alignment.ID_BITS | y) << 16) | place] += 1
    assert dict(zip(*(x.tolist() for x in whole))) == links


def test_texts_keep_their_places_in_a_chunk():
    aligner = aligner_of(*(open(p, "rb").read() for p in PATHS))
    chunk = alignment.Chunk(7)
    for _ in range(3):
        chunk.add(aligner.align(["the cat", "the the dog"]), np.array([0, 2]))
        chunk.docs += 4
    held = defaultdict(set)
    for batch in chunk.postings():
        for row in batch.to_pylist():
            if row["plane"] == 0:
                members, _ = _members(pa.chunked_array([pa.array([row["docs"]], pa.binary())]), row["dense"], chunk.docs)
                held[row["a"], row["b"]] |= set(members.tolist())
    the = ONE.encode(" the").ids[0], TWO.encode("the")[0]
    assert held[the] == {0, 2, 4, 6, 8, 10}


def test_containers_and_planes_give_back_what_they_hold():
    pick = random.Random(5)
    for n_docs in (1, 9, 700):
        entries = {(pick.randrange(20) ** 2, pick.randrange(n_docs)): pick.choice([1, 1, 2, 3, 9, 70_000]) for _ in range(n_docs * 4)}
        keys = sorted(entries)
        pairs, docs = np.array(keys).T
        links = np.array([entries[k] for k in keys])
        back = Counter()
        for plane, some, members in planes(pairs, docs, links):
            for of, count, dense, blobs in containers(some, members, n_docs):
                if len(of):
                    found, held = _members(pa.chunked_array([blobs]), dense, n_docs)
                    assert held.tolist() == count.tolist()
                    for p, d in zip(np.repeat(of, held).tolist(), found.tolist()):
                        back[p, d] += 1 << max(plane - 1, 0)
        assert back == entries


def test_links_of_pairs_are_counted_by_their_planes(spark, odd):
    links, holds = Counter(), Counter()
    for _, text in ODD:
        own = Counter((x, y) for a, b in groups_of(*tokens(text or "")) for x in a for y in b)
        links.update(own)
        holds.update(own.keys())
    got = {(r.a, r.b): (r.documents, r.links) for r in pair_links(pair_index(odd, *PATHS)).collect()}
    assert got == {p: (holds[p], n) for p, n in links.items()}


def test_ranks_of_tokens_stand_for_their_merges():
    """Ids may serve as ranks: no two tokens stay side by side that spell a token, and each token encodes to itself."""
    known = Vocabulary(PATHS[0])
    for token, i in known.ids.items():
        assert known.encode_piece(token) == i.to_bytes(4, "little")
        for k in range(1, len(token)):
            one, two = known.ids.get(token[:k]), known.ids.get(token[k:])
            assert one is None or two is None or not known.are_compatible(one, two)
    merged = [both for _, both in sorted(known.pair_rank.values())]
    assert merged == sorted(merged)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op12_alignment"](spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert same(got.collect(), docs, digests=True)
