import hashlib
import random
import datetime
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricetide.llm.bpe import Vocabulary, decoded, encoded
from pricetide.llm.components import components
from pricetide.llm.decontamination import contained_items
from pricetide.llm.exact_dedup import BLOCK, exact_duplicates
from pricetide.llm.label_model import LabelModel
from pricetide.llm.line_dedup import matches, with_lines, without_repeated_runs
from pricetide.llm.near_duplicates import near_duplicates
from pricetide.llm.pseudonyms import Permutation, Pseudonyms, iban_check, pseudonymised
from pricetide.llm.quality import quality_scores
from pricetide.llm.scratch import Scratch
from pricetide.llm.toxicity import toxicity_scores
from pricetide.llm.warc import derivatives, page_facts, page_links, page_text, read_records, responses, write_records
from pricetide.llm.wordpiece import LongestMatch, piece_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
# null id, null, empty and white texts, repeated rows, a long text; with a column whose name clashes with those inside
ODD = [
    (1, None, 9),
    (2, "", 9),
    (3, " \n\t ", 9),
    (4, "one two three four five six seven", 9),
    (4, "one two three four five six seven", 9),
    (None, "one two three four five six seven", 9),
    (5, "word " * 20_000, None),
    (6, "é\x00 <|endoftext|> 中文 😀 \u0085", 9),
]
COLUMNS = "doc_id long, text string, hash long"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def words(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def test_exact_duplicates_against_brute_force(spark, odd, none):
    long = "x" * (BLOCK * 3 + 5)
    texts = [*ODD, (10, long, 1), (11, long[:9] + "  " + long[9:], 1), (12, long + "y", 1), (13, long[:-1] + "y", 1)]
    got = exact_duplicates(spark.createDataFrame(texts, COLUMNS)).collect()
    assert len(got) == len(texts)
    groups = {}
    for doc_id, text, _ in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): sorted(v) for k, v in groups.items()}
    for row in got:
        group = by_hash[row.text_sha256]
        assert (row.group_size, row.keep_id) == (len(group), group[0][3])
    assert sum(r.kept for r in got) == len(groups)
    assert exact_duplicates(none).collect() == []


def test_components_of_chains_and_stars(spark, rows):
    chain = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(chain, "a long, b long"))))
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 140), 100)}


def test_near_duplicates_against_brute_force(spark, odd, none):
    texts, number = list(ODD), 100
    for seed in range(12):
        base = words(120, seed)
        for k in range(6):
            copy = list(base)
            for place in random.Random(seed * 10 + k).sample(range(120), k):
                copy[place] = "changed%d" % (k * seed)
            texts.append((number, " ".join(copy).upper() if k == 2 else " ".join(copy), 0))
            number += 1
    got = near_duplicates(spark.createDataFrame(texts, COLUMNS), size=4).collect()
    assert len(got) == len(texts)
    sets = {}
    for doc_id, text, _ in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[doc_id] = {tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if None not in (a, b) and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
        if all(label[label[i]] == label[i] for i in sets if i is not None):
            break
    for row in got:
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == label[row.doc_id]
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)
    assert near_duplicates(none).collect() == []


def test_repeated_runs_go_and_clean_texts_stay(spark, odd, none):
    sentences = [" ".join(words(12, s)).capitalize() + "." for s in range(40)]
    passage = " ".join(sentences[:6])
    texts = [
        (1, sentences[10] + " " + passage + "\n" + sentences[11], 0),
        (2, sentences[12] + "\n" + passage + " " + sentences[13], 0),
        (3, " ".join(sentences[20:26]), 0),
        (4, sentences[10], 0),
        (5, passage, 0),
        *[(i + 10 if i else None, t, h) for i, t, h in ODD[:4]],
    ]
    got = {r.doc_id: r for r in without_repeated_runs(spark.createDataFrame(texts, COLUMNS)).collect()}
    assert got[1].text == texts[0][1] and got[3].text == texts[2][1] and got[4].text == texts[3][1]
    assert passage not in got[2].text and sentences[12] in got[2].text and sentences[13] in got[2].text
    assert got[5].text == "" and got[5].lines_deleted == 6
    assert got[11].text is None and got[12].text == "" and got[2].hash == 0
    assert without_repeated_runs(odd).count() == len(ODD)
    assert without_repeated_runs(none).collect() == []


def test_short_lines_that_repeat_go(spark):
    licence = "This file is free software. See the licence that comes with it!"
    own = [" ".join(words(9, 300 + s)) for s in range(6)]
    texts = [
        (1, f"{own[0]}. {own[1]}\n  {licence}\nthe end\n", 0),
        (2, f"{licence}\n{own[2]}\nthe end\n\n{licence}", 0),
        (3, f"{own[3]}. {licence}\nthe end", 0),
        (4, f"{own[4]}\x1e\n{licence} \n{own[5]}\na b c d\n", 0),
        (5, f"a b c d\n{licence[:-1]}", 0),
        (6, "版权所有未经许可不得转载", 0),
        (7, "一\n版权所有未经许可不得转载", 0),
    ]
    got = {r.doc_id: (r.text, r.lines_deleted) for r in without_repeated_runs(spark.createDataFrame(texts, COLUMNS)).collect()}
    assert got[1] == (texts[0][1], 0) and got[3] == (texts[2][1], 0) and got[6] == (texts[5][1], 0)
    assert got[2] == (f"{own[2]}\nthe end\n\n", 4)
    assert got[4][0] == f"{own[4]}\x1e\n{own[5]}\na b c d\n"
    assert got[5] == (licence[:-1], 1) and got[7] == ("一\n", 1)


def test_runs_of_tiny_lines_go_as_a_whole(spark):
    pick = random.Random(8)
    passage = "\n".join(pick.choice("abcdefgh") for _ in range(400))
    texts = [(1, f"one\n{passage}\ntwo", 0), (2, f"three\n{passage}\nfour", 0)]
    got = {r.doc_id: (r.text, r.lines_deleted) for r in without_repeated_runs(spark.createDataFrame(texts, COLUMNS)).collect()}
    assert got == {1: (texts[0][1], 0), 2: ("three\nfour", 400)}


def test_contained_items_against_brute_force(spark, odd, none):
    items = [(i, " ".join(words(30, 50 + i))) for i in range(8)] + [(90, None), (91, ""), (None, "a b c d e f"), (92, "one two")]
    texts = list(ODD)
    for i in range(8):
        part = words(30, 50 + i)[: 30 - i]
        texts.append((20 + i, " ".join(words(3000, i) + part + words(10, i + 99)), 0))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.shared for r in contained_items(spark.createDataFrame(texts, COLUMNS), benchmark).collect()}

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    wanted = {}
    for item, text in items:
        for doc, body, _ in texts:
            own, both = shingles(text), shingles(text) & shingles(body)
            if item is not None and doc is not None and own and 100 * len(both) >= 80 * len(own):
                wanted[doc, item] = len(both)
    assert got == wanted and got
    assert contained_items(none, benchmark).collect() == []
    assert contained_items(odd, benchmark.limit(0)).collect() == []


def test_encoding_is_that_of_the_library(spark, odd, none):
    vocabulary, library = Vocabulary(PATH), Tokenizer.from_file(PATH)
    pick = random.Random(4)
    signs = ["a", "th", "ing", " ", "  ", "\n", "'s", "'", ".", "é", "中", "😀", "1", "\x1f", "\u0085", "　", "<|endoftext|>"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    for text in [*texts, *[t or "" for _, t, _ in ODD], "a" * 500, "'" * 99]:
        ids = np.frombuffer(vocabulary.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False).encode()
    tokens = encoded(odd, PATH)
    back = sorted((r.doc_id or -1, r.text) for r in decoded(tokens, PATH).collect())
    assert back == sorted((i or -1, t or "") for i, t, _ in ODD)
    digests = {r.doc_id: r for r in encoded(odd, PATH, digests=True).collect()}
    assert digests[6].decoded_sha256 == hashlib.sha256(ODD[-1][1].encode()).hexdigest()
    assert digests[1].n_tokens == 0 and encoded(none, PATH).collect() == []


def greedy(word, pieces):
    count = 0
    while word:
        length = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), 0)
        if not length:
            return -1
        word, count = word[length:], count + 1
    return count


def test_piece_lengths_against_greedy_search(spark, odd, none):
    pick = random.Random(5)
    for _ in range(500):
        pieces = {"".join(pick.choice("ab") for _ in range(pick.randint(1, 4))).encode() for _ in range(pick.randint(1, 8))}
        matcher = LongestMatch(pieces)
        for _ in range(5):
            word = "".join(pick.choice("ab") for _ in range(pick.randint(0, 9))).encode()
            assert matcher.length(word) == greedy(word, pieces)
    got = {r.doc_id: r for r in piece_counts(odd, PATH).collect()}
    assert (got[3].n_words, got[3].n_pieces, got[5].n_words, got[4].n_pieces) == (0, 0, 20_000, 7)
    assert piece_counts(none, PATH).collect() == []


def test_permutations_are_one_to_one_and_undone():
    for size in (1, 2, 7, 100, 1000):
        moved = Permutation(b"k", "test", size)
        assert sorted(moved(i) for i in range(size)) == list(range(size))
        assert all(moved.back(moved(i)) == i for i in range(size))


def test_pseudonyms_keep_formats_and_links(spark, odd, none):
    account = "370400440532013000"
    iban = "DE" + iban_check("DE", account) + account
    text = (
        f"Mail a.bc.42@mail8.example.com or +1 (988) 555-2485 at 42.144.35.254 on 2021-02-28, 28.02.2021 and 02/28/2021; "
        f"pay 4041894974608795 or 4041 8949 7460 8795 or {iban}, id 123-45-6789. "
    )
    clean = "Not 4041894974608796, 2021-02-30, 300.1.1.1, 666-12-3456, version 3.2.1 or 12345 things."
    names = Pseudonyms(b"secret")
    made, found = names.replace(text)
    assert [k for k, *_ in found] == ["email", "phone", "ip", "date", "date", "date", "card", "card", "iban", "ssn"]
    values = {v: p for _, _, v, p in found}
    assert all(re.sub(r"\d", "9", v) == re.sub(r"\d", "9", p) for k, _, v, p in found if k in ("phone", "card", "ssn"))
    assert values["4041894974608795"] == values["4041 8949 7460 8795"].replace(" ", "")
    year, month, day = values["2021-02-28"].split("-")
    assert values["28.02.2021"] == f"{day}.{month}.{year}"
    assert names.replace(made)[0] != made and Pseudonyms(b"other").replace(text)[0] != made
    assert names.replace(clean) == (clean, [])
    docs = spark.createDataFrame([*ODD, (7, text, 0), (8, text, 0)], COLUMNS)
    rows = pseudonymised(docs, b"secret")
    got = {r.doc_id: r for r in rows.collect()}
    assert got[7].text == got[8].text == made and got[1].text is None and got[2].text == "" and not got[4]["values"]
    back = {r.doc_id: r.text for r in pseudonymised(rows.where("doc_id in (7, 8)"), b"secret", undo=True).collect()}
    assert back[7] == back[8] == text
    assert pseudonymised(none, b"secret").collect() == []


def test_every_date_keeps_its_format_and_comes_back():
    """All days of 1900 to 2099 in every form: one to one, same digits, linked between forms, undone."""
    names, back = Pseudonyms(b"secret"), Pseudonyms(b"secret", undo=True)
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(n) for n in range(73_049)]
    assert days[-1] == datetime.date(2099, 12, 31)
    forms = {
        "iso": lambda d: d.isoformat(),
        "dots": lambda d: f"{d.day:02d}.{d.month:02d}.{d.year}",
        "slashes": lambda d: f"{d.day:02d}/{d.month:02d}/{d.year}",
        "short": lambda d: f"{d.day}-{d.month}-{d.year}",
        "american": lambda d: f"{d.month:02d}/{d.day:02d}/{d.year}" if d.day > 12 else None,
        "american short": lambda d: f"{d.month}/{d.day}/{d.year}" if d.day > 12 else None,
    }
    moved = [names.moved_date(d.year, d.month, d.day) for d in days]
    moved = [datetime.date(m["y"], m["m"], m["d"]) for m in moved]
    assert len(set(moved)) == len(days) and sum(a == b for a, b in zip(days, moved)) < 100
    for write in forms.values():
        for day, other in zip(days[:: 1 if write is forms["iso"] else 7], moved[:: 1 if write is forms["iso"] else 7]):
            text = write(day)
            if text is None:
                continue
            made = names.date(text)
            assert made == write(other) and back.date(made) == text
    american = {names.date(forms["american"](d)) for d in days if d.day > 12}
    slashes = {names.date(forms["slashes"](d)) for d in days}
    assert len(american) == sum(d.day > 12 for d in days) and len(slashes) == len(days) and not american & slashes
    for text in ["0001-01-01", "9999-12-31", "4.7.1776", "12/25/0099", "1.02.2021"]:
        made = names.date(text)
        assert re.sub(r"\d", "9", made) == re.sub(r"\d", "9", text) and back.date(made) == text
    for text in ["0000-01-01", "2021-02-29", "31/31/2020", "13/13/2020"]:
        assert names.date(text) is None


def test_values_beside_numbers_and_words_are_found():
    names = Pseudonyms(b"secret")
    for text, values in [
        ("pay 4041894974608795 12 items", ["4041894974608795"]),
        ("room 7 4041894974608795 due", ["4041894974608795"]),
        ("12 4041 8949 7460 8795 7th", ["4041 8949 7460 8795"]),
        ("1234 988-555-2485 4041894974608795 12", ["988-555-2485", "4041894974608795"]),
        ("to BE68 5390 0754 7034 BANK", ["BE68 5390 0754 7034"]),
        ("CD34 BE68 5390 0754 7034", ["BE68 5390 0754 7034"]),
        ("at 2021-02-28T10:00", ["2021-02-28"]),
        ("no 2021-02-28th, 1 2 3 4 5 6 7 8 9 10 11 12", []),
    ]:
        made, found = names.replace(text)
        assert [v for _, _, v, _ in found] == values
        assert all(text[s : s + len(v)] == v for _, s, v, _ in found)
        assert Pseudonyms(b"secret", undo=True).replace(made)[0] == text


def test_records_refer_to_their_sources(spark, tmp_path):
    page = '<html><head><title>A &amp; B</title><script>x="<p>"</script></head><body><p>One<br>two <a href="/x?a=1&amp;b=2">three</a></p><!-- no --></body>'
    assert page_text(page) == "A & B\nOne\ntwo three"
    pages = spark.createDataFrame([(1, "http://a/", page), (2, None, None), (None, "u", "")], "page_id long, url string, html string")
    source = responses(pages)
    records = derivatives(source)
    got = records.collect()
    assert len(got) == 6 and {r.record_type for r in got} == {"metadata", "conversion"}
    ids = {r.record_id for r in source.collect()}
    assert {r.refers_to for r in got} == ids and len({r.record_id for r in got}) == 6
    conversions = {r.record_id for r in got if r.record_type == "conversion"}
    assert {r.concurrent_to for r in got if r.record_type == "metadata"} == conversions
    assert {r.payload_digest for r in got} == {r.payload_digest for r in source.collect()}
    path = str(tmp_path / "out.warc")
    write_records(records, path)
    back = read_records(spark, path)
    assert back.where("not complete").count() == 0

    def plain(df):
        return sorted(tuple(map(str, r)) for r in df.select(*[c for c in records.columns]).collect())

    assert plain(back) == plain(records)
    assert derivatives(source.limit(0)).collect() == []
    # a response of another character set keeps its bytes
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\u00e9</p>".encode("latin-1")
    other = source.limit(1).withColumn("block", F.lit(bytearray(block)))
    path = str(tmp_path / "bytes.warc")
    write_records(other, path)
    again = read_records(spark, path)
    assert [bytes(r.block) for r in again.collect()] == [block]
    assert [bytes(r.block).decode() for r in derivatives(again).where("record_type = 'conversion'").collect()] == ["caf\u00e9"]


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p>a</p><svg class="i"/><p>rest of the page</p>', "a\nrest of the page"),
        ('<p>a</p><svg t="x>y"/><p>b</p><svg><path/>no</svg><p>c</p>', "a\nb\nc"),
        ("<p>a</p><svg><p>b</p>", "a\nb"),
        ("<p>a</p><noscript><p>b</p><noscript>no</noscript>c", "a\nb\nc"),
        ("<p>a</p><template><p>b</p>", "a\nb"),
        ("<p>a</p><!-- b <p>c</p>", "a\nb\nc"),
        ("a<!-->b<!--->c<!-- no --!>d", "a b c d"),
        ("a<svg>no<svg>no</svg>no</svg>b<svg/>c", "a b c"),
        ("a<script>'<svg><!--'</script>b<style>no", "a b"),
        ('<p title="a>b">c</p><p title = \'"a>b\'>d</p>', "c\nd"),
        ('a<svg><noscript>no</svg>no</noscript>b', "a b"),
        ("a < b <3 </ c <p", "a < b <3 </ c <p"),
        ('a<b x=">c<i>d</i>', "acd"),
        ("a<!DOCTYPE html>b<?xml x?>c<em>d</em>&lt;p&gt;", "abcd<p>"),
        ("a<script/>no</script x>b<script>no</scripts>no", "a b"),
    ],
)
def test_text_behind_unclosed_and_self_closed_tags_stays(page, text):
    assert page_text(page) == text


def test_links_and_titles_of_pages():
    page = """<svg><title>no</title></svg><title>A<b> &amp; </b>B</title><!-- <a href="/no"> --><script src=/s.js>'<a href="/no">'</script>
    <a title="x>y" href="/z">t</a><a data-href="/no" title=" href='/no' " HREF = '/q?a=1&amp;b'>u</a><a name=x>v</a></a href="/no">
    <img alt="" src=i.png><p href="/no"><a href="">w</a><title>C</title>"""
    text, title, links = page_facts(page)
    assert title == "A & B" and text.startswith("A & B")
    assert [(x["path"], x["url"]) for x in links] == [("script", "/s.js"), ("a", "/z"), ("a", "/q?a=1&b"), ("img", "i.png"), ("a", "")]
    assert page_facts("<title>x")[1:] == (None, []) and page_facts("") == ("", None, [])


@pytest.mark.parametrize(
    "part",
    ["<a ", "<svg ", "<svg>", "</svg>", "<title>", "<!--", "<!", "<script ", "</script", "<a<", "<a x=\"", "<a x='>", '<a x=">" ', "<?a", "=", "<a href=", "<a =\"'", "&#"],
)
def test_broken_pages_take_linear_time(part):
    """A page of 300 KB of one broken part; going over the rest for each of them would take minutes."""
    for end in ("", ">", '"'):
        for begin in ("", "<script>", "<p "):
            began = time.process_time()
            page_facts(begin + part * (300_000 // len(part)) + end)
            assert time.process_time() - began < 2


def test_label_model_finds_the_good_voters():
    pick = np.random.default_rng(1)
    truth = pick.random(4000) < 0.3
    right = [0.9, 0.85, 0.8, 0.55]
    votes = np.stack([np.where(pick.random(4000) < r, truth, ~truth) for r in right], axis=1).astype(int)
    votes = np.concatenate([votes, votes[:, 3:]], axis=1)  # a voter that copies another
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = LabelModel(patterns, counts, patterns.mean(axis=1))
    assert [3, 4] in model.cliques
    assert np.allclose(model.accuracies[:3], right[:3], atol=0.06)


@pytest.mark.parametrize("score, label", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_scores_of_odd_texts(spark, odd, none, score, label):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (6, None), (None, 1)], f"doc_id long, {label} int")
    got = score(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert score(none, labels).collect() == []
    assert {r.score for r in score(odd, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("name, label, least", [("op2_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    from pricetide.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = rows.select("score", label).toPandas()
    good, bad = found.score[found[label] == 1].to_numpy(), found.score[found[label] == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > least


def test_line_dedup_keeps_columns_with_names_of_its_own(spark):
    line = "a line of several words that repeats"
    rows = [(1, line, 5, "x", 7, 8), (2, "other words here first\n" + line, 6, "y", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines_deleted int, deleted string, _id long, _hash int")
    got = {r.doc_id: r.asDict() for r in without_repeated_runs(docs).collect()}
    assert got[2]["text"] == "other words here first\n" and got[2]["lines_deleted"] == 1
    assert (got[1]["_id"], got[1]["_hash"], got[2]["_id"], got[2]["_hash"]) == (7, 8, None, 9)
    assert got[1]["lines_deleted"] == 0 and got[1]["deleted"] is None


def test_lines_that_repeat_many_times_in_one_text_make_few_stretches(spark, tmp_path):
    """Each repeat meets the one before, so they are compared along one distance, not each along its own."""
    block = [" ".join(words(9, s)) + "." for s in range(8)]
    texts = [(k, "\n".join(block * 60) + f"\nend {k}") for k in range(3)]
    docs = spark.createDataFrame(texts, "id long, text string").withColumn("text_hash", F.xxhash64("text"))
    scratch = Scratch(spark)
    found = matches(with_lines(docs), scratch).collect()
    assert len(found) < 30
    got = without_repeated_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    left = {r.doc_id: r.text for r in got}
    assert left[0] == "\n".join(block) + "\nend 0"
    assert all(not any(line in left[k] for line in block) for k in (1, 2))
