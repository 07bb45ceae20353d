"""The stages of the pipeline beside brute force, on rows with missing and repeated ids."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

# a column of documents, others whose names operators use inside
SCHEMA = "doc_id long, text string, n_chars long, row int, score string, ids int, lines_deleted int"
PICK = random.Random(3)


def text(n):
    return " ".join("".join(PICK.choice("abcdefghij") for _ in range(PICK.randint(3, 8))) for _ in range(n))


def frame(spark, texts):
    rows = [(key, x, None if x is None else len(x), n, f"s{n}", -n, 7) for n, (key, x) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_left(df):
    return sorted(r.row for r in df.collect())


def sets(x):
    words = (x or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels of documents 0 to 99, of which those of ten are toxic, and two benchmark items."""
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(k, int(k % 10 == 0), 1) for k in range(100)], "doc_id long, toxic int, quality int").write.parquet(
        f"{path}/labels.parquet"
    )
    items = [(1, text(30)), (2, text(12)), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


ODD = [(None, None), (5, None), (6, ""), (None, ""), (7, " \n\t"), (7, " \n\t")]


def check_columns(stage, spark, folder):
    given = frame(spark, ODD)
    assert stage(spark, given, folder).schema == given.schema
    assert stage(spark, given.limit(0), folder).collect() == []


def test_toxic_rows_go_whatever_their_ids(spark, folder):
    def words(toxic):
        return text(20) + (" you worthless pathetic idiot scum " if toxic else " fine weather ") + text(20)

    texts = [(k, words(k % 10 == 0)) for k in range(100)]
    texts += [(None, words(True)), (None, words(False)), (1, words(True)), (10, words(False)), (None, words(True)), *ODD]
    docs = frame(spark, texts)
    left = rows_left(corpus_pipeline.toxicity(spark, docs, folder))
    toxic = [n for n, (_, x) in enumerate(texts) if x and "idiot" in x]
    assert left == [n for n in range(len(texts)) if n not in toxic]
    check_columns(corpus_pipeline.toxicity, spark, folder)
    none = spark.read.parquet(f"{folder}/labels.parquet").limit(0)
    assert corpus_pipeline.without_toxic(docs, none).count() == len(texts)


def test_repeated_lines_go(spark, folder):
    run = "\n".join(text(12) + "." for _ in range(6))
    texts = [(1, "first\n" + run), (2, "second\n" + run + "\nend"), (None, run), (3, run), (3, run), (4, "short"), *ODD]
    got = {r.row: r for r in corpus_pipeline.line_dedup(spark, frame(spark, texts), folder).collect()}
    assert sorted(got) == [0, 1, *range(5, 12)]
    assert got[0].text == texts[0][1] and got[1].text == "second\nend" and got[1].n_chars == 10 and got[0].lines_deleted == 7
    assert all(got[n].text == texts[n][1] and got[n].score == f"s{n}" for n in range(5, 12))
    check_columns(corpus_pipeline.line_dedup, spark, folder)


def test_one_row_of_each_group_of_near_duplicates_stays(spark, folder):
    base = [text(80) for _ in range(6)]
    changed = [x.rsplit(" ", 2)[0] + " other end" for x in base]
    texts = [(10 - n, x) for n, x in enumerate(base)] + [(None, x) for x in changed[:3]] + [(20, changed[3]), (20, text(60))]
    texts += [(21, base[4]), (21, base[4]), (22, "two words"), (22, "two words"), *ODD]
    left = rows_left(corpus_pipeline.near_dedup(spark, frame(spark, texts), folder))
    known = [sets(x) for _, x in texts]
    order = sorted(range(len(texts)), key=lambda n: (texts[n][0] is None, texts[n][0] or 0, texts[n][1] or "", n))
    groups = {n: n for n in order}
    for _ in order:
        for a in order:
            for b in order:
                if known[a] and 100 * len(known[a] & known[b]) >= 80 * len(known[a] | known[b]):
                    groups[b] = min(groups[a], groups[b], key=order.index)
    best = {groups[n] for n in order}
    equal = {(texts[n][0], texts[n][1]) for n in best}  # of equal rows either may stay
    assert len(left) == len(best) and {(texts[n][0], texts[n][1]) for n in left} == equal
    unique = [(n, x) for n, (_, x) in enumerate(texts)]
    assert len(rows_left(corpus_pipeline.near_dedup(spark, frame(spark, unique), folder))) == len(best)
    check_columns(corpus_pipeline.near_dedup, spark, folder)


def test_contaminated_rows_go_whatever_their_ids(spark, folder):
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    long = next(x for x in items if x and len(x.split()) == 30)
    short = next(x for x in items if x and len(x.split()) == 12)
    half = " ".join(long.split()[:15])
    texts = [(1, text(500) + " " + long), (None, text(9) + " " + short.upper()), (None, text(40)), (2, half), (2, long), (3, text(30)), *ODD]
    left = rows_left(corpus_pipeline.decontamination(spark, frame(spark, texts), folder))
    wanted = [sets(x) for x in items if sets(x)]
    assert left == [n for n, (_, x) in enumerate(texts) if not any(100 * len(sets(x) & w) >= 80 * len(w) for w in wanted)]
    assert {0, 1, 4}.isdisjoint(left) and {2, 3, 5} <= set(left)
    check_columns(corpus_pipeline.decontamination, spark, folder)


def test_encoding_and_the_whole_run(spark, folder, tmp_path):
    texts = [(n, text(40) + " you worthless pathetic idiot scum" * (n % 10 == 0)) for n in range(60)]
    texts += [(100, texts[7][1]), (101, None), (None, text(20)), (102, "")]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    step = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        step = function(spark, step, str(tmp_path))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted((-1 if r.doc_id is None else r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in step.collect())
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got.collect()) == expected
    assert {100, 0, 10}.isdisjoint(k for k, _ in expected) and {101, -1, 102, 7} <= {k for k, _ in expected}
