"""Toxicity by weak supervision.

Voters are lexicons (words and word beginnings that a sample of labels sets apart, split
by kind and strength, and a short public list) and patterns. Their votes on all documents
are counted by pattern, a generative model of the voters gives every pattern a posterior,
and a linear classifier over hashed words and word beginnings learns the posteriors.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.label_model import LabelModel
from pricetide.llm.learning import fit, labelled_sample, scored, with_scores
from pricetide.llm.shipping import map_batches
from pricetide.llm.words import NOT_LETTERS, mix, pieces, running_hash, shingles, span_hashes, sums, word_bounds

BITS = 20
SAMPLE_ROWS = 12_288
EPOCHS = 2
THRESHOLD = 0.5
#: Lengths in bytes of the word beginnings looked at; 0 is the whole word.
BEGINNINGS = (0, 4, 5, 6, 7, 8)
#: A token enters a lexicon with so many toxic sample documents and this share of toxic ones.
LEAST_DOCUMENTS, LEAST_SHARE, STRONG_SHARE, LEXICON_TOKENS = 4, 0.8, 0.95, 4096
# fixed values: common English insults
INSULTS = "idiot moron stupid dumb fool loser trash garbage scum pathetic worthless disgusting clown".split()
_U = np.uint64


def tokens(data, offsets):
    """For each length of `BEGINNINGS` the hashes of the words' beginnings; and where each text's words begin."""
    starts, ends, firsts = word_bounds(data, offsets, NOT_LETTERS)
    running = running_hash(data)
    found = []
    with np.errstate(over="ignore"):
        for kind, length in enumerate(BEGINNINGS):
            stops = ends if not length else np.minimum(starts + length, ends)
            hashes = mix(span_hashes(running, starts, stops) + _U(kind))
            if length:  # shorter words have no beginning of this length
                hashes[ends - starts < length] = 0
            found.append(hashes)
    return found, firsts


def token_index(hashes):
    return (hashes >> _U(64 - BITS)).astype(np.int64)


def features(column):
    """Distinct hashed tokens of each text, all of value 1."""
    for _, data, offsets in pieces(column):
        kinds, firsts = tokens(data, offsets)
        for a, b in zip(firsts[:-1], firsts[1:]):
            own = np.concatenate([k[a:b] for k in kinds])
            index = np.unique(token_index(own[own != 0]))
            yield index, np.ones(len(index))


def _lexicon_task(batches):
    """Toxic documents come first; clean ones then only need counting for tokens seen so far.

    Of toxic documents with the same smallest shingle, most often copies, one is counted,
    or whatever else is in them would look like a mark.
    """
    toxic, copies = [{} for _ in BEGINNINGS], set()
    clean, known = None, None
    for batch in batches:
        labels = batch.column(2).to_numpy(zero_copy_only=False)
        for first, data, offsets in pieces(batch.column(1)):
            kinds, firsts = tokens(data, offsets)
            starts = shingles(kinds[0], firsts, 3)
            for i, (a, b) in enumerate(zip(firsts[:-1], firsts[1:])):
                is_toxic = labels[first + i] > 0.5
                if a == b:
                    continue
                smallest = int(starts[0][starts[1][i] : starts[1][i + 1]].min())
                if is_toxic and smallest in copies:
                    continue
                copies.add(smallest)
                if not is_toxic and known is None:
                    known = [np.array(sorted(t for t, n in seen.items() if n >= LEAST_DOCUMENTS), np.uint64) for seen in toxic]
                    clean = [np.zeros(len(k), np.int64) for k in known]
                for kind, hashes in enumerate(kinds):
                    own = np.unique(hashes[a:b])
                    own = own[own != 0]
                    if is_toxic:
                        seen = toxic[kind]
                        for x in own.tolist():
                            seen[x] = seen.get(x, 0) + 1
                    elif len(known[kind]) and len(own):
                        at = np.minimum(np.searchsorted(known[kind], own), len(known[kind]) - 1)
                        clean[kind][at[known[kind][at] == own]] += 1
    if known is None:
        known = [np.array(sorted(t for t, n in seen.items() if n >= LEAST_DOCUMENTS), np.uint64) for seen in toxic]
        clean = [np.zeros(len(k), np.int64) for k in known]
    for kind, (found, no) in enumerate(zip(known, clean)):
        yes = np.array([toxic[kind][x] for x in found.tolist()], np.int64)
        share = yes / np.maximum(yes + no, 1)
        order = np.lexsort((found, -yes))
        order = order[share[order] >= LEAST_SHARE][:LEXICON_TOKENS]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(order), kind, np.int32)),
                pa.array(share[order] >= STRONG_SHARE),
                pa.array(found[order].view(np.int64)),
            ],
            names=["kind", "strong", "token"],
        )


def lexicons(sample):
    """[(kind, sorted token hashes)] of the lexicon voters: strong and weak ones of each kind, and the public list."""
    ordered = sample.repartitionByRange(1, F.desc("label"), "order").sortWithinPartitions(F.desc("label"), "order", "text")
    rows = map_batches(ordered, _lexicon_task, "kind int, strong boolean, token long").collect()
    found = []
    for kind in range(len(BEGINNINGS)):
        for strong in (True, False):
            own = [r["token"] for r in rows if r["kind"] == kind and r["strong"] == strong]
            found.append((kind, np.sort(np.array(own, np.int64).view(np.uint64))))
    data = np.frombuffer(" ".join(INSULTS).encode(), np.uint8)
    listed, _ = tokens(data, np.array([0, len(data)]))
    return [*found, (0, np.sort(listed[0]))]


def votes(column, found):
    """One row of votes for each text: 1, 0 or -1 from every lexicon, then from the patterns.

    A lexicon votes 1 on a text with one of its tokens and else nothing. Patterns: 0 if no
    strong lexicon has a token of the text, and 1 if such tokens are a fortieth of its words.
    """
    out = [np.zeros((0, len(found) + 2), np.int8)]
    for _, data, offsets in pieces(column):
        kinds, firsts = tokens(data, offsets)
        row = np.full((len(offsets) - 1, len(found) + 2), -1, np.int8)
        hits = np.zeros(len(kinds[0]), bool)
        for v, (kind, known) in enumerate(found):
            if len(known):
                at = np.minimum(np.searchsorted(known, kinds[kind]), len(known) - 1)
                hit = known[at] == kinds[kind]
                row[sums(hit.astype(np.int64), firsts) > 0, v] = 1
                if v % 2 == 0:  # the strong ones and the public list
                    hits |= hit
        share = sums(hits.astype(np.int64), firsts) / np.maximum(np.diff(firsts), 1)
        row[share == 0, -2] = 0
        row[share >= 1 / 40, -1] = 1
        out.append(row)
    return np.concatenate(out)


def vote_counts(docs, found, text):
    """(pattern, rows) over all documents: at most three to the number of voters, in practice some dozens."""

    def run(batches):
        total = {}
        for batch in batches:
            rows, counts = np.unique(votes(batch.column(0), found), axis=0, return_counts=True)
            for row, count in zip(rows, counts.tolist()):
                total[row.tobytes()] = total.get(row.tobytes(), 0) + count
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["pattern", "rows"]
        )

    counts = map_batches(docs.select(F.col(text).cast("string").alias("text")), run, "pattern binary, rows long")
    return counts.groupBy("pattern").agg(F.sum("rows").alias("rows"))


def train(docs, labels, rows=SAMPLE_ROWS, text="text", key="doc_id", label="toxic"):
    """The classifier's weights and the label model (None without documents)."""
    sample = labelled_sample(docs, labels, label, rows, text, key)
    found = lexicons(sample)
    counted = sorted((bytes(r["pattern"]), r["rows"]) for r in vote_counts(docs, found, text).collect())
    if not counted:
        return np.zeros((1 << BITS) + 1, np.float32), None
    patterns = np.array([np.frombuffer(p, np.int8) for p, _ in counted])
    # the first guess: a majority of the votes cast
    yes, no = (patterns == 1).sum(1), (patterns == 0).sum(1)
    model = LabelModel(patterns, [n for _, n in counted], (yes + 0.1) / (yes + no + 1))
    posterior = {p: x for (p, _), x in zip(counted, model.posterior.tolist())}

    def relabel(batches):
        for batch in batches:
            soft = [posterior.get(v.tobytes(), 0.5) for v in votes(batch.column(1), found)]
            yield batch.set_column(2, "label", pa.array(soft, pa.float64()))

    schema = "order long, text string, label double"
    weights = fit(map_batches(sample, relabel, schema), features, 1 << BITS, EPOCHS, alpha=0.3, l1=0.5, l2=0.1)
    return weights, model


def scorer(weights):
    def score(column):
        parts = [np.zeros(0)]
        for _, data, offsets in pieces(column):
            kinds, firsts = tokens(data, offsets)
            total = np.full(len(offsets) - 1, float(weights[-1]))
            of_text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
            for hashes in kinds:
                weight = weights[token_index(hashes)]
                at = np.flatnonzero((weight != 0) & (hashes != 0))
                # each token counts once in a text
                pair = np.unique(np.stack([of_text[at], token_index(hashes[at])]), axis=1)
                total += np.bincount(pair[0], weights[pair[1]], len(total))
            parts.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return np.concatenate(parts)

    return score


def toxicity_scores(docs, labels, rows=SAMPLE_ROWS, threshold=THRESHOLD, text="text", key="doc_id", label="toxic"):
    """A toxicity score for every row of `docs`: doc_id, held_out, score, predicted.

    Lexicons and classifier are fitted on at most `rows` labelled documents outside the
    held-out fold; the voters are judged on the votes of all documents. Scores use the
    text alone. A text without words (null, empty, signs only) gets the score of the bias.
    Without documents there are no rows; without labels the short public list and the
    patterns give the votes and, as there is nothing to learn on, every score is 0.5. Rows
    that repeat an id are scored each; a null id is scored too and not held out.
    """
    weights, _ = train(docs, labels, rows, text, key, label)
    return scored(docs, scorer(weights), threshold, text, key)


def without_toxic(docs, labels, rows=SAMPLE_ROWS, threshold=THRESHOLD, text="text", key="doc_id", label="toxic"):
    """The rows of `docs` that `toxicity_scores` scores under `threshold`, with all their columns.

    Each row is judged by its own text: rows with a null or repeated id go or stay like others.
    Null and empty texts have the score of the bias. Where there are no labels every score is
    0.5 and tells nothing, so all rows stay. No rows give no rows.
    """
    weights, model = train(docs, labels, rows, text, key, label)
    if model is None or not weights.any():
        return docs
    name = "score"
    while name in docs.columns:
        name += "_"
    judged = with_scores(docs, scorer(weights), name, text)
    return judged.where(F.col(name) < threshold).select(*docs.columns)
