"""Toxicity by weak supervision.

1. Terms: whole words and word stems (first 4, 5 and 6 bytes) are counted over the
   labelled rows of a bounded sample; those found almost only in toxic rows form the
   lexicon, each a 64-bit hash.
2. Voters: the lexicon is dealt to voters by kind of term, strength and hash, and
   pattern voters look at how a text is written.  A voter says "toxic" or abstains;
   a last voter says "clean" where no lexicon term occurs.
3. Label model: a generative model of the votes of all documents.  Expectation and
   maximisation over the counted vote patterns estimate how often each voter fires
   on toxic and on clean texts; voters that still agree beyond that, given the class,
   are correlated, and their evidence is divided by the size of their bloc.
4. Classifier: logistic regression over the terms and patterns of the sample,
   trained on the label model's posteriors, scores every document.

Nothing but the text enters a score.  The label table is read only to choose terms
and to tell the label model which class is the toxic one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import ALNUM_LOWER, LOWER, byte_class, chunks, per_row_sum, utf8, word_hashes, words
from ledgerloom.session import durable

#: labelled rows of each class in the sample at most (smallest hashes of the id), and terms in the lexicon at most
PER_CLASS, TERMS = 8_000, 6_000
STEMS = (4, 5, 6)
#: a term needs this many sample rows and this share of toxic ones (after smoothing)
LEAST_ROWS, LEAST_SHARE = 5, 0.8
LEXICON_VOTERS = 8
PATTERNS = ["exclaims", "capitals"]
CLEAN = LEXICON_VOTERS + len(PATTERNS)
VOTERS = CLEAN + 1
UPPER = byte_class(lambda b: 65 <= b <= 90)
EXCLAMATION = byte_class(lambda b: b == 33)


def _terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term hash) of every word and stem, repeats included."""
    w = words(LOWER[data], offsets, ALNUM_LOWER)
    kinds = word_hashes(w, STEMS)
    row = np.tile(w.row, len(kinds))
    term = np.concatenate(kinds)
    # the lowest two bits tell the kind
    term = (term & ~np.uint64(3)) | np.repeat(np.arange(len(kinds), dtype=np.uint64), len(w.row))
    real = np.concatenate([k != 0 for k in kinds])
    return row[real], term[real]


def _patterns_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = np.maximum(np.diff(offsets), 1)
    sums = [per_row_sum(c[data], np.diff(offsets)) for c in (EXCLAMATION, UPPER)]
    return np.column_stack([sums[0] * 50 > n, sums[1] * 3 > n])


def choose_terms(sample: DataFrame) -> pd.DataFrame:
    """(term, n, toxic) of the lexicon, at most TERMS rows; ``sample`` has t and y."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            row, term = _terms_of(*utf8(b.column("t")))
            order = np.lexsort((row, term))
            row, term = row[order], term[order]
            lead = np.ones(len(row), bool)
            lead[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
            row, term = row[lead], term[lead]
            y = b.column("y").to_numpy(zero_copy_only=False)
            got, at, n = np.unique(term, return_index=True, return_counts=True)
            toxic = np.add.reduceat(y[row], at) if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(toxic.astype(np.int64))], ["term", "n", "toxic"])

    counted = sample.mapInArrow(count, "term bigint, n bigint, toxic bigint").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    strong = counted.where((F.col("n") >= LEAST_ROWS) & (F.col("toxic") / (F.col("n") + 1) >= LEAST_SHARE))
    return strong.orderBy(F.desc("toxic"), "n", "term").limit(TERMS).toPandas()


def with_votes(docs: DataFrame, lexicon: np.ndarray, voter_of: np.ndarray) -> DataFrame:
    """(id, terms, votes): positions in the sorted lexicon, and voter bits, of each row's whole text."""
    held = docs.sparkSession.sparkContext.broadcast((lexicon.tobytes(), voter_of.astype(np.int64).tobytes()))  # TERMS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, voter = np.frombuffer(held.value[0], np.uint64), np.frombuffer(held.value[1], np.int64)
        maybe = np.zeros(1 << 16, bool)
        maybe[known >> np.uint64(48)] = True
        for b in chunks(batches, "t"):
            data, offsets = utf8(b.column("t"))
            row, term = _terms_of(data, offsets)
            near = np.flatnonzero(maybe[term >> np.uint64(48)])
            row, term = row[near], term[near]
            at = np.minimum(np.searchsorted(known, term), max(len(known) - 1, 0))
            hit = known[at] == term if len(known) else np.zeros(len(term), bool)
            pair = np.unique(row[hit].astype(np.int64) << 32 | at[hit])
            own, place = pair >> 32, pair & 0xFFFFFFFF
            ends = np.searchsorted(own, np.arange(b.num_rows + 1))
            votes = _patterns_of(data, offsets) @ (1 << (LEXICON_VOTERS + np.arange(len(PATTERNS))))
            np.bitwise_or.at(votes, own, 1 << voter[place])
            votes[np.diff(ends) == 0] |= 1 << CLEAN
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists, pa.array(votes.astype(np.int32))], ["id", "terms", "votes"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, terms array<int>, votes int")


def deal_to_voters(lexicon: pd.DataFrame) -> np.ndarray:
    """Voter of each term: words and stems apart, by strength and hash."""
    term = lexicon.term.to_numpy().view(np.uint64)
    stem = (term & np.uint64(3)) > 0
    strong = lexicon.toxic.to_numpy() / (lexicon.n.to_numpy() + 1) > 0.95
    part = ((term >> np.uint64(8)) % np.uint64(2)).astype(int)
    return np.where(stem, 4, 0) + np.where(strong, 0, 2) + part


@dataclass
class LabelModel:
    prior: float
    fires: np.ndarray  # 2 x voters: how often a voter fires on clean and on toxic texts
    weight: np.ndarray  # a voter's share of its bloc's evidence

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on, off = np.log(self.fires), np.log1p(-self.fires)
        evidence = votes @ ((on[1] - on[0]) * self.weight) + (1 - votes) @ ((off[1] - off[0]) * self.weight)
        return 1 / (1 + np.exp(-(evidence + np.log(self.prior / (1 - self.prior)))))


def fit_label_model(votes: np.ndarray, n: np.ndarray, start: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """From distinct vote patterns and their counts; ``start``: 2 x voters, a first guess from the sample."""
    model = LabelModel(prior, np.clip(start, 1e-4, 1 - 1e-4), np.ones(votes.shape[1]))
    if not n.sum():
        return model
    for _ in range(rounds):
        p = model.posterior(votes)
        for c, own in enumerate((n * (1 - p), n * p)):
            # the first guess counts as a few rows, so that a class can't vanish or swap
            model.fires[c] = np.clip((own @ votes + 20 * start[c]) / (own.sum() + 20), 1e-4, 1 - 1e-4)
        model.prior = float(np.clip((n @ p + 20 * prior) / (n.sum() + 20), 1e-4, 0.5))
        # agreement given the class: correlations of what is left of the votes
        left = votes - (np.outer(1 - p, model.fires[0]) + np.outer(p, model.fires[1]))
        cov = (left * n[:, None]).T @ left / n.sum()
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        model.weight = 1 / np.maximum(np.clip(cov / np.outer(scale, scale), 0, 1).sum(1), 1.0)
    return model


def fit_linear(rows: np.ndarray, cols: np.ndarray, n_rows: int, width: int, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights (last: the constant) of a ridge-penalised logistic regression on soft labels, sparse 0/1 features."""
    w, grad_sum = np.zeros(width + 1), np.full(width + 1, 1e-8)
    w[width] = np.log(np.clip(y.mean(), 1e-3, 0.999) / (1 - np.clip(y.mean(), 1e-3, 0.999))) if n_rows else -4.0
    for _ in range(rounds if n_rows else 0):
        z = np.bincount(rows, w[cols], n_rows) + w[width]
        e = 1 / (1 + np.exp(-z)) - y
        g = np.append(np.bincount(cols, e[rows], width), e.sum()) / n_rows + 1e-5 * np.append(w[:width], 0)
        grad_sum += g * g
        w -= 0.5 * g / np.sqrt(grad_sum)
    return w


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, held_out, score) for each row of ``docs``.

    Labels of held-out rows are never read.  Missing and empty texts score like texts
    without any term.  Without labels of both classes the lexicon is empty and all
    rows have the same low score.  Where several rows share a labelled id, one of them
    takes part in the fit; each is scored by itself.
    """
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))
    known = labels.select(F.col(id_col).alias("k"), F.col(label).cast("long").alias("y")).where(
        "k is not null and y in (0, 1)").where(~held_out(F.col("k"))).groupBy("k").agg(F.max("y").alias("y"))
    ranked = [known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(PER_CLASS) for y in (0, 1)]
    chosen = durable(ranked[0].unionAll(ranked[1]))  # 2 * PER_CLASS rows at most
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 20)
    # one row for each chosen id, however many there are: that of the smallest hash, combined before the shuffle
    sample = given.join(F.broadcast(chosen), F.col("id") == F.col("k")).groupBy("k", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t")).select("t", "y")
    lexicon = choose_terms(sample) if len(counts) == 2 else pd.DataFrame({"term": np.zeros(0, np.int64), "n": [], "toxic": []})
    lexicon = lexicon.iloc[np.argsort(lexicon.term.to_numpy().astype(np.int64).view(np.uint64))]
    terms = lexicon.term.to_numpy().astype(np.int64).view(np.uint64)
    found = durable(with_votes(given, terms, deal_to_voters(lexicon)))

    seen = found.groupBy("votes").count().toPandas()  # 2 ^ VOTERS rows at most
    spread = lambda v: (v.to_numpy(np.int64)[:, None] >> np.arange(VOTERS) & 1).astype(float)
    rows = found.join(F.broadcast(chosen), F.col("id") == F.col("k")).groupBy("k", "y").agg(F.min(F.struct("votes", "terms")).alias("r")).select(
        "y", "r.terms", "r.votes").toPandas()  # 2 * PER_CLASS rows at most
    own = spread(rows.votes)
    start = np.array([(own[rows.y == c].sum(0) + 0.5) / ((rows.y == c).sum() + 1) for c in (0, 1)])
    label_model = fit_label_model(spread(seen.votes), seen["count"].to_numpy(float), start, prior)

    sizes = rows.terms.map(len).to_numpy(np.int64)
    term_row, term_col = np.repeat(np.arange(len(rows)), sizes), np.concatenate([np.zeros(0, np.int64), *rows.terms]).astype(np.int64)
    vote_row, vote_col = np.nonzero(own)
    weights = fit_linear(np.concatenate([term_row, vote_row]), np.concatenate([term_col, vote_col + len(terms)]), len(rows),
                         len(terms) + VOTERS, label_model.posterior(own))
    return _scored(found, weights, len(terms)).select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score")


def _scored(found: DataFrame, weights: np.ndarray, n_terms: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, votes = b.column("terms"), b.column("votes").to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), sizes)
            z = np.bincount(row, weights[ids.flatten().to_numpy(zero_copy_only=False)], b.num_rows) + weights[-1]
            z += (votes[:, None] >> np.arange(VOTERS) & 1) @ weights[n_terms: n_terms + VOTERS]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(1 / (1 + np.exp(-z)))], ["id", "score"])

    return found.select("id", "terms", "votes").mapInArrow(run, f"id {dict(found.dtypes)['id']}, score double")
