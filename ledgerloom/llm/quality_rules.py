"""Quality rules: document statistics judged by monotonic gradient-boosted trees.

Statistics are computed over whole texts, many documents at once.  The trees are
fitted to a bounded sample of labelled rows (``SAMPLE``) and flattened into node
arrays; scoring walks all rows of a batch down one tree at a time.  Features that
may only speak against a text (symbols, repeated lines and passages, capitals) have
a monotonic constraint: more of them never raises the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import NOT_SPACE, byte_class, chunks, per_row_sum, shingle_hashes, utf8, word_hashes, words

#: labelled rows the trees are fitted to at most: those with the smallest hash of their id
SAMPLE = 20_000
WINDOW = 5
SYMBOLS = byte_class(lambda b: b in b"#*$%&|<>")
UPPER = byte_class(lambda b: 65 <= b <= 90)
DIGIT = byte_class(lambda b: 48 <= b <= 57)
MARKS = byte_class(lambda b: 33 <= b <= 126 and not chr(b).isalnum())
NO_TAIL = byte_class(lambda b: not 0x80 <= b <= 0xBF)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_chars", "n_upper", "n_digits", "n_marks", "n_lines", "n_distinct", "most_frequent"]


def _dup_lines(texts: list[str | None]) -> tuple[list[int], list[int]]:
    repeated, total = [], []
    for t in texts:
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")]
        total.append(len(lines))
        repeated.append(len(lines) - len(set(lines)))
    return repeated, total


def count_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text; a missing text has none of anything."""
    data, offsets = utf8(texts)
    w = words(data, offsets, NOT_SPACE)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    of_class = lambda kind: per_row_sum(kind[data], sizes)
    out = {"n_words": w.per_row.astype(np.int64), "word_chars": of_class(NOT_SPACE & NO_TAIL), "n_symbols": of_class(SYMBOLS),
           "n_chars": of_class(NO_TAIL), "n_upper": of_class(UPPER), "n_digits": of_class(DIGIT), "n_marks": of_class(MARKS)}
    out["n_dup_lines"], out["n_lines"] = (np.array(x, np.int64).reshape(n) for x in _dup_lines(texts.to_pylist()))
    h = word_hashes(w)[0]
    # windows that occur twice or more in their row, and the words they cover
    value, at = shingle_hashes(h, w.row, WINDOW)
    order = np.lexsort((value, w.row[at]))
    same = (value[order][1:] == value[order][:-1]) & (w.row[at][order][1:] == w.row[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = per_row_sum(np.cumsum(cover)[:-1] > 0, w.per_row)
    order = np.lexsort((h, w.row))
    lead = np.ones(len(h), bool)
    lead[1:] = (h[order][1:] != h[order][:-1]) | (w.row[order][1:] != w.row[order][:-1])
    head = np.flatnonzero(lead)
    out["n_distinct"] = np.bincount(w.row[order][head], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, w.row[order][head], np.diff(np.append(head, len(h))))
    out["most_frequent"] = most
    return {k: out[k].astype(np.int64) for k in COUNTS}


def statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, COUNTS) for each row; missing and empty texts have none of anything, repeated rows are counted one by one."""
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            got = count_statistics(b.column("t"))
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(got[k]) for k in COUNTS)], ["id", *COUNTS])

    kind = dict(given.dtypes)["id"]
    made = given.mapInArrow(run, ", ".join([f"id {kind}", *(f"{k} bigint" for k in COUNTS)]))
    return made.withColumnRenamed("id", id_col)


#: feature -> direction in which it may move the score: -1 only down, 0 freely
FEATURES = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "top_word_share": -1,
            "mark_share": 0, "digit_share": 0, "distinct_share": 0, "word_length": 0, "words": 0}


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    part = lambda a, b: c[a] / np.maximum(c[b], 1)
    return np.column_stack([
        part("n_symbols", "word_chars"), part("n_dup_lines", "n_lines"), part("n_repeat_words", "n_words"),
        part("n_upper", "word_chars"), part("most_frequent", "n_words"), part("n_marks", "word_chars"),
        part("n_digits", "word_chars"), part("n_distinct", "n_words"), part("word_chars", "n_words"), np.log1p(c["n_words"])])


@dataclass
class Trees:
    """Complete trees of equal depth in flat arrays: node i of a tree has the children 2i + 1 and 2i + 2."""

    base: float
    depth: int
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # a row goes right if its value is over the cut
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), (1 << self.depth) - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, direction: list[int], trees: int = 60, depth: int = 3, bins: int = 64,
              rate: float = 0.2, penalty: float = 1.0) -> Trees:
    """Logistic boosting on histograms.  With one class only the trees are flat.

    A constrained split must order its children; both then get a bound at their
    middle that no later leaf below them may cross, so the whole tree is monotonic.
    """
    n, d = x.shape
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.999
    inner, leaves = (1 << depth) - 1, 1 << depth
    model = Trees(np.log(share / (1 - share)), depth, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    if n == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(d)]
    binned = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(d)])
    total = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node, low, high = np.zeros(n, np.int64), {0: -np.inf}, {0: np.inf}
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = {k: (1e-6, None) for k in range(width)}
            for f in range(d):
                size = len(cuts[f]) + 1
                at = local * size + binned[:, f]
                gs, hs = (np.bincount(at, v, width * size).reshape(width, size) for v in (g, h))
                gl, hl = np.cumsum(gs, 1)[:, :-1], np.cumsum(hs, 1)[:, :-1]
                gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                bound = lambda v: np.clip(v, [[low[first + k]] for k in range(width)], [[high[first + k]] for k in range(width)])  # noqa: B023, E731
                vl, vr, vt = bound(gl / (hl + penalty)), bound((gt - gl) / (ht - hl + penalty)), bound(gt / (ht + penalty))
                gain = lambda v, a, b: a * v - 0.5 * (b + penalty) * v * v
                won = gain(vl, gl, hl) + gain(vr, gt - gl, ht - hl) - gain(vt, gt, ht)
                won[(hl < 1) | (ht - hl < 1) | (direction[f] * (vr - vl) < 0)] = -np.inf
                for k in range(width):
                    if won.shape[1] and won[k].max() > best[k][0]:
                        c = int(won[k].argmax())
                        best[k] = (won[k, c], (f, c, vl[k, c], vr[k, c]))
            for k in range(width):
                i, chosen = first + k, best[k][1]
                a, b = 2 * i + 1, 2 * i + 2
                low[a] = low[b] = low[i]
                high[a] = high[b] = high[i]
                if chosen:
                    f, c, left, right = chosen
                    model.feature[t, i], model.cut[t, i] = f, cuts[f][c]
                    if direction[f]:
                        middle = (left + right) / 2
                        (high if direction[f] > 0 else low)[a] = middle
                        (low if direction[f] > 0 else high)[b] = middle
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t][node]] > model.cut[t][node])
        local = node - inner
        gs, hs = np.bincount(local, g, leaves), np.bincount(local, h, leaves)
        value = np.clip(gs / (hs + penalty), [low[inner + k] for k in range(leaves)], [high[inner + k] for k in range(leaves)])
        model.leaf[t] = rate * value
        total += model.leaf[t][local]
    return model


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", bound: int = SAMPLE) -> Trees:
    """Trees for the labelled rows with the smallest hashes of their ids, ``bound`` at most.

    Missing ids and labels are left out, of several labels of an id the smallest counts.
    Without labelled rows, or with one label only, the trees are flat and all scores equal.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    chosen = marked.groupBy("id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(bound)
    rows = stats.join(F.broadcast(chosen), stats[id_col] == chosen.id).orderBy(F.xxhash64("id"), "id").limit(bound)
    got = rows.select("y", *COUNTS).toPandas()
    return fit_trees(features({k: got[k].to_numpy() for k in COUNTS}), got.y.to_numpy().astype(float), list(FEATURES.values()))


def with_scores(stats: DataFrame, trees: Trees, out: str = "score") -> DataFrame:
    """``stats`` with each row's score, from 0 to 1; equal counts score alike, a column of the output's name is replaced."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(trees.score(features({k: c.to_numpy() for k, c in zip(COUNTS, columns, strict=True)})))

    return stats.withColumn(out, score(*COUNTS))
