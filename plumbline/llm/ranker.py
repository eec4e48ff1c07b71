"""Quality scores by Bradley-Terry ranking: a good document is preferred to a poor one, so their features' differences decide.

Features are shares and ratios of a text's bytes, words and lines; no label, language, source or id is among them. From
labelled documents, pairs of a good and a poor one are drawn; the weights minimise the logistic loss of the difference of
their features. A document's raw score is the weighted sum. The threshold is a quantile of the labelled raw scores: the one
that parts the classes best. Scores are squashed so that the threshold is at 0.7.

Training sees at most `MAX_LABELLED` documents of each class, the first in the order of a hash; that bound keeps what the
driver holds to a few megabytes. Labelled rows are counted first, and only those whose hash lies below the share that is
needed are looked at: their texts are found by a join with at most some ten thousand ids, and no task sorts more. Scores are
computed for every document, from its whole text, in one pass.

Defined cases: text NULL counts as empty; empty texts have a score too. Labels that are NULL, held out, or whose document
is missing teach nothing; a document with several labels counts once for each. Unless both classes are known, nothing can
be learned, and every document's score is the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import settle
from plumbline.llm.words import windows, words

MAX_LABELLED = 20_000
PAIRS = 60_000
PENALTY = 1e-3
SEED = "rank-1"
THRESHOLD = 0.7

FEATURES = (
    "log_words", "letters", "digits", "upper", "space", "wide", "marks", "symbols", "bars", "shouts", "other",
    "word_length", "short_words", "long_words", "marked_words", "distinct_words", "repeated_windows", "log_lines", "line_words", "repeated_lines",
)


def _classes() -> np.ndarray:
    """A class for each byte: lower letter, upper letter, digit, space, part of a wider character, mark, symbol, bar, shout, other."""
    table = np.full(256, 9, np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 0, 1, 2, 4
    for chars, number in ((b" \t\n\v\f\r", 3), (b".,;:'\"-()?", 5), (b"#*$%&<>=+/\\^~_@{}[]", 6), (b"|", 7), (b"!", 8)):
        table[list(chars)] = number
    return table


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def features(texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    out, classes = [], _classes()
    for w in words(texts):
        n, rows = w.counts().astype(float), w.rows
        sizes = np.diff(w.offsets)
        of_byte = np.repeat(np.arange(rows), sizes)
        kinds = classes[w.data]
        count = np.bincount(of_byte * 10 + kinds, minlength=rows * 10).reshape(rows, 10).astype(float)
        letters = count[:, 0] + count[:, 1] + count[:, 4]
        total = np.maximum(sizes, 1)
        lengths = w.end - w.start
        per = lambda mask: np.bincount(w.doc, mask, rows)
        marked = (kinds[w.start] >= 6) | (kinds[w.end - 1] >= 6) if len(w.start) else np.zeros(0, bool)
        hashes = w.hashes()
        own = hashes ^ (w.doc.astype(np.uint64) << np.uint64(40))
        distinct = np.bincount(w.doc[np.unique(own, return_index=True)[1]], minlength=rows)
        three, at = windows(hashes, w.doc, 3)
        docs3 = w.doc[at]
        known = np.unique(three ^ (docs3.astype(np.uint64) << np.uint64(40)), return_index=True)[1]
        n3 = np.bincount(docs3, minlength=rows)
        repeated = n3 - np.bincount(docs3[known], minlength=rows)
        lines, again = np.zeros(rows), np.zeros(rows)
        for i in range(rows):
            parts = [x for x in w.text(i).split(b"\n") if x.strip()]
            lines[i], again[i] = len(parts), len(parts) - len(set(parts))
        out.append(
            np.column_stack(
                [
                    np.log1p(n), letters / total, count[:, 2] / total, _ratio(count[:, 1], letters), count[:, 3] / total,
                    count[:, 4] / total, count[:, 5] / total, count[:, 6] / total, count[:, 7] / total, count[:, 8] / total,
                    count[:, 9] / total, _ratio(per(lengths), n), _ratio(per(lengths <= 2), n), _ratio(per(lengths > 20), n),
                    _ratio(per(marked), n), _ratio(distinct, n), _ratio(repeated, n3), np.log1p(lines), np.log1p(_ratio(n, lines)),
                    _ratio(again, lines),
                ]
            )
        )
    return np.vstack(out) if out else np.zeros((0, len(FEATURES)))


def _feature_lists(texts: pa.Array) -> pa.Array:
    found = features(texts)
    return pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES), found.ravel()).cast(pa.list_(pa.float64()))


def feature_column(text: Column) -> Column:
    return F.arrow_udf(_feature_lists, T.ArrayType(T.DoubleType()))(text)


@dataclass(frozen=True)
class Ranker:
    """score = sigmoid(sum of weight * clipped standardised feature - threshold + logit(0.7))."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weight: tuple[float, ...]
    threshold: float

    def raw(self, found: Column) -> Column:
        total = F.lit(0.0)
        for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weight, strict=True)):
            total = total + F.lit(w) * F.greatest(F.lit(-5.0), F.least(F.lit(5.0), (found[i] - F.lit(m)) / F.lit(s)))
        return total

    def score(self, found: Column) -> Column:
        offset = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(self.raw(found) - F.lit(self.threshold) + F.lit(offset))))

    def accepts(self, found: Column) -> Column:
        return self.score(found) >= F.lit(THRESHOLD - 1e-12)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, seed: int = 1) -> Ranker:
    """Learns from rows of features and labels 0 or 1."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(poor):
        return Ranker((0.0,) * width, (1.0,) * width, (0.0,) * width, 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -5, 5)
    draw = np.random.default_rng(seed)
    diff = z[draw.choice(good, pairs)] - z[draw.choice(poor, pairs)]
    w = np.zeros(width)
    for _ in range(50):  # Newton's steps; the penalty keeps the Hessian regular
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # of the poor one being preferred
        gradient = penalty * w - diff.T @ p / pairs
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + penalty * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    raw = z @ w
    order = np.argsort(raw, kind="stable")
    caught = np.concatenate([[0], np.cumsum(y[order] == 0)]) / len(poor)
    lost = np.concatenate([[0], np.cumsum(y[order] == 1)]) / len(good)
    cut = int(np.argmax(caught - lost))  # so many of the lowest scores are rejected
    ranked = raw[order]
    threshold = ranked[0] - 1 if cut == 0 else ranked[-1] + 1 if cut == len(ranked) else (ranked[cut - 1] + ranked[cut]) / 2
    return Ranker(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w)), float(threshold))


def held_out(ident: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.crc32(F.encode(F.coalesce(ident.cast("string"), F.lit("")), "utf-8")) % 4 == 2


#: More labelled rows are looked at than are needed, by this share and number, as hashes do not fall evenly.
SLACK, SPARE = 1.1, 500


def _draw(ident: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}:"), ident.cast("string")))


def sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Of (doc_id, text) and (doc_id, quality): text and quality of the first labelled rows of each class, by hash."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("of"), "quality")
    there = docs.select("doc_id").join(known, F.col("doc_id") == F.col("of"))
    there = settle(there.groupBy("of", "quality").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["quality"]: r["n"] for r in there.groupBy("quality").agg(F.sum("n").alias("n")).collect()}
    low = F.conv(F.substring(_draw(F.col("of")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    parts = []
    for quality, n in sorted(counts.items()):
        share = min(1.0, (max_labelled * SLACK + SPARE) / n)
        while True:  # once, unless hashes fall very unevenly
            near = there.filter((F.col("quality") == quality) & (low < F.lit(share)))
            if share >= 1 or (near.agg(F.sum("n")).first()[0] or 0) >= max_labelled:
                break
            share = min(1.0, 2 * share)
        parts.append(near)
    if not parts:
        return docs.select("text", F.lit(None).cast("int").alias("quality")).limit(0)
    ids = settle((parts[0] if len(parts) == 1 else parts[0].union(parts[1])).select("of", "quality"))
    rows = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("of"))  # twice max_labelled ids and some
    first = [rows.filter(F.col("quality") == q).orderBy(_draw(F.col("of")), "of").limit(max_labelled) for q in sorted(counts)]
    return (first[0] if len(first) == 1 else first[0].union(first[1])).select("text", "quality")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker:
    """`docs` has (doc_id, text), `labels` has (doc_id, quality)."""
    rows = sample(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), max_labelled)
    found = rows.select("quality", feature_column(F.col("text")).alias("features")).collect()  # at most max_labelled rows of each class
    # the order of rows must not decide: sums of doubles depend on it
    found = sorted((tuple(r["features"]), r["quality"]) for r in found)
    x = np.array([f for f, _ in found], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([q for _, q in found], int))


def score_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row of (doc_id, text): doc_id, held_out, score, predicted."""
    ranker = train(docs, labels, max_labelled)
    found = docs.select("doc_id", feature_column(F.col("text")).alias("features"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(ranker.accepts(F.col("features")), F.greatest(ranker.score(F.col("features")), F.lit(THRESHOLD)))
        .otherwise(ranker.score(F.col("features")))
        .alias("score"),
        ranker.accepts(F.col("features")).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = work.select("doc", feature_column(F.col("doc.text")).alias("features"))
    ranker = train(work.select("doc.doc_id", "doc.text"), labels, max_labelled)
    return rows.filter(ranker.accepts(F.col("features"))).select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
