"""Quality rules with tokeniser fertility: how a public vocabulary cuts a text tells prose from what is none.

Every word is cut by the vocabulary, with a space before it. Of each document: characters per token, the share of tokens
that stand for single bytes, and the entropy of its tokens, against the most that so many tokens can have. Bands are drawn
for each language, or script where the language is unknown, and each class of length (half an octave of token counts):
quartiles of the documents that pass the base rules, equal measures counting once, widened by a multiple of their distance,
and at least by a given margin that grows as a text gets shorter. A document outside a band is rejected, beside the base rules.
A class of fewer than `LEAST_IN_CLASS` documents takes the quartiles of the next shorter one that has enough, the shortest
classes those of the next longer one; a language without any such class has one band, from all its documents.

One pass over the texts; the quartiles come from its small result, combined before the shuffle.

Defined cases: text NULL has no words. A document with fewer than `LEAST_TOKENS` tokens, by default one with none, is not
judged by the bands. Rows with the same id stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import settle
from plumbline.llm.words import SPACES, mix, windows, words

MODEL = "piece_bpe_32k.model"
LEAST_TOKENS = 1
WIDTH = 2.0
#: Documents from which a class of length has quartiles of its own; classes in all; the number of a whole language.
LEAST_IN_CLASS, CLASSES, WHOLE = 40, 64, -1
#: measure: (least margin below the first quartile, least margin above the third); None: no bound on that side. A margin has
#: a part that holds at any length and one that is divided by the root of the token count, as a mean over tokens varies.
BANDS = {"chars_per_token": ((0.25, 4.0), (0.25, 4.0)), "byte_share": (None, (0.05, 1.0)), "entropy_bits": ((0.0, 8.0), None)}
#: Entropy grows with the token count and its share of the most possible falls, so with both below their bounds, a text is
#: poorer than those of its length wherever it lies in its class, also where the quartiles are those of a neighbouring class.
ENTROPY = ("entropy_bits", "entropy_share")
MEASURED = (*BANDS, "entropy_share")
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Measures are counted in steps of this for the quartiles.
STEP = 1e-4
SYMBOLS = b"#*$%&|<>"
CACHED_WORDS = 300_000

MEASURES = (
    "doc_id long, band string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, entropy_share double"
)


def vocabulary_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Ids of words, remembered by the words' hashes: a word is cut once while the memory lasts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.vocab_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.known: dict[int, np.ndarray] = {}

    def cut(self, hashes: np.ndarray, word_of) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words: all their ids, one word's after the other's, and their numbers."""
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        keys = hashes.tolist()
        missing = [i for i, k in enumerate(keys) if k not in self.known]
        if missing:
            texts = [word_of(i).decode("utf-8", "replace") for i in missing]
            for i, ids in zip(missing, self.model.encode(texts, num_threads=1), strict=True):
                self.known[keys[i]] = np.array(ids, np.int32)
        parts = [self.known[k] for k in keys]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array([len(p) for p in parts], np.int64)


@cache
def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker, whatever the number of its tasks."""
    return Vocabulary(path)


def _repeated(hashes: np.ndarray, doc: np.ndarray, rows: int, length: int = 8) -> np.ndarray:
    """Words in windows that occur twice or more in their text."""
    found, at = windows(hashes, doc, length)
    found = mix(found + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))  # of one document
    order = np.argsort(found)
    same = found[order][1:] == found[order][:-1]
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + length, -1)
    return np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=rows)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def _script(data: np.ndarray, of_byte: np.ndarray, rows: int) -> list[str]:
    """By the first bytes of characters beyond ASCII; what has fewer of them than letters is Latin."""
    names = ["latin", "greek_cyrillic", "east_asian", "other"]
    kind = np.full(256, -1, np.int64)
    kind[65:91] = kind[97:123] = kind[0xC3:0xCA] = 0
    kind[0xCD:0xD4], kind[0xE3:0xEE], kind[0xD4:0xE3], kind[0xEE:0xF8] = 1, 2, 3, 3
    kinds = kind[data]
    seen = kinds >= 0
    count = np.bincount(of_byte[seen] * 4 + kinds[seen], minlength=rows * 4).reshape(rows, 4)
    return [names[i] for i in count.argmax(1)]


def measure(path: str):
    """The pass over the texts, for mapInArrow over (doc_id, lang, text)."""
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            ids, langs, texts = (batch.column(i) for i in range(3))
            for w in words(texts):
                rows, n = w.rows, w.counts()
                of_byte = np.repeat(np.arange(rows), np.diff(w.offsets))
                # the first byte of a character is no continuation byte; white space is none in a word
                per_byte = np.zeros(len(w.data) + 1, np.int64)
                np.cumsum((w.data & 0xC0) != 0x80, out=per_byte[1:])
                chars = np.bincount(w.doc, per_byte[w.end] - per_byte[w.start], rows).astype(np.int64)
                symbols = np.bincount(of_byte[symbol[w.data]], minlength=rows)
                hashes = w.hashes()
                distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
                cut, sizes = vocab.cut(distinct, lambda i, w=w, first=first: w.data[w.start[first[i]] : w.end[first[i]]].tobytes())
                begin = np.concatenate([[0], np.cumsum(sizes)])
                each = sizes[which]  # tokens of each word of the text
                tokens = np.bincount(w.doc, each, rows).astype(np.int64)
                total = int(each.sum())
                place = np.arange(total) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin[which], each)
                token, doc = cut[place], np.repeat(w.doc, each)
                bytes_ = np.bincount(doc[vocab.is_byte[token]], minlength=rows)
                pair = np.sort(doc.astype(np.int64) * vocab.size + token)
                edge = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if total else np.zeros(0, np.int64)
                often = np.diff(np.concatenate([edge, [total]]))
                spread = np.bincount(pair[edge] // vocab.size, often * np.log2(np.maximum(often, 1)), rows)
                many = np.maximum(tokens, 2)
                entropy = (np.log2(many) - spread / many) / np.log2(many)
                lang = langs.slice(w.first, rows).to_pylist()
                band = [a if a is not None else f"script:{b}" for a, b in zip(lang, _script(w.data, of_byte, rows), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(w.first, rows),
                        pa.array(band, pa.string()),
                        *(
                            pa.array(x.astype(np.int64))
                            for x in (
                                n,
                                chars,
                                symbols,
                                np.array([_dup_lines(w.text(i)) for i in range(rows)]),
                                _repeated(hashes, w.doc, rows),
                                tokens,
                            )
                        ),
                        pa.array(chars / np.maximum(tokens, 1)),
                        pa.array(bytes_ / np.maximum(tokens, 1)),
                        pa.array(entropy.astype(float)),
                    ],
                    names=[x.split()[0] for x in MEASURES.split(", ")],
                )

    return run


def _base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def _length_class() -> Column:
    return F.least(F.floor(F.log2(F.greatest("n_tokens", F.lit(1))) * 2), F.lit(CLASSES - 1)).cast("int")


def _log_tokens() -> Column:
    return F.log2(F.greatest("n_tokens", F.lit(2)))


def _quartiles(values: DataFrame) -> DataFrame:
    """Per (of_band, at): n and both quartiles of each measure, from the counts of every measure in steps of `STEP`. Unlike
    those of a sketch they do not depend on the order in which tasks end."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m) / STEP).cast("long").alias("value")) for m in MEASURED])
    counts = values.select("of_band", "at", F.inline(cells)).groupBy("of_band", "at", "measure", "value").agg(F.count(F.lit(1)).alias("c"))
    group = Window.partitionBy("of_band", "at", "measure")  # as many rows as a measure has steps
    counts = counts.withColumns({"total": F.sum("c").over(group), "upto": F.sum("c").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))})

    def at(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), F.col("value"))) * STEP

    found = counts.groupBy("of_band", "at", "measure").agg(F.max("total").alias("n"), F.array(at(0.25), at(0.75)).alias("quartiles"))
    wide = [F.max(F.when(F.col("measure") == m, F.col("quartiles"))).alias(f"{m}_quartiles") for m in MEASURED]
    return found.groupBy("of_band", "at").agg(F.max("n").alias("n"), *wide)


def bands(measured: DataFrame, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """Per language or script and class of length: both quartiles of each measure, for every class."""
    judged = measured.filter(F.col("n_tokens") >= least_tokens).withColumn("entropy_bits", F.col("entropy_share") * _log_tokens())
    values = judged.select("band", _length_class().alias("own"), _base_failed().alias("failed"), *MEASURED).distinct()
    of = F.when(F.col("failed"), F.array(F.lit(WHOLE))).otherwise(F.array(F.lit(WHOLE), "own"))
    quartiles = _quartiles(values.select(F.col("band").alias("of_band"), F.explode(of).alias("at"), *MEASURED))
    language = Window.partitionBy("of_band")
    enough = quartiles.filter((F.col("n") >= LEAST_IN_CLASS) | (F.col("at") == WHOLE)).withColumn("last", F.max("at").over(language))
    enough = enough.filter((F.col("at") != WHOLE) | (F.col("last") == WHOLE))
    order = language.orderBy("at")
    first = F.when(F.row_number().over(order) == 1, F.lit(0)).otherwise(F.col("at"))
    end = F.coalesce(F.lead("at").over(order), F.lit(CLASSES))
    ranges = enough.withColumns({"first": first, "end": end})
    return ranges.select("of_band", F.explode(F.sequence("first", F.col("end") - 1)).alias("of_class"), *[f"{m}_quartiles" for m in MEASURED])


def quality_rules(docs: DataFrame, path: str | None = None, least_tokens: int = LEAST_TOKENS, width: float = WIDTH) -> DataFrame:
    """Per row of (doc_id, lang, text): the measures, base_failed, the band that it fails (NULL if none), and kept."""
    measured = settle(docs.select("doc_id", "lang", "text").mapInArrow(measure(path or vocabulary_path()), MEASURES))
    limits = settle(bands(measured, least_tokens))  # a row for each language and class of length
    bits = measured.withColumn("entropy_bits", F.col("entropy_share") * _log_tokens())
    joined = bits.join(limits, (F.col("band") == F.col("of_band")) & (_length_class() == F.col("of_class")), "left")

    def margin(m: str, part: tuple[float, float]) -> Column:
        least = F.lit(part[0]) + F.lit(part[1]) / F.sqrt(F.greatest("n_tokens", F.lit(1)))
        return F.greatest((F.col(f"{m}_quartiles")[1] - F.col(f"{m}_quartiles")[0]) * width, least / _log_tokens() if m == "entropy_share" else least)

    def outside(m: str) -> Column:
        below, above = BANDS[m]
        low, high = F.lit(below is not None), F.lit(False)
        for x in (ENTROPY if m in ENTROPY else (m,)) if below else ():
            low &= F.col(x) < F.col(f"{x}_quartiles")[0] - margin(x, below)
        if above:
            high = F.col(m) > F.col(f"{m}_quartiles")[1] + margin(m, above)
        return F.coalesce(low | high, F.lit(False))

    fails = F.lit(None).cast("string")
    for m in BANDS:
        fails = F.when(outside(m) & (F.col("n_tokens") >= least_tokens), F.lit("entropy_share" if m in ENTROPY else m)).otherwise(fails)
    out = joined.withColumns({"base_failed": _base_failed(), "fails": fails})
    return out.select(*measured.columns, "base_failed", "fails", (~F.col("base_failed") & F.col("fails").isNull()).alias("kept"))
