"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams by language in all labelled texts: each task adds up its own counts and
sends them to one grouping, whose result has at most languages times buckets rows. The matrix of
log probabilities is broadcast, and each batch of texts is scored through its n-grams alone.
Log probabilities are whole numbers of 2**-16, so that a sum does not depend on its order.
"""

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.llm.texthash import SPACE, mix, slices, text_bytes

#: Lengths of the n-grams; the character beside a word counts as a space.
ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
#: What every count starts from.
SMOOTHING = 0.5
#: Languages times buckets: 64 MB of probabilities. More labels than that are no languages.
MOST_CELLS = 1 << 24
UNDETERMINED = "und"
BLOCK = 1 << 20
_UNIT = 1 << 16
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@functools.cache
def _characters() -> np.ndarray:
    """For each code point its lower-case form, 0 where it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        character = chr(code)
        if character.isalpha():
            lower = character.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts behind each other, and where each text starts."""
    codes = _decoded(data)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if len(codes) != starts[-1]:  # not UTF-8 throughout: text by text
        texts = [_decoded(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        codes = np.concatenate(texts)
        starts = np.cumsum([0, *map(len, texts)])
    return codes, starts


def _decoded(data: np.ndarray) -> np.ndarray:
    text = data.tobytes().decode("utf-8", "replace")
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut a run of texts into blocks at ASCII white space, where no n-gram reaches across."""
    at = 0
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        while stop < len(data):
            spaces = np.flatnonzero(SPACE[data[stop : stop + BLOCK]])
            if len(spaces):
                stop += int(spaces[0])
                break
            stop = min(stop + BLOCK, len(data))
        yield data[at:stop], np.clip(offsets - at, 0, stop - at)
        at = stop


def ngrams(column: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram, block by block.

    Runs of characters that are no letters count as one space. An n-gram lies in one word, with
    the space before or behind it or without.
    """
    data, offsets = text_bytes(column)
    for part, borders in _pieces(data, offsets):
        codes, starts = _code_points(part, borders)
        # A space in front of every text keeps texts apart.
        letters = np.insert(_characters()[codes], starts[:-1], 0)
        of = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(starts) + 1)
        letters, of = np.append(letters, np.uint32(0)), np.append(of, np.int32(0))
        keep = letters > 0
        keep[1:] |= keep[:-1]
        keep[0] = True
        letters, of = letters[keep].astype(np.uint64), of[keep]
        inside = letters > 0
        for order in ORDERS:
            n = len(letters) - order + 1
            if n <= 0:
                continue
            whole = np.ones(n, dtype=bool)
            for j in range(1, order - 1):
                whole = whole & inside[j : j + n]
            value = np.full(n, order, dtype=np.uint64)
            for j in range(order):
                value = value * _PRIME + letters[j : j + n]
            first = np.where(inside[:n], of[:n], of[1 : n + 1])[whole]
            yield first, (mix(value[whole]) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages by code point and, for each, the log probability of every bucket."""

    languages: list[str]
    prior: np.ndarray  # languages; whole numbers of 2**-16, as the next
    table: np.ndarray  # languages x buckets

    @classmethod
    def of_counts(
        cls, languages: list[str], texts: np.ndarray, counts: np.ndarray, smoothing: float = SMOOTHING
    ) -> "Model":
        smooth = counts + smoothing
        table = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if len(languages) else smooth
        prior = np.log((texts + smoothing) / (texts + smoothing).sum())
        return cls(
            languages, np.rint(prior * _UNIT).astype(np.int64), np.rint(table * _UNIT).astype(np.int32)
        )

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its probability for each text; ties go to the first language."""
        n = len(column)
        sums = np.repeat(self.prior[:, None], n, axis=1)
        lettered = np.zeros(n, dtype=bool)
        for of, bucket in ngrams(column, self.table.shape[1]):
            lettered[of] = True
            for i, row in enumerate(self.table):
                # Exact: whole numbers far below 2**53.
                sums[i] += np.bincount(of, weights=row[bucket], minlength=n).astype(np.int64)
        if not self.languages:
            return [UNDETERMINED] * n, np.zeros(n)
        best = sums.argmax(axis=0)
        odds = np.exp((sums - sums.max(axis=0)) / _UNIT).sum(axis=0)
        score = np.where(lettered, 1 / odds, 0.0)
        return [
            self.languages[k] if known else UNDETERMINED for k, known in zip(best.tolist(), lettered)
        ], score


def fit(
    docs: DataFrame, usable: Column | None = None, buckets: int = BUCKETS,
    text_column: str = "text", lang_column: str = "lang",
) -> Model:
    """Learn from every row with a language and a letter in its text, and ``usable`` if given.

    Repeated rows count each time. Without such rows the model knows no language. More than
    ``MOST_CELLS / buckets`` different languages (512) fail, as the matrix would be too big to
    send to every executor.
    """
    known = docs if usable is None else docs.where(usable)
    known = known.select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")
    ).where("lang is not null and text is not null")
    most = MOST_CELLS // buckets
    languages = sorted(r.lang for r in known.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages")
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(number) * buckets, dtype=np.int64)
        texts = np.zeros(len(number), dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, 1):
                lang = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
                lettered = np.zeros(len(lang), dtype=bool)
                for of, bucket in ngrams(batch.column(1), buckets):
                    cells, times = np.unique(lang[of] * buckets + bucket, return_counts=True)
                    counts[cells] += times
                    lettered[of] = True
                texts += np.bincount(lang[lettered], minlength=len(texts))
        # Bucket -1 holds the number of texts.
        cells = np.flatnonzero(counts)
        rows = np.concatenate([np.arange(len(texts)), cells // buckets])
        buckets_of = np.concatenate([np.full(len(texts), -1), cells % buckets])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(buckets_of, pa.int32()),
             pa.array(np.concatenate([texts, counts[cells]]))],
            ["language", "bucket", "n"],
        )

    parts = known.mapInArrow(count, "language int, bucket int, n long")
    found = parts.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    language, bucket, n = (found[c].to_numpy() for c in ("language", "bucket", "n"))
    texts, counts = np.zeros(len(languages)), np.zeros((len(languages), buckets))
    texts[language[bucket < 0]] = n[bucket < 0]
    counts[language[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    seen = np.flatnonzero(texts)  # a language whose texts have no letter is not learned
    return Model.of_counts([languages[i] for i in seen], texts[seen], counts[seen])


def with_language(
    docs: DataFrame, model: Model, keep: list[str], text_column: str = "text"
) -> DataFrame:
    """The columns ``keep`` with lang_pred and score of each row's text.

    A text that is null or has no letter is ``und`` with score 0, as is every text for a model
    that knows no language. Equal texts get equal scores in any batch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text_column).cast("string").alias("lang_pred"))
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                found, score = shared.value.predict(batch.column(at))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:at], pa.array(found, pa.string()), pa.array(score)],
                    [*keep, "lang_pred", "score"],
                )

    out = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, out)
