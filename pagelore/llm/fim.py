"""Fill-in-middle examples: each text cut at two line borders and put into another order.

The borders of all lines in a run of texts are one ascending list of byte offsets. A learned
rank index stands in for that list: straight lines that miss no border by more than a fixed
error, and one small correction for each border. Where a cut falls is predicted from its rank
and corrected exactly.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelore.llm.texthash import slices, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
_NEWLINE = 10
#: Bytes that a line of the index may be off; corrections then fit in 16 bits.
ERROR = 32_000


@dataclass(frozen=True)
class RankIndex:
    """Ascending offsets by rank: segments (first rank, offset there, slope) and corrections."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> "RankIndex":
        """Greedy segments: each goes on while one slope from its first point passes within
        ``error`` of every offset."""
        if not 0 <= error <= ERROR:
            raise ValueError(f"the error must lie between 0 and {ERROR}")
        first, slope = [], []
        start = 0
        while start < len(offsets):
            stop, angle = _segment(offsets, start, error)
            first.append(start)
            slope.append(angle)
            start = stop
        at = np.array(first, dtype=np.int64)
        index = cls(at, offsets[at], np.array(slope), np.zeros(0, dtype=np.int16))
        missed = offsets - index._predicted(np.arange(len(offsets)))
        return cls(at, offsets[at], index.slope, missed.astype(np.int16))

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        of = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[of] + np.rint(self.slope[of] * (ranks - self.first[of])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of some ranks."""
        return self._predicted(ranks) + self.residuals[ranks]


def _segment(offsets: np.ndarray, start: int, error: int) -> tuple[int, float]:
    """Where a segment from ``start`` has to end, and its slope."""
    stop, low, high, width = start + 1, -np.inf, np.inf, 64
    while stop < len(offsets):
        rise = offsets[stop : stop + width] - offsets[start]
        run = np.arange(stop - start, stop - start + len(rise))
        lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
        fits = int(np.searchsorted(lows > highs, True))  # once false, a slope stays false
        if fits:
            low, high = lows[fits - 1], highs[fits - 1]
        stop += fits
        if fits < len(rise):
            break
        width *= 2
    return stop, (low + high) / 2 if stop > start + 1 else 0.0


def line_borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each text and end of each of its lines, ascending, and lines in each text.

    A line ends behind its line feed or with the text; an empty text has none.
    """
    ends = np.flatnonzero(data == _NEWLINE) + 1
    full = offsets[1:][offsets[1:] > offsets[:-1]]
    ends = np.sort(np.concatenate([ends, full[data[full - 1] != _NEWLINE]]))
    before = np.searchsorted(ends, offsets, side="right")
    return np.insert(ends, before[:-1], offsets[:-1]), np.diff(before)


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def fill_in_middle(
    docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """All rows and columns with n, form, prefix_chars, middle_chars and output added.

    The cuts, and whether and how a text is transformed, follow from the hash of seed and id,
    so reruns and repeated rows agree. ``form`` is psm (prefix, suffix, middle), spm, or plain:
    a text that is empty, holds one of the marks itself or is not among the ``percent`` chosen
    stays as it is, with null lengths. Null texts are empty, null ids hash as an empty one.
    Columns of the added names are replaced, whatever their case.
    """
    added = StructType().add("n", "long").add("form", "string").add("prefix_chars", "long")
    added = added.add("middle_chars", "long").add("output", "string")
    names = [c for c in docs.columns if c.lower() not in added.fieldNames()]
    digest = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256
    )
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    # Columns go by their number on the way, whatever their names are.
    numbered = [F.col(f"`{c.replace('`', '``')}`").alias(f"column{i}") for i, c in enumerate(names)]
    rows = docs.select(*numbered, F.array(*numbers).alias("hashes"))
    passed = rows.schema.fields[:-1]
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                hashes = batch.column(len(names)).flatten().to_numpy().reshape(-1, 4)
                made = _transformed(batch.column(at), hashes, percent, spm_percent)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(names)], *made],
                    [*(field.name for field in passed), *added.fieldNames()],
                )

    made = rows.mapInArrow(run, StructType([*passed, *added.fields]))
    return made.select(
        *(F.col(f.name).alias(c) for f, c in zip(passed, names)), *added.fieldNames()
    )


def _transformed(
    texts: pa.Array, hashes: np.ndarray, percent: int, spm_percent: int
) -> list[pa.Array]:
    data, offsets = text_bytes(texts)
    borders, n = line_borders(data, offsets)
    index = RankIndex.fit(borders)
    zero = np.cumsum(n + 1) - (n + 1)  # rank of each text's start
    cuts = np.sort(hashes[:, :2] % (n[:, None] + 1), axis=1)
    places = index.offsets((zero[:, None] + cuts).ravel()).reshape(-1, 2)
    wanted = (n > 0) & (hashes[:, 2] % 100 < percent)
    spm = hashes[:, 3] % 100 < spm_percent
    forms, prefix_chars, middle_chars, outputs = [], [], [], []
    for i in range(len(n)):
        start, end = offsets[i], offsets[i + 1]
        text = data[start:end].tobytes()
        if not wanted[i] or any(mark in text for mark in _MARKS):
            forms.append("plain")
            prefix_chars.append(None)
            middle_chars.append(None)
            outputs.append(text)
            continue
        a, b = places[i] - start
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        p, s, m = _MARKS
        forms.append("spm" if spm[i] else "psm")
        prefix_chars.append(_characters(data[start : start + a]))
        middle_chars.append(_characters(data[start + a : start + b]))
        parts = (s, suffix, p, prefix) if spm[i] else (p, prefix, s, suffix)
        outputs.append(b"".join((*parts, m, middle)))
    return [
        pa.array(n.astype(np.int64)), pa.array(forms, pa.string()),
        pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64()),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Each mark occurs once in a transformed output."""

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, end, 1), start, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    return (
        F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )


#: The query with seed 7, all texts and half of them in spm form.
SQL = r"""
WITH cut_up AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(cast(doc_id AS varchar), '')) AS h
  FROM documents
), numbered AS (
  SELECT *, len(units) AS n,
    cast('0x' || substr(h, 1, 8) AS bigint) % (len(units) + 1) AS a,
    cast('0x' || substr(h, 9, 8) AS bigint) % (len(units) + 1) AS b,
    cast('0x' || substr(h, 25, 8) AS bigint) % 100 < 50 AS spm
  FROM cut_up
), parted AS (
  SELECT *,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1 : least(a, b)], '') AS prefix,
    array_to_string(units[least(a, b) + 1 : greatest(a, b)], '') AS middle,
    array_to_string(units[greatest(a, b) + 1 :], '') AS suffix
  FROM numbered
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parted
"""
