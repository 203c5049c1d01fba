"""Quality rules: word and line counts, then zstandard compression bands.

A document is judged on its whole text. The base rules look at the number of words and at
repeated 3-word windows. The compression bands compare raw size with zstandard size, once for
the whole document and once for each fixed chunk: a high ratio means repetition, a low one
means text that does not compress (random bytes, base64, ascii85). Random hex and base32 compress
as well as prose (about 1.9 and 1.6), so no ratio tells them apart; they need a rule on letters. Limits depend on length, because
short texts of any kind compress less. Limits are parameters; the defaults are wide around the
ratios of ordinary prose (about 1.3 to 3.5 at level 3).

Defined cases: null text counts as empty; empty text has zero words and fails the base rules;
texts below the smallest band are not judged by compression; other columns pass through; a
column of the input that has the name of a result column is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1


@dataclass(frozen=True)
class Band:
    """Limits for texts of at least ``min_bytes``: accepted ratio is ``low`` to ``high``."""

    min_bytes: int
    low: float
    high: float


#: Whole documents, by length.
DOCUMENT_BANDS = (Band(256, 1.10, 4.0), Band(1024, 1.25, 4.5), Band(4096, 1.35, 6.0), Band(65536, 1.35, 8.0))
#: Fixed chunks, by length (the last chunk of a document may be shorter). Random base64 reaches 1.26 at 1,024 bytes
#: and 1.32 at 4,096; the lowest prose chunk measured is 1.51 and 1.72.
CHUNK_BANDS = (Band(1024, 1.35, 4.5), Band(4096, 1.35, 5.0))


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    chunk_bytes: int = 4096
    max_bad_chunks: float = 0.25
    level: int = 3
    document_bands: tuple[Band, ...] = DOCUMENT_BANDS
    chunk_bands: tuple[Band, ...] = CHUNK_BANDS


def outside(n_bytes: int, ratio: float, bands: tuple[Band, ...]) -> bool:
    band = next((b for b in reversed(bands) if n_bytes >= b.min_bytes), None)
    return band is not None and not band.low <= ratio <= band.high


def repeated(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each (document, key) occurs at least twice."""
    both = W.mix(key ^ W.mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both, kind="stable")
    s = both[order]
    twin = np.zeros(len(s), bool)
    if len(s) > 1:
        equal = s[1:] == s[:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
    out = np.empty(len(s), bool)
    out[order] = twin
    return out


def base_counts(x: W.Texts) -> dict[str, np.ndarray]:
    """Word, character, symbol, duplicate-line and repeated-word counts of each text."""
    n = len(x)
    inside = W.NOT_SPACE[x.data]
    starts, ends, doc = x.spans(inside)
    n_words = np.bincount(doc, minlength=n)
    h = x.hashes(starts, ends)
    gram, first = W.windows(h, doc, 3)
    again = first[repeated(gram, doc[first])]
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[again + k] = True

    ls, le, ld = x.spans(x.data != 10)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, ld = ls[has_word], le[has_word], ld[has_word]
    line = W.mix(x.hashes(ls, le) ^ W.mix(ld.astype(np.uint64) + np.uint64(1)))
    _, kept = np.unique(line, return_index=True)
    return {
        "n_words": n_words,
        "word_chars": x.sums(inside & ((x.data & 0xC0) != 0x80)),
        "n_symbols": x.sums(SYMBOLS[x.data]),
        "n_dup_lines": np.bincount(ld, minlength=n) - np.bincount(ld[kept], minlength=n),
        "n_repeat_words": np.bincount(doc[covered], minlength=n),
    }


def compression(x: W.Texts, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole-document ratio (0 for empty), share of chunks outside their band, verdict."""
    press = zstandard.ZstdCompressor(level=rules.level, write_content_size=False)
    ratio, bad, ok = np.zeros(len(x)), np.zeros(len(x)), np.ones(len(x), bool)
    view = memoryview(np.ascontiguousarray(x.data))
    for i in range(len(x)):
        a, b = int(x.offsets[i]), int(x.offsets[i + 1])
        if a == b:
            continue
        ratio[i] = (b - a) / len(press.compress(view[a:b]))
        ok[i] = not outside(b - a, ratio[i], rules.document_bands)
        if b - a > rules.chunk_bytes:
            cuts = range(a, b, rules.chunk_bytes)
            wrong = sum(
                outside(len(c), len(c) / len(press.compress(c)), rules.chunk_bands)
                for c in (view[at : min(at + rules.chunk_bytes, b)] for at in cuts)
            )
            bad[i] = wrong / len(cuts)
            ok[i] &= bad[i] <= rules.max_bad_chunks
    return ratio, bad, ok


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("zstd_ratio", T.DoubleType()), T.StructField("bad_chunk_share", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
])


def judge(texts: pa.Array, rules: Rules = Rules()) -> list[np.ndarray]:
    """The result columns for an Arrow column of texts."""
    parts: list[list[np.ndarray]] = []
    for x in W.slices(texts):
        c = base_counts(x)
        failed = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_percent * c["n_words"])
        ratio, bad, ok = compression(x, rules)
        parts.append([*c.values(), failed, ratio, bad, ok & ~failed])
    if not parts:
        kinds = {"bigint": np.int64, "boolean": bool, "double": np.float64}
        return [np.zeros(0, kinds[f.dataType.simpleString()]) for f in RESULT]
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def apply(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``df`` with the result columns; one narrow pass, no shuffle."""
    names = [f.name for f in RESULT]
    carried = [c for c in df.columns if c not in names and c != text]
    keep_text = text not in names
    schema = T.StructType([*(df.schema[c] for c in carried), *([df.schema[text]] if keep_text else []), *RESULT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            judged = [pa.array(v) for v in judge(b.column("__judged"), rules)]
            own = [b.column(c) for c in schema.names[: len(schema) - len(names)]]
            yield pa.RecordBatch.from_arrays([*own, *judged], names=schema.names)

    given = df.withColumn("__judged", F.col(text))
    if not keep_text:
        given = given.select(*carried, "__judged")
    return given.mapInArrow(run, schema)
