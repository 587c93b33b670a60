"""Quality rules: repetition found with a suffix array of each text.

The words of a text are put into suffix order (only suffixes that share
their first ``min_words`` words with another one; the rest cannot start a
repeat). Neighbours' longest common prefixes give the maximal repeated
substrings; their spans are united, and the verdict limits the covered
fraction of the characters and the longest repeat.

Defined cases: a null or empty text has no words and fails the base rule;
rows are judged one by one, so repeated rows and doc_ids are independent;
a very long text is a chunk of its own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import suffixes
from . import text_batches as tb

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, covered_fraction double, "
          "longest_repeat bigint")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                    ("kept", pa.bool_()), ("covered_fraction", pa.float64()),
                    ("longest_repeat", pa.int64())])

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False


def _judge(ids: pa.Array, texts: pa.Array, min_words: int, max_covered: float,
           max_repeat: int) -> pa.RecordBatch:
    data, offs = tb.buffer_of(texts)
    n = len(texts)
    starts, ends, rows = tb.word_bounds(data, offs, tb.NOT_SPACE)
    words = tb.word_digests(data, starts, ends)
    n_words = tb.counts_by_row(rows, n)

    heads = (data & 0xC0) != 0x80  # one such byte for each code point
    points = np.concatenate(([0], np.cumsum(heads)))
    word_points = points[ends] - points[starts]
    word_chars = tb.counts_by_row(rows, n, word_points)
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    n_symbols = symbols[offs[1:]] - symbols[offs[:-1]]

    # lines with a word, equal to an earlier line of the same row
    l0, l1, lrow = tb.word_bounds(data, offs, NOT_NEWLINE)
    has_word = np.searchsorted(starts, l1) > np.searchsorted(starts, l0)
    l0, l1, lrow = l0[has_word], l1[has_word], lrow[has_word]
    line = tb.mix(tb.word_digests(data, l0, l1) ^ lrow.astype(np.uint64))
    _, first = np.unique(line, return_index=True)
    n_dup = tb.counts_by_row(lrow, n) - tb.counts_by_row(lrow[first], n)

    pos, length = suffixes.longest_repeats(words, rows, min_words)
    inside = tb.covered(pos, length, len(words))
    n_repeat = tb.counts_by_row(rows[inside], n)
    chars = np.maximum(word_chars, 1)
    fraction = tb.counts_by_row(rows[inside], n, word_points[inside]) / chars
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows[pos], length)

    failed = (n_words < 20) | (100 * n_repeat > 30 * n_words)
    kept = ~failed & (fraction <= max_covered) & (longest <= max_repeat)
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), pa.array(n_words), pa.array(word_chars), pa.array(n_symbols),
         pa.array(n_dup), pa.array(n_repeat), pa.array(failed), pa.array(kept),
         pa.array(fraction), pa.array(longest)], schema=_ARROW)


def repetition_rules(docs: DataFrame, min_words: int = 8, max_covered: float = 0.3,
                     max_repeat: int = 100) -> DataFrame:
    """One row per document: the base counts and the verdict.

    ``min_words`` is the shortest repeat that counts; a document is kept
    when the base rule holds, repeats cover at most ``max_covered`` of its
    word characters and none is longer than ``max_repeat`` words.
    """
    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                yield _judge(rows.column(0), texts, min_words, max_covered, max_repeat)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
