"""Substring dedup: hashing of units inside lines over the whole corpus.

A text falls into units: a unit ends with a line, or after a full stop,
exclamation or question mark and the space behind it, and takes along the
white space that follows, so the units tile the text. Normalised by
lower-casing A-Z and one space between words, the units' 128-bit digests are
grouped globally and the earliest occurrence (smallest doc_id, then row, then
place in the text) is kept. Later occurrences are removed where they stand in
a run of neighbours of ``min_run`` words or more in all: single short units
that prose happens to share stay. The original offsets of what was removed
stay with the result.

Rows are staged with a number of their own, so equal rows are documents of
their own, and no verdict is applied by a digest of a row.

Defined cases: null and empty texts have no units; a run ends at a unit that
is kept; repeated rows lose their runs, but for one of them; documents
without a doc_id come last; very long texts and units are whole; other
columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import fresh_path, shared_root

from . import text_batches as tb

_END = re.compile(r"(?:[.!?]+['\")\]]*[ \t]+|\n)[ \t-\r]*")


def unit_ends(text: str) -> list[int]:
    """Where the units of a text end, in code points."""
    ends = [m.end() for m in _END.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def units(text: str) -> tuple[list[int], list[list[bytes]]]:
    """Ends and normalised words of the units."""
    ends, at, words = unit_ends(text), 0, []
    for end in ends:
        words.append(text[at:end].encode().lower().split())  # ASCII letters and white space only
        at = end
    return ends, words


def removed_runs(later: list[int], words: list[int], min_run: int) -> list[int]:
    """The numbers of the units that go: later occurrences in runs of
    ``min_run`` words or more."""
    out, run, total = [], [], 0
    for n in [*sorted(later), None]:
        if run and n != run[-1] + 1:
            if total >= min_run:
                out += run
            run, total = [], 0
        if n is not None:
            run.append(n)
            total += words[n]
    return out


_STAGED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text", pa.large_string()), ("n_units", pa.int64()),
                     ("h", pa.list_(pa.binary()))])


def _stage(docs: DataFrame) -> DataFrame:
    """Every row with its number and the digests of its units (null for a unit
    without a word), in the shared folder."""
    def run(batches):
        row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                h = [[xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in units(text)[1]] for text in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(h)), pa.int64()), rows.column(0).cast(pa.int64()), texts,
                     pa.array([len(x) for x in h], pa.int64()), pa.array(h, _STAGED.field(4).type)], schema=_STAGED)
                row += len(h)

    path = fresh_path(docs.sparkSession, "units")
    docs.select("doc_id", "text").mapInArrow(run, "row bigint, doc_id bigint, text string, n_units bigint, h array<binary>") \
        .write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def later_units(staged: DataFrame) -> DataFrame:
    """of, later: the row and the numbers of its units that stood earlier."""
    shared_root(staged.sparkSession)
    found = staged.select("row", "doc_id", F.posexplode("h").alias("n", "h")).filter("h is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n")
    first = found.groupBy("h").agg(F.min(rank).alias("first"), F.count("*").alias("times")).filter("times > 1") \
        .select("h", F.col("first.row").alias("first_row"), F.col("first.n").alias("first_n")) \
        .checkpoint()  # so that the join may split a frequent unit
    return found.select("row", "n", "h").join(first, "h").filter("row <> first_row or n <> first_n") \
        .groupBy(F.col("row").alias("of")).agg(F.collect_list("n").alias("later"))


def remove_repeats(docs: DataFrame, min_run: int = 30) -> DataFrame:
    """doc_id, the remaining text, units, removed units and their spans
    (``start:end`` in code points of the original text)."""
    staged = _stage(docs)
    schema = "doc_id bigint, text string, n_units bigint, n_removed bigint, removed_spans string"

    def kept(text, later):
        """The text without its removed runs, how many units went, their spans."""
        if not later:
            return text, 0, ""
        ends, words = units(text)
        gone = removed_runs(later, [len(w) for w in words], min_run)
        starts, drop = [0, *ends], set(gone)
        return ("".join(text[starts[n]:ends[n]] for n in range(len(ends)) if n not in drop), len(gone),
                ",".join(f"{starts[n]}:{ends[n]}" for n in gone))

    def run(batches):
        for batch in batches:
            cols = list(zip(*map(kept, batch.column(1).to_pylist(), batch.column(3).to_pylist()))) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.string()), batch.column(2), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string())], names=[c.split()[0] for c in schema.split(", ")])

    return staged.join(later_units(staged), F.col("row") == F.col("of"), "left") \
        .select("doc_id", "text", "n_units", "later").mapInArrow(run, schema)
