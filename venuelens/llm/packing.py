"""Packing by concatenate and cut.

Pass one tokenizes every document once and writes its ids, numbered by a running sum within its
partition. The partition totals, one row a partition, are summed up in order to give every partition
its place in one long stream of tokens. Pass two cuts the stream into windows of fixed length: a
document that crosses window edges gives one record per window. Only the stream's last window is
ever short, so padding is below one window altogether. Nothing is shuffled.

Defined cases: a null or empty text is its end-of-text id alone; texts of any length are cut, never
shortened; repeated rows are packed each for itself; null ids are kept; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder
from .shared import cut

LENGTH = 2048
END = 1


def tokenized(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """(part, place, doc_id, n, ids) of each row of ``docs``: ids in the narrowest width, ``place``
    the number of ids before it in its partition ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, encoder = TaskContext.get().partitionId(), 0, Encoder(path)
        names = ["part", "place", "doc_id", "n", "ids"]
        width = encoder.kind.itemsize
        for batch in batches:
            ids_column = batch.column(0).cast(pa.int64())
            for a, ids, counts in encoder.column(batch.column(1)):
                stop = np.cumsum(counts)
                data = np.insert(ids, stop, end).astype(encoder.kind)  # the end id after each text
                n = counts + 1
                before = np.concatenate([[0], np.cumsum(n)])
                column = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(n), [None, pa.py_buffer((before * width).astype(np.int64)), pa.py_buffer(data)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(place + before[:-1]), ids_column.slice(a, len(n)), pa.array(n), column],
                    names=names,
                )
                place += int(before[-1])

    return docs.select("doc_id", "text").mapInArrow(run, "part int, place long, doc_id long, n long, ids binary")


PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length, ids (unsigned
    32-bit, little-endian), doc_tokens, sequence_id, offset (in the sequence, gapless from 0)."""
    table = cut(tokenized(docs, path, end))
    totals = table.groupBy("part").agg(F.max(F.col("place") + F.col("n")).alias("total")).orderBy("part").collect()
    base = dict(zip([r["part"] for r in totals], np.cumsum([0] + [r["total"] for r in totals]).tolist(), strict=False))
    shared = docs.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = shared.value
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                piece = batch.slice(a, 500)
                part, place, n = (piece.column(c).to_numpy() for c in ("part", "place", "n"))
                begin = place + np.array([bases[p] for p in part.tolist()], np.int64)
                first, last = begin // length, (begin + n - 1) // length
                count = last - first + 1
                row = np.repeat(np.arange(len(n)), count)
                window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
                low = np.maximum(window * length, begin[row])
                high = np.minimum((window + 1) * length, (begin + n)[row])
                data = [x.as_py() for x in piece.column("ids")]
                ids = [np.frombuffer(x, f"<u{len(x) // int(k)}").astype("<u4") for x, k in zip(data, n, strict=True)]
                start, size = low - begin[row], high - low
                cuts = [ids[r][s : s + m].tobytes() for r, s, m in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(cuts, pa.binary()),
                     pa.array(n[row]), pa.array(window), pa.array(low - window * length)],
                    names=names,
                )

    return table.mapInArrow(run, PIECE_SCHEMA)


def sequences(pieces: DataFrame, length: int = LENGTH, end: int = END) -> DataFrame:
    """(sequence_id, n_ids, ids) of the packed sequences: the pieces' ids in order, padded with
    ``end`` up to ``length`` unless their number is a power of two. At most ``length`` ids meet in
    one row."""
    joined = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"), F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("parts")
    )
    n = F.col("n_ids")
    fill = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(length - n).cast("int")
    pad = end.to_bytes(4, "little").hex()
    return joined.select(
        "sequence_id", "n_ids", F.unhex(F.concat(F.array_join("parts.ids", ""), F.repeat(F.lit(pad), fill))).alias("ids")
    )
