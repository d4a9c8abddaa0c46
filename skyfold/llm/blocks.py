"""Documents in blocks, and requests that blocks send to key buckets.

Some operators have to look up every n-gram of every document in a table
that grows with the corpus. Doing that row by row would shuffle a row for
each n-gram. Instead

* the documents are packed in *blocks* (a few MB of text and the documents'
  other columns, compressed), written once as a table bucketed by block id,
  so that later passes read a block where its answers arrive: texts are not
  shuffled;
* a block sends each key bucket one packed array of its keys (``ask``),
* a bucket's task merges what all blocks have sent and answers each of them
  with one packed array in the order of its keys.

What is shuffled are the packed arrays, in proportion to the input. A block
is bounded by ``BLOCK_BYTES`` (or one longer document), a bucket by the
number of buckets, which is the session's ``spark.sql.shuffle.partitions``.
A hot key costs each block one entry, however often it occurs there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.text import column_buffers, pack, unpack
from skyfold.session import cut_lineage, scratch_path

BLOCK_BYTES = 8 << 20
BLOCK_SCHEMA = "block long, docs binary, texts binary"


def bucket_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def write_blocks(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents as a bucketed table of blocks in the shared checkpoint
    folder. ``docs`` holds all columns but the text, ``texts`` the texts'
    bytes and lengths. Null texts have length 0 and are marked."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            batch = table.to_batches()[0]
            raw, offs = column_buffers(batch.column(0))
            absent = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            rest = pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(absent)], [*(f"c{i}" for i in range(len(names))), "absent"])
            data = pack(raw, np.diff(offs).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([to_ipc(rest)], pa.binary()), pa.array([data], pa.binary())], ["block", "docs", "texts"]
            )

        for batch in batches:
            _, offs = column_buffers(batch.column(0))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + block_bytes - size, side="right")) - 1)
                held.append(batch.slice(i, j - i))
                size += int(offs[j] - offs[i])
                i = j
                if size >= block_bytes * 3 // 4:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()

    packed = docs.select(F.col(text_col), *(F.col(f"`{c}`") for c in names)).mapInArrow(run, BLOCK_SCHEMA)
    name = f"skyfold_blocks_{uuid.uuid4().hex[:12]}"
    writer = packed.write.bucketBy(bucket_count(spark), "block").option("path", scratch_path(spark, name))
    writer.option("compression", "none").saveAsTable(name)  # an external table; its name lives in this session's catalog
    return spark.table(name)


def block_texts(texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a block's texts."""
    raw, lens = unpack(texts)
    return raw, np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])


Asker = Callable[[np.ndarray, np.ndarray, pa.RecordBatch, dict], Iterator[tuple[int, bytes]]]
#: Answers in the order of the messages, and what the bucket has to report.
Answerer = Callable[[list[bytes]], tuple[list[bytes], bytes | None]]
REPORT = -1  # block number of the reports


def _message(rows: list[tuple], first: str) -> pa.RecordBatch:
    to, block, data = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], [first, "block", "data"])


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Blocks joined with the answers they got: a map column by bucket for
    each name. Only the answers are shuffled."""
    out = blocks
    for name, rows in answers.items():
        per_block = rows.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "data"))).alias(name))
        out = out.join(per_block.hint("merge"), "block", "left")
    return out


def reports(answers: DataFrame) -> list[bytes]:
    """What the buckets have reported: one row each."""
    return [bytes(r[0]) for r in answers.where(F.col("block") == REPORT).orderBy("bucket").select("data").collect()]


def over_blocks(frame: DataFrame, run: Callable, schema) -> DataFrame:
    """``run(block, raw, offsets, docs, answers)`` -> record batches, for
    every row of ``with_answers``."""
    answers = [c for c in frame.columns if c not in ("block", "docs", "texts")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw, offs = block_texts(batch.column("texts")[r].as_py())
                got = {a: dict(batch.column(a)[r].as_py() or []) for a in answers}
                yield from run(batch.column("block")[r].as_py(), raw, offs, from_ipc(batch.column("docs")[r].as_py()), got)

    return frame.mapInArrow(each, schema)


def ask(frame: DataFrame, asker: Asker, answerer: Answerer, buckets: int, label: str) -> DataFrame:
    """``asker(raw, offsets, docs, answers)`` yields (bucket, keys) for a
    block; ``answerer(all blocks' keys of a bucket)`` gives an answer for
    each (and perhaps a report). Returns ``block, bucket, data``, written to
    the shared folder."""
    sent = over_blocks(
        frame,
        lambda block, raw, offs, docs, got: iter([_message([(b, block, d) for b, d in asker(raw, offs, docs, got)], "bucket")]),
        "bucket int, block long, data binary",
    )

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for b, block, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "data")), strict=True):
                blocks_of, datas = by.setdefault(b, ([], []))
                blocks_of.append(block)
                datas.append(data)
        for b in sorted(by):
            blocks_of, datas = by.pop(b)
            order = sorted(range(len(blocks_of)), key=blocks_of.__getitem__)  # the same result in any order of arrival
            answers, report = answerer([datas[i] for i in order])
            rows = [(b, blocks_of[i], a) for i, a in zip(order, answers, strict=True)]
            yield _message(rows + [(b, REPORT, report)] * (report is not None), "bucket")

    dealt = sent.repartitionById(buckets, F.col("bucket"))
    return cut_lineage(dealt.mapInArrow(reply, "bucket int, block long, data binary"), label)
