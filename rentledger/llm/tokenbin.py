"""Token ids in binary files of patched frame-of-reference blocks.

File: magic, blocks, document table (doc_id, null flag, number of ids), block index (byte offset of each block), footer.
Block: number of ids, their minimum, bit width, number of exceptions, then the low ``width`` bits of
``id - minimum`` as bit planes, and the positions and whole values of the exceptions. The width is the one that
``percentile`` per cent of the block's differences need; only the rest are exceptions.

Files hold ranges of ascending doc_id. Each task writes its files under a name of its own and reports them in
the manifest, a table that Spark commits; a lost or repeated task leaves an unnamed file behind, never a wrong one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, open_folder
from .tokens import default_path, encoder, text_batches

MAGIC = b"PFORIDS1"
BLOCK = 16_384
PERCENTILE = 95
_HEAD = struct.Struct("<IIBI")
_FOOT = struct.Struct("<QQQQ8s")
MANIFEST = "part int, path string, n_docs long, n_ids long"


def encode_block(ids, percentile: int = PERCENTILE) -> bytes:
    """One block of at least one and at most 65,536 ids."""
    import numpy as np

    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    k = min(len(rest) - 1, len(rest) * percentile // 100)
    width = int(np.partition(rest, k)[k]).bit_length()
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    planes = np.empty((width, -(-len(rest) // 8)), np.uint8)
    for bit in range(width):
        planes[bit] = np.packbits(((rest >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8))
    parts = (planes.tobytes(), over.astype("<u2").tobytes(), rest[over].astype("<u4").tobytes())
    return _HEAD.pack(len(rest), low, width, len(over)) + b"".join(parts)


def decode_block(data: bytes):
    """The ids of a block."""
    import numpy as np

    n, low, width, over = _HEAD.unpack_from(data)
    at, row = _HEAD.size, -(-n // 8)
    planes = np.frombuffer(data, np.uint8, width * row, at).reshape(width, row)
    out = np.zeros(n, np.uint32)
    for bit in range(width):
        out |= np.unpackbits(planes[bit], count=n).astype(np.uint32) << np.uint32(bit)
    at += width * row
    where = np.frombuffer(data, "<u2", over, at)
    out[where] = np.frombuffer(data, "<u4", over, at + 2 * over)
    return out + np.uint32(low)


class Writer:
    """Appends documents to one file."""

    def __init__(self, sink, block: int = BLOCK, percentile: int = PERCENTILE):
        self.sink, self.block, self.percentile = sink, block, percentile
        self.docs: list[tuple[int | None, int]] = []
        self.offsets: list[int] = []
        self.pending = bytearray()
        self.n_ids = 0
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.docs.append((doc_id, len(packed) // 4))
        self.n_ids += len(packed) // 4
        self.pending += packed
        self._flush(4 * self.block)

    def _flush(self, size: int) -> None:
        import numpy as np

        at = 0
        while len(self.pending) - at >= size and len(self.pending) > at:
            part = bytes(self.pending[at : at + 4 * self.block])
            data = encode_block(np.frombuffer(part, "<u4"), self.percentile)
            self.offsets.append(self.at)
            self.sink.write(data)
            self.at += len(data)
            at += len(part)
        del self.pending[:at]

    def close(self) -> None:
        import numpy as np

        self._flush(1)
        table = self.at
        self.sink.write(np.array([d or 0 for d, _ in self.docs], "<i8").tobytes())
        self.sink.write(np.array([d is None for d, _ in self.docs], "u1").tobytes())
        self.sink.write(np.array([n for _, n in self.docs], "<u8").tobytes())
        self.sink.write(np.array([*self.offsets, table], "<u8").tobytes())
        self.sink.write(_FOOT.pack(table, len(self.docs), len(self.offsets), self.n_ids, MAGIC))


def read_documents(source, size: int) -> Iterator[tuple[int | None, int, bytes]]:
    """``(doc_id, start in the file, packed ids)`` of every document of a file, block by block."""
    import numpy as np

    source.seek(size - _FOOT.size)
    table, n_docs, n_blocks, _, magic = _FOOT.unpack(source.read(_FOOT.size))
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    source.seek(table)
    doc_ids = np.frombuffer(source.read(8 * n_docs), "<i8").tolist()
    nulls = np.frombuffer(source.read(n_docs), "u1").tolist()
    counts = np.frombuffer(source.read(8 * n_docs), "<u8").tolist()
    offsets = np.frombuffer(source.read(8 * n_blocks + 8), "<u8").tolist()
    have, at, block, start = bytearray(), 0, 0, 0
    for doc_id, null, n in zip(doc_ids, nulls, counts):
        while len(have) - at < 4 * n:
            source.seek(offsets[block])
            del have[:at]
            at = 0
            have += decode_block(source.read(offsets[block + 1] - offsets[block])).astype("<u4").tobytes()
            block += 1
        yield None if null else doc_id, start, bytes(have[at : at + 4 * n])
        at += 4 * n
        start += n


def write_ids(
    docs: DataFrame, scratch: Scratch, tokenizer: str | None = None, end_id: int = 2, block: int = BLOCK, percentile: int = PERCENTILE
) -> DataFrame:
    """Write the ids of every document, end id included, in ascending doc_id order; returns the manifest.

    Null text counts as empty and is the end id alone. Null doc_ids come first, repeated ones are separate documents
    in the order of their texts. An empty table gives an empty manifest. Other columns are ignored.
    """
    path, folder = tokenizer or default_path(), scratch.path("ids")

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, out, sink = TaskContext.get(), None, None
        encode, end = encoder(path).encode, end_id.to_bytes(4, "little")
        fs, top = open_folder(folder)
        name = f"{top}/ids-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        for whole in batches:
            for batch in text_batches(whole):
                if not batch.num_rows:
                    continue
                if out is None:
                    fs.create_dir(top, recursive=True)
                    sink = fs.open_output_stream(name)
                    out = Writer(sink, block, percentile)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                    out.add(doc_id, ids + end)
        if out is not None:
            out.close()
            sink.close()
            row = [[task.partitionId()], [name], [len(out.docs)], [out.n_ids]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["part", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.save(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_ids(manifest: DataFrame, scratch: Scratch) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``; starts count over all files in order."""
    folder = scratch.path("ids")
    # One row per file: few enough for one task to sum up.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))

    def run(batches) -> Iterator:
        import pyarrow as pa

        def batch(rows: list[tuple]):
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

        fs, _ = open_folder(folder)
        for file in (f for b in batches for f in b.to_pylist()):
            rows = []
            with fs.open_input_file(file["path"]) as source:
                for doc_id, start, ids in read_documents(source, source.size()):
                    rows.append((doc_id, file["base"] + start, len(ids) // 4, zlib.crc32(ids)))
                    if len(rows) == 50_000:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    n = max(1, manifest.count())
    return files.select("path", "base").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
