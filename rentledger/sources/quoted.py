"""Read quoted CSV with line breaks inside fields in parallel, also a single large file.

A file is read as physical lines in splits of a fixed size. Where quotes are balanced, a line break ends a record exactly if the number of quotes
before it is even. A first pass takes from every split its parity of quotes and whether it has a line end for either starting state. The running
parity over the splits of a file tells each split whether it starts inside a field, and in which split the record that runs into it began. The
second pass cuts records in every split on its own; only records that cross a border are put together from their parts.

Both passes must see the same splits, whatever executors there are. Spark cuts files by settings and by the number of cores; the
reader works in a session of its own, where only the file sizes and ``split_bytes`` decide.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT_BYTES = 128 << 20
_SPLIT = ["_file", "_start"]


def physical_lines(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``_file, _start, value``: the lines of each split in order, ended by a line feed, with the place where the split begins."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    lines = own.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), "value")


def _parities(lines):
    """Whether an odd number of quotes stands before the end of each line, counted from the first line given."""
    import numpy as np
    import pyarrow.compute as pc

    counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    return np.cumsum(counts) % 2 == 1


def _runs(batch) -> Iterator[tuple[str, int, object]]:
    """The parts of an Arrow batch that lie in one split: file, start, lines."""
    import numpy as np

    starts = batch.column(1).to_numpy()
    files = batch.column(0).dictionary_encode()
    codes = files.indices.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        if b > a:
            yield files.dictionary[int(codes[a])].as_py(), int(starts[a]), batch.column(2)[a:b]


def split_states(lines: DataFrame) -> DataFrame:
    """One row per split: whether it starts ``inside`` a field, and the ``owner``, the split in which the record open there began.

    Raises when a file ends inside a field.
    """

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = {"_file": pa.string(), "_start": pa.int64(), "odd": pa.bool_(), "ends_even": pa.bool_(), "ends_odd": pa.bool_()}
        found: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for file, start, part in _runs(batch):
                state = found.setdefault((file, start), [False, False, False])
                odd = _parities(part) ^ state[0]
                state[:] = bool(odd[-1]), state[1] or bool((~odd).any()), state[2] or bool(odd.any())
        yield pa.RecordBatch.from_pylist([dict(zip(kinds, (*k, *v))) for k, v in found.items()], pa.schema(kinds))

    states = lines.mapInArrow(run, "_file string, _start long, odd boolean, ends_even boolean, ends_odd boolean")
    line = Window.partitionBy("_file").orderBy("_start")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.sum(F.col("odd").cast("int"))
    states = states.withColumn("inside", F.coalesce(quotes.over(before), F.lit(0)) % 2 == 1)
    # From outside, a line ends a record where the parity within the split is even, from inside where it is odd.
    states = states.withColumn("ends", F.when(F.col("inside"), F.col("ends_odd")).otherwise(F.col("ends_even")))
    # A record open at the start began in the last split before that ends one or doesn't start inside one.
    owner = F.last(F.when(F.col("ends") | ~F.col("inside"), F.col("_start")), ignorenulls=True).over(before)
    last = F.row_number().over(Window.partitionBy("_file").orderBy(F.desc("_start"))) == 1
    open_end = last & (F.col("inside") != F.col("odd"))
    return states.select(*_SPLIT, "inside", owner.alias("owner"), open_end.alias("open_end"))


def records(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES, header: bool = True) -> DataFrame:
    """``record``: the text of every record, without the first one of each file if that is a ``header``, and without blank lines."""
    lines = physical_lines(spark, path, split_bytes)
    # One entry for each split, as in the list of splits that Spark's driver holds for any scan.
    states = {}
    for r in split_states(lines).collect():
        if r.open_end:
            raise ValueError(f"{r._file} ends inside a quoted field")
        states[r._file, r._start] = r.inside, r.owner
    shared = spark.sparkContext.broadcast(states)
    schema = "_file string, _owner long, _start long, _first boolean, record string"

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        names = ["_file", "_owner", "_start", "_first", "record"]

        def whole(texts):
            nulls = [pa.nulls(len(texts), k) for k in kinds[:4]]
            return pa.RecordBatch.from_arrays([*nulls, pa.array(texts, kinds[4]) if isinstance(texts, list) else texts.cast(kinds[4])], names=names)

        def part_of(at, owner, texts, first):
            row = (at[0], owner, at[1], first, "\n".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        # Of the split at hand: parity so far, lines since the last record end, the split in which they began, whether no record ended yet.
        at, odd, held, owner, fresh = None, False, [], None, True
        for batch in batches:
            for file, start, lines in _runs(batch):
                if (file, start) != at:
                    if held:
                        yield part_of(at, owner, held, fresh and at[1] == 0)
                    at, held, fresh = (file, start), [], True
                    odd, owner = shared.value[at]  # a split that two passes saw differently has no entry and stops the run
                    owner = owner if odd else start  # of the record that the first line belongs to
                parity = _parities(lines) ^ odd
                odd = bool(parity[-1])
                ends = np.flatnonzero(~parity)
                begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
                texts = lines[: int(ends[0]) + 1].to_pylist() if len(ends) else []
                if len(ends) and (fresh or held):  # the first record that ends here may have begun before
                    if owner != start:
                        yield part_of(at, owner, [*held, *texts], False)
                    elif not (fresh and header and start == 0):
                        yield whole(["\n".join([*held, *texts])])
                    begins, ends_, held, fresh, owner = begins[1:], ends[1:], [], False, start
                else:
                    ends_ = ends
                plain = begins == ends_
                if plain.any():
                    yield whole(lines.take(pa.array(ends_[plain])))
                if not plain.all():
                    yield whole(["\n".join(lines[int(a) : int(b) + 1].to_pylist()) for a, b in zip(begins[~plain], ends_[~plain])])
                held += lines[int(ends[-1]) + 1 if len(ends) else 0 :].to_pylist()
        if held:
            yield part_of(at, owner, held, fresh and at[1] == 0)

    cut = lines.mapInArrow(run, schema)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_start", "record"))), lambda p: p["record"])
    crossing = cut.where(F.col("_file").isNotNull()).groupBy("_file", "_owner").agg(F.array_join(parts, "\n").alias("record"), F.max("_first").alias("_first"))
    crossing = crossing.where(~F.col("_first")) if header else crossing
    found = cut.where(F.col("_file").isNull()).select("record").unionAll(crossing.select("record"))
    return found.select(F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")


def read_quoted(spark: SparkSession, path: str | list[str], schema: T.StructType | str, options: dict[str, str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of quoted CSV files: quotes stand around whole fields only, and are doubled inside; a line end is a line feed, with or without a carriage return.

    Records are parsed by Spark's own CSV functions with ``options``. The pass over the quotes runs at once, the rest is lazy. A file that ends
    inside a field is an error.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    found = records(spark, path, split_bytes, options.get("header") == "true")
    parsed = found.select(F.from_csv("record", ddl, {**options, "multiLine": "true"}).alias("row"))
    return parsed.select("row.*")
