"""One ordered file from many tasks, and one large JSON array read by many tasks.

An ordered file is written in two steps: tasks sort and write parts of their own, and when the sizes of all parts are known,
tasks copy each to its place in a file beside the target. Only the finished file gets the target's name, by a
rename. A task that is lost or runs twice writes bytes that no other task writes, or the same ones again. Ranged
writes need a mounted file system; stores without them take the folders of parts that Spark writes.

A JSON array is cut into ranges of bytes. Whether a range begins inside a string and how deep follows from the ranges before it,
each of which is scanned once on its own: a quote that no backslash escapes changes sides, whatever came before."""

from __future__ import annotations

import os
import uuid
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipquarry.session import freeze, require_batch, scratch_path
from clipquarry.sources.files import MANIFEST, TSV, store_of

COPIED = 8 << 20  # bytes that a task copies at once
RANGE = 64 << 20  # bytes of a range of a JSON array
BEYOND = 1 << 20  # bytes read at once behind a range, to the end of its last record; the first time LEAST_BEYOND, then twice as many
LEAST_BEYOND = 16 << 10
TASKS = 16  # tasks a core that ranges are dealt out to, if that leaves a task no more bytes than a range of RANGE
LOOK_BACK = 256


def write_ordered(
    df: DataFrame, line: Column, path: str, order_by: Sequence[str], *, head: str = "", between: str = "\n", last: str = "\n", tail: str = ""
) -> None:
    """Writes ``line`` of every row to one file in the order of ``order_by``, which should decide it: ``head``, the lines with
    ``between`` between them, ``last`` behind the last of any, ``tail``. An existing file is replaced when all is written."""
    require_batch(df, "write_ordered")
    spark = df.sparkSession
    system, target, _ = store_of(path)
    if not isinstance(system, fs.LocalFileSystem):
        raise ValueError(f"{path} is in a store without ranged writes; write a folder of parts there")
    folder, gap = scratch_path(spark, "ordered"), between.encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place, _ = store_of(folder)
        store.create_dir(place, recursive=True)
        name, out, size, part = f"{place}/{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            data = gap.join((x or "").encode() for x in batch.column(1).to_pylist())
            data = data if out is None else gap + data
            out = store.open_output_stream(name) if out is None else out
            part, size = batch.column(0)[0].as_py(), size + len(data)
            out.write(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([size]), pa.array([name])], ["part", "size", "name"])

    rows = df.select(*order_by, line.alias("_line")).repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    rows = rows.select(F.spark_partition_id().cast("long").alias("part"), "_line")
    parts = freeze(rows.mapInArrow(write, "part long, size long, name string"))
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("size") + len(gap)).over(before), F.lit(0)) + len(head.encode())
    placed = freeze(parts.withColumn("start", start))
    end = placed.agg(F.max(F.col("start") + F.col("size"))).first()[0]
    work = os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.{uuid.uuid4().hex}")
    system.create_dir(os.path.dirname(target), recursive=True)
    with open(work, "wb") as file:
        file.write(head.encode())
        file.seek(len(head.encode()) if end is None else end)
        file.write(((last if end is not None else "") + tail).encode())

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, name, at in zip(*(c.to_pylist() for c in batch.columns)):
                with open(work, "r+b") as file, fs.LocalFileSystem().open_input_stream(name) as part:
                    file.seek(at - (0 if first else len(gap)))
                    file.write(b"" if first else gap)
                    while data := part.read(COPIED):
                        file.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    first = F.col("start") == len(head.encode())
    todo = placed.select(first.alias("first"), "name", "start")
    todo = todo.repartition(max(1, min(placed.count(), 4 * spark.sparkContext.defaultParallelism)), "name")
    todo.mapInArrow(copy, "n long").agg(F.sum("n")).collect()
    os.replace(work, target)


def write_manifest_file(df: DataFrame, path: str, order_by: Sequence[str] = ("Index",)) -> None:
    """A manifest as one tab-separated file in order, byte for byte what one task would write."""
    columns = ["Index", "Paths", "Labels", "Dataset"]
    options = {k: v for k, v in TSV.items() if k != "header"}
    line = F.to_csv(F.struct(*columns), options)
    write_ordered(df, line, path, order_by, head="\t".join(columns) + "\n")


def read_manifest_file(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """The same rows as ``read_manifest`` gives of one file, read in ranges of bytes by many tasks. A line end is the
    end of a row where an even number of quotes stands before it: fields with quotes or line ends are quoted, and quotes in
    them doubled. A range has the rows that begin behind a line end in it, which leaves out the head."""
    system, place, _ = store_of(path)
    ranges, tasks = _ranges(spark, system.get_file_info(place).size, range_bytes)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, own, _ = store_of(path)
        with store.open_input_file(own) as file:
            for batch in batches:
                quotes = [
                    sum(file.read_at(min(COPIED, stop - at), at).count(b'"') for at in range(start, stop, COPIED))
                    for start, stop in zip(*(c.to_pylist() for c in batch.columns[1:]))
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], ["id", "start", "stop", "quotes"])

    found = freeze(ranges.mapInArrow(counted, "id long, start long, stop long, quotes long"))
    # one row per range
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    known = freeze(found.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, own, _ = store_of(path)
        with store.open_input_file(own) as file:
            for batch in batches:
                todo = zip(*(c.to_pylist() for c in batch.columns))
                yield from _batches(r for start, stop, inside in todo for r in manifest_records(file, start, stop, inside))

    records = known.select("start", "stop", "inside").repartition(tasks, "start").mapInArrow(read, "record string")
    options = {k: v for k, v in TSV.items() if k != "header"} | {"multiLine": "true", "lineSep": "\n"}
    return records.select(F.from_csv("record", MANIFEST, options).alias("r")).select("r.*")


def _ranges(spark: SparkSession, size: int, range_bytes: int) -> tuple[DataFrame, int]:
    """``id``, ``start`` and ``stop`` of the ranges of a file, and the number of tasks they are dealt out to. A task has one
    range, or as many neighbours as keep it below ``TASKS`` tasks a core; so short ranges of large files do not make more tasks."""
    n = max(1, -(-size // range_bytes))
    tasks = min(n, max(TASKS * spark.sparkContext.defaultParallelism, -(-size // RANGE)))
    stop = F.least((F.col("id") + 1) * range_bytes, F.lit(size))
    return spark.range(0, n, 1, tasks).select("id", (F.col("id") * range_bytes).alias("start"), stop.alias("stop")), tasks


def _batches(records: Iterator[str]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if len(held) == 1_000 or size >= COPIED:
            yield pa.RecordBatch.from_arrays([pa.array(held)], ["record"])
            held, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["record"])


def manifest_records(file, start: int, stop: int, inside: bool) -> Iterator[str]:
    """The rows that begin behind a line end from ``start`` to ``stop``; the last one is read on to its end."""
    end, at, held, begun, beyond = file.size(), start, [], False, min(BEYOND, LEAST_BEYOND)
    while at < end and (at < stop or begun):
        raw = file.read_at(min(COPIED, stop - at) if at < stop else min(beyond, end - at), at)
        beyond = beyond if at < stop else min(BEYOND, 2 * beyond)
        data = np.frombuffer(raw, np.uint8)
        quoted = (np.cumsum(data == _QUOTE) + inside) % 2 == 1
        first = 0
        for place in np.flatnonzero((data == _LINE_END) & ~quoted).tolist():
            if begun:
                yield b"".join([*held, raw[first:place]]).decode()
            held, first, begun = [], place + 1, at < stop and at + place + 1 < end
            if at >= stop:
                return
        if begun:
            held.append(raw[first:])
        inside, at = bool(quoted[-1]), at + len(raw)
    if begun:
        yield b"".join(held).decode()


# -- JSON arrays ------------------------------------------------------------------------------------------------------

_LINE_END = ord("\n")
_QUOTE, _BACK = ord('"'), ord("\\")
_CHANGE = np.zeros(256, np.int8)  # of the depth, by byte
_CHANGE[list(b"{[")], _CHANGE[list(b"}]")] = 1, -1
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n,[]\xef\xbb\xbf")] = True


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes; ``escaped``: the first byte is."""
    quote = data == _QUOTE
    back = np.flatnonzero(data == _BACK)
    if back.size:  # of a run of backslashes every second one is escaped itself
        first = np.flatnonzero(np.diff(back, prepend=-2) != 1)
        place = np.arange(len(back)) - np.repeat(first, np.diff(first, append=len(back)))
        if escaped and back[0] == 0:
            place[:np.append(first, len(back))[1]] += 1
        after = back[place % 2 == 0] + 1
        quote[after[after < len(data)]] = False
    if escaped and len(data):
        quote[0] = False
    return quote


def _escaped(file, at: int) -> bool:
    """Whether an odd number of backslashes stands before a byte."""
    n = 0
    while at > n:
        step = min(LOOK_BACK, at - n)
        data = file.read_at(step, at - n - step)
        run = len(data) - len(data.rstrip(b"\\"))
        n += run
        if run < step:
            break
    return n % 2 == 1


def _depths(data: np.ndarray, escaped: bool, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte: is it outside of strings, and by how much it changes the depth; and the quotes."""
    quote = _quotes(data, escaped)
    odd = np.cumsum(quote, dtype=np.uint8) & 1  # a sum that runs over is still odd or even
    outside = (odd == inside) & ~quote
    return outside, _CHANGE[data] * outside, quote


def json_records(file, start: int, stop: int, inside: bool, depth: int) -> Iterator[str]:
    """The objects of the array that begin from ``start`` to ``stop``; the last one is read on to its end."""
    end, at, held, beyond = file.size(), start, [], min(BEYOND, LEAST_BEYOND)
    while at < end and (at < stop or held):
        raw = file.read_at(min(RANGE, stop - at) if at < stop else min(beyond, end - at), at)
        beyond = beyond if at < stop else min(BEYOND, 2 * beyond)
        data = np.frombuffer(raw, np.uint8)
        outside, change, quote = _depths(data, _escaped(file, at), inside)
        level = depth + np.cumsum(change, dtype=np.int64)
        closing = deque(np.flatnonzero((change < 0) & (level == 1)).tolist())
        if held:
            held.append(raw[:closing[0] + 1] if closing else raw)
            if closing:
                closing.popleft()
                yield b"".join(held).decode()
                held = []
        if at < stop:
            opening = np.flatnonzero((change > 0) & (level == 2))
            stray = outside & (level == 1) & (change == 0) & ~_BLANK[data]
            if stray.any() or (quote & (level == 1)).any() or (level < 0).any() or (data[opening] != ord("{")).any():
                raise ValueError("an array of objects is expected")
            for first in opening.tolist():
                while closing and closing[0] < first:  # the end of a record that began before this range
                    closing.popleft()
                if closing:
                    yield raw[first:closing.popleft() + 1].decode()
                else:
                    held = [raw[first:]]
        inside, depth, at = bool((int(quote.sum()) + inside) % 2), int(level[-1]), at + len(raw)
    if held:
        raise ValueError("the array ends inside a record")


def read_json_array(spark: SparkSession, path: str, schema: str, range_bytes: int = RANGE) -> DataFrame:
    """The objects of one JSON array (in UTF-8, with or without a mark at its start) as rows of ``schema``, read in ranges
    of bytes by many tasks. Any cut gives the same rows; elements that are no objects are an error."""
    system, place, _ = store_of(path)
    ranges, tasks = _ranges(spark, system.get_file_info(place).size, range_bytes)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, own, _ = store_of(path)
        with store.open_input_file(own) as file:
            for batch in batches:
                rows = []
                for start, stop in zip(*(c.to_pylist() for c in batch.columns[1:])):
                    turns, out, both = 0, 0, 0
                    for at in range(start, stop, RANGE):
                        data = np.frombuffer(file.read_at(min(RANGE, stop - at), at), np.uint8)
                        _, step, quote = _depths(data, _escaped(file, at), bool(turns % 2))
                        out += int(step.sum(dtype=np.int64))
                        both += int(_CHANGE[data].sum(dtype=np.int64))  # what is outside of strings from here, or else inside
                        turns += int(quote.sum())
                    rows.append((turns % 2, out, both - out))
                found = np.array(rows, np.int64).reshape(-1, 3).T
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], ["id", "start", "stop", "turns", "out", "ins"])

    found = freeze(ranges.mapInArrow(scanned, "id long, start long, stop long, turns long, out long, ins long"))
    # one row per range
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2
    known = found.withColumn("inside", inside).withColumn("change", F.when(F.col("inside") == 1, F.col("ins")).otherwise(F.col("out")))
    known = freeze(known.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, own, _ = store_of(path)
        with store.open_input_file(own) as file:
            for batch in batches:
                todo = zip(*(c.to_pylist() for c in batch.columns))
                yield from _batches(r for start, stop, *state in todo for r in json_records(file, start, stop, bool(state[0]), state[1]))

    records = known.select("start", "stop", "inside", "depth").repartition(tasks, "start").mapInArrow(read, "record string")
    return records.select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
