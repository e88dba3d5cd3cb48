"""CSV with line breaks inside quoted values, read by many tasks a file.

Files are read as physical lines, in splits as Spark cuts them. Quotes inside a value are doubled,
so a line leaves the state it came in if its number of quotes is even, and turns it if it is odd: the
parities of the splits before tell whether a split begins inside a value. A split's lines are then
put together to records in its own task; only pieces of records that go over the end of a split
are stitched afterwards, no more than two a split.

Quotes are expected as CSV writers write them: around whole values. A single quote inside an unquoted
value is data to Spark's own reader, but turns the state here.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.session import materialize

#: Splits (a row each) up to which their parities go by way of the driver to all tasks; beyond it, they
#: are stored and joined.
MOST_BROADCAST = 200_000
RECORD, TAIL, HEAD = range(3)
_PIECES = "file string, start long, kind int, header boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split), text of each physical line, in order within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("text")
    )


def _insides(lines: DataFrame) -> DataFrame:
    """file, start, inside and ends_inside: whether a split begins and ends inside a quoted value."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    sums = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quotes_before = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    return sums.select(
        "file",
        "start",
        (quotes_before % 2 == 1).alias("inside"),
        ((quotes_before + F.col("quotes")) % 2 == 1).alias("ends_inside"),
    )


def _cut(lines: DataFrame, fragments: bool) -> DataFrame:
    """The whole records of each split, or (``fragments``) the pieces that go over its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Imported here: tasks need not have this package.
        import numpy as np
        import pyarrow.compute as pc

        key: tuple | None = None
        inside = first = False
        pending: list[str] = []
        kind = RECORD
        made: list[tuple] = []

        def put(of_kind: int, text: str, header: bool) -> None:
            if fragments == (of_kind != RECORD):
                made.append((key[0], key[1], of_kind, header, text))

        def finish() -> None:
            nonlocal pending
            if pending:
                put(TAIL if kind == RECORD and inside else kind, "\n".join(pending), first)
            pending = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.record_batch(arrays, names=["file", "start", "kind", "header", "text"])

        for batch in batches:
            starts = batch["start"].to_numpy()
            files = batch["file"].dictionary_encode()
            codes = files.indices.to_numpy()
            changes = np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1
            bounds = [0, *changes.tolist(), len(starts)]
            for begin, end in zip(bounds, bounds[1:]):
                if begin == end:
                    continue
                now = (files.dictionary[int(codes[begin])].as_py(), int(starts[begin]))
                if now != key:
                    if key is not None:
                        finish()
                    key, inside = now, bool(batch["inside"][begin].as_py())
                    kind, first = (HEAD if inside else RECORD), now[1] == 0
                text = batch["text"].slice(begin, end - begin)
                quotes = pc.count_substring(text, '"').to_numpy()
                before = (int(inside) + np.cumsum(quotes) - quotes) % 2
                inside = bool((before[-1] + quotes[-1]) % 2)
                opens = np.flatnonzero(before == 0)
                pending += text.slice(0, int(opens[0]) if len(opens) else len(text)).to_pylist()
                if not len(opens):
                    continue
                if pending:
                    put(kind, "\n".join(pending), first)
                    first = first and kind == HEAD
                kind = RECORD
                whole = pa.ListArray.from_arrays(pa.array(opens, pa.int32()), text) if len(opens) > 1 else None
                if whole is not None:
                    records = pc.binary_join(whole, "\n")
                    if fragments:
                        first = False
                    else:
                        if made:
                            yield batch_of(made)
                            made = []
                        n = len(records)
                        header = np.zeros(n, bool)
                        header[0], first = first, False
                        yield pa.record_batch(
                            [pa.array([key[0]] * n), pa.array(np.full(n, key[1])), pa.array(np.full(n, RECORD, np.int32)), pa.array(header), records.cast(pa.string())],
                            names=["file", "start", "kind", "header", "text"],
                        )
                pending = text.slice(int(opens[-1])).to_pylist()
            if made:
                yield batch_of(made)
                made = []
        if key is not None:
            finish()
            if made:
                yield batch_of(made)

    return lines.mapInArrow(run, _PIECES)


def records(spark: SparkSession, path: str) -> DataFrame:
    """text and ``header`` (whether it is a file's first) of each record of the CSV files at ``path``.

    Records come in no order; empty ones are left out. A record that ends with CR and LF has LF for
    these inside its values. The files are scanned twice, and the splits whose ends cut a record once
    more; lines are not shuffled.
    """
    lines = _lines(spark, path)
    insides = _insides(lines)
    known = insides.limit(MOST_BROADCAST + 1).collect()
    few = len(known) <= MOST_BROADCAST
    if few:
        insides = F.broadcast(spark.createDataFrame(known, insides.schema))
    else:
        insides = materialize(insides, "csv-splits")
    marked = lines.join(insides, ["file", "start"])
    whole = _cut(marked.select("file", "start", "inside", "text"), fragments=False).select("header", "text")
    if few and not any(row["inside"] or row["ends_inside"] for row in known):
        return _plain(whole)
    open_ends = marked.where("inside OR ends_inside").select("file", "start", "inside", "text")
    pieces = _cut(open_ends, fragments=True)
    order = Window.partitionBy("file").orderBy("start", F.col("kind").desc())
    opened = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    stitched = pieces.withColumn("record", opened).groupBy("file", "record").agg(
        F.max("header").alias("header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", (-F.col("kind")).alias("kind"), "text"))), lambda p: p["text"]), "\n").alias("text"),
    )
    return _plain(whole.unionByName(stitched.select("header", "text")))


def _plain(both: DataFrame) -> DataFrame:
    # Where a record ends with CR and LF, these are the line ends inside its values as well.
    plain = F.replace(F.expr("substring(text, 1, length(text) - 1)"), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.endswith("text", F.lit("\r")), plain).otherwise(F.col("text"))
    return both.select("header", F.when(F.col("header"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text).alias("text")).where("text <> ''")


def read_split_csv(spark: SparkSession, path: str, columns: list[str], options: dict[str, str]) -> DataFrame:
    """The rows of CSV files with one header, all strings, as Spark's own multi-line reader gives them.

    ``columns`` are the header's names; a file whose header differs is an error.
    """
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    parsed = records(spark, path).select("header", F.from_csv("text", fields, options).alias("row"))
    same = F.lit(True)
    for name in columns:
        own = F.lower(F.coalesce(F.col("row").getField(name), F.lit("")))
        # Spark numbers names that occur twice, and names columns without one.
        plain = name.rstrip("0123456789").lower()
        same = same & own.isin(name.lower(), plain, "") if name.startswith("_c") else same & own.isin(name.lower(), plain)
    message = F.lit("a CSV file's header differs from the first one's")
    fine = F.when(F.col("header"), F.when(same, F.lit(False)).otherwise(F.raise_error(message).cast("boolean")))
    return parsed.where(fine.otherwise(F.lit(True))).select("row.*")
