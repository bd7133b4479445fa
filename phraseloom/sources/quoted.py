"""CSV with line breaks inside quotes, read by as many tasks as the files have blocks.

Lines are dealt by Spark's text reader. Whether a line begins inside quotes depends on all lines before it, so each block is read under
both assumptions: a block is a function from "begins inside quotes" to "ends inside quotes". Composing these functions over the blocks
of a file (one row for each block) gives the truth, and a second pass puts lines together into records. Only records that cross
the end of a block are shuffled. A quote is one at the beginning of a field only, as in the common readers.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phraseloom.shipping import ship

#: Block states are broadcast up to so many counted rows (a block is a split of a file); beyond, lines are sorted into their blocks.
BROADCAST_ROWS = 500_000
OPTIONS = {"escape": '"', "nullValue": "", "multiLine": "true", "encoding": "UTF-8"}


def ends_inside(line: str, inside: bool, sep: str = ",", quote: str = '"') -> bool:
    """Whether a line that begins inside quotes, or outside of them, ends inside."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line.startswith(quote, at):
                inside, at = True, at + 1
            else:
                at = line.find(sep, at) + 1
                if not at:
                    return False
            continue
        at = line.find(quote, at)
        if at < 0:
            return True
        if line.startswith(quote, at + 1):
            at += 2
            continue
        inside, at = False, line.find(sep, at + 1) + 1  # what follows a closing quote is plain text up to the next separator
        if not at:
            return False


def _runs(batches, columns):
    """Rows of all batches with a mark where another block begins."""
    before = None
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            yield row[:2] != before, row
            before = row[:2]


def block_functions(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, value) -> for each block with quotes: does it end inside if it begins outside (out_in) or inside (in_in), and does the
    record then open begin in this block (out_opened, in_opened)."""

    def run(batches):
        held, rows = None, []
        for new, (file, block, value) in _runs(batches, ("file", "block", "value")):
            if new:
                held = [file, block, False, False, True, False]
                rows.append(held)
            for end, opened in ((2, 3), (4, 5)):
                after = ends_inside(value, held[end], sep)
                held[opened] = after and (held[opened] or not held[end])
                held[end] = after
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "out_in", "out_opened", "in_in", "in_opened"])

    return lines.where(F.contains("value", F.lit('"'))).select("file", "block", "value").mapInArrow(run, "file string, block long, out_in boolean, out_opened boolean, in_in boolean, in_opened boolean")


def block_states(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, inside, origin): whether a block begins inside quotes, and the block in which the record then open began.

    A block's function is the identity, or sends both states to one: the state at its end is what the last constant function before
    gave. A block with quotes whose function swaps the states is possible, too; swaps are counted since that block.
    """
    known = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).join(block_functions(lines, sep), ["file", "block"], "left")
    out_in, in_in = F.coalesce("out_in", F.lit(False)), F.coalesce("in_in", F.lit(True))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = known.withColumn("sets", out_in == in_in).withColumn("swaps", (out_in & ~in_in).cast("int"))
    # the number of swaps up to and with a block, and that number where the last constant was
    fixed = fixed.withColumn("upto", F.sum("swaps").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(F.col("sets"), F.struct(out_in.alias("state"), "upto")), True).over(before)
    flips = F.coalesce(F.lag("upto").over(order), F.lit(0)) - F.coalesce(last["upto"], F.lit(0))
    begun = fixed.withColumn("inside", F.coalesce(last["state"], F.lit(False)) != (flips % 2 == 1))
    opened = F.when(F.col("inside"), F.coalesce("in_opened", F.lit(False))).otherwise(F.coalesce("out_opened", F.lit(False)))
    return begun.withColumn("origin", F.last(F.when(opened, F.col("block")), True).over(before)).select("file", "block", "inside", "origin")


def records(spark: SparkSession, path: str, sep: str = ",", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(file, block, header, record): the records of CSV files, the first of each file as its header; empty lines outside of quotes are none."""
    ship(spark)
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    states = block_states(lines.drop("at"), sep)
    if states.limit(broadcast_rows + 1).count() <= broadcast_rows:
        known = lines.join(F.broadcast(states), ["file", "block"])
    else:
        known = lines.join(states.hint("merge"), ["file", "block"]).sortWithinPartitions("file", "block", "at")

    def run(batches):
        def table(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "origin", "header", "record"])

        place, inside, held, came, rows, size, header = None, False, [], None, [], 0, False

        def close(origin):
            nonlocal size, header
            rows.append((*place, origin, header, "\n".join(held)))
            size += len(rows[-1][4])
            header = False
            held.clear()

        for new, (file, block, value, begins, origin) in _runs(batches, ("file", "block", "value", "inside", "origin")):
            if new:
                if held:
                    close(came if came is not None else place[1])
                place, inside, came, header = (file, block), begins, origin if begins else None, block == 0
            inside = ends_inside(value, inside, sep)
            held.append(value)
            if not inside:
                if came is not None or held != [""] and held != ["\r"]:
                    close(came)
                held, came = [], None
            if size > 4 << 20:
                yield table(rows)
                rows, size = [], 0
        if held:
            close(came if came is not None else place[1])
        yield table(rows)

    # a record that crosses blocks has pieces, each with the block in which it began
    pieces = known.select("file", "block", "value", "inside", "origin").mapInArrow(run, "file string, block long, origin long, header boolean, record string")
    whole = pieces.where("origin IS NULL").select("file", "block", "header", "record")
    each = F.sort_array(F.collect_list(F.struct("block", "record")))
    crossing = pieces.where("origin IS NOT NULL").groupBy("file", "origin").agg(F.max("header").alias("header"), F.array_join(F.transform(each, lambda r: r["record"]), "\n").alias("record"))
    return whole.unionByName(crossing.select("file", F.col("origin").alias("block"), "header", "record"))


def read_quoted_csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """CSV with header, quoted line breaks, doubled quotes, CRLF and an optional byte-order mark; only '' is null.

    Columns are texts unless a schema says otherwise. Each file's first record is its header and is left out. Carriage returns alone
    do not end a line.
    """
    head = spark.read.options(**OPTIONS).option("header", True).option("sep", sep).csv(path)
    names = [c.lstrip("﻿") for c in head.columns]
    kinds = schema or ", ".join(f"`{c}` string" for c in names)
    found = records(spark, path, sep, broadcast_rows).where(~F.col("header"))
    # in a file of CRLF lines, those within quotes are line breaks like all others
    plain = F.when(F.endswith("record", F.lit("\r")), F.replace(F.substr("record", F.lit(1), F.length("record") - 1), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return found.select(F.from_csv(plain, kinds, {**OPTIONS, "sep": sep}).alias("r")).select("r.*")
