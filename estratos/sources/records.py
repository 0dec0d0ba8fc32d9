"""CSV records of splittable files whose quoted cells may hold line breaks (IO3).

A file is read as lines, in blocks that tasks read on their own, so a block does not know whether it begins inside a
quoted cell. What a line does to that state is a function of two values: where it ends if it begins outside, and where
if it begins inside. Functions compose, so each block has one as well, and a running composition over the blocks of a
file tells how each begins.

The task that reads a block follows both cases at once, over Arrow batches. They meet at the first line that leads to
one state from either, mostly in the first records. From the next record on the task joins the lines of each record
itself, so records are neither sorted nor sent to other tasks. Only the lines before that, and those of a record that
is open where the block ends, are kept as lines and joined with those of the blocks beside it.

A quote opens a cell only where the cell begins, and two quotes inside one are a quote. A cell that is still open at the
end of its file was never meant as one: its first line is a broken record, and the lines after it are records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_REST = r'[^"]*+(?:""[^"]*+)*+'  # of a quoted cell, up to its closing quote
_CELL = rf'(?:"{_REST}"[^,]*+|[^",][^,]*+|)'
_LEFT_OPEN = rf'(?:{_CELL},)*+"{_REST}\z'
#: A line that begins outside a quoted cell and ends inside one; and one that begins inside and ends inside.
OPENS = rf"\A{_LEFT_OPEN}"
STAYS = rf'\A{_REST}(?:\z|"[^,]*+,{_LEFT_OPEN})'

#: Character sets in which a line feed is the byte 0A and nothing else is; files in others cannot be cut into lines.
_WIDE = ("UTF-16", "UTF-32", "UCS-2", "UCS-4")


def with_lines(text: DataFrame) -> DataFrame:
    """`path`, `block` (the offset where its task began to read), `pos` (ascending within a block), `value` and `raw` of
    each line of a text scan with the line separator `\n`.

    `value` is right in what a line's structure needs in every character set that has ASCII; `raw` has the bytes. `pos`
    holds for one scan only; write the lines where they are needed twice.
    """
    return text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.rtrim(F.make_valid_utf8("value"), F.lit("\r")).alias("value"), F.col("value").cast("binary").alias("raw"),
    ).withColumn("pos", F.monotonically_increasing_id())


def text_of(encoding: str) -> Column:
    """The text of a line of `with_lines`. Bytes that are no UTF-8 are replaced."""
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        return F.col("value")
    return F.rtrim(F.decode("raw", encoding), F.lit("\r"))


def has_lines(encoding: str) -> bool:
    """True if files in this character set can be cut at line feeds without being decoded."""
    return not encoding.upper().replace("_", "-").startswith(_WIDE)


def text_scan(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    if not has_lines(encoding):
        raise ValueError(f"{encoding} files cannot be cut into lines")
    return spark.read.option("lineSep", "\n").text(list(files))


def opens_cell(value: Column) -> Column:
    """True for a line that, read on its own, ends inside a quoted cell. Lines without quotes are not searched."""
    return F.when(F.contains(value, F.lit('"')), value.rlike(OPENS)).otherwise(F.lit(False))


def _stays_in_cell(value: Column) -> Column:
    return F.when(F.contains(value, F.lit('"')), value.rlike(STAYS)).otherwise(F.lit(True))


def _composed(df: DataFrame, keys: Sequence[str], order: str, outside: str, inside: str) -> DataFrame:
    """`df` with `from_outside` and `from_inside`: where all rows of the keys up to this one lead, from either state.

    A row that leads to one state from both forgets what was before; after the last such row, or from the beginning,
    the state changes with each row that swaps the two.
    """
    frame = Window.partitionBy(*keys).orderBy(order)
    swaps = F.sum((F.col(outside) & ~F.col(inside)).cast("long")).over(frame)
    settled = F.when(F.col(outside) == F.col(inside), F.struct(F.col(outside).alias("to"), F.col("_swaps").alias("at")))
    df = df.withColumn("_swaps", swaps).withColumn("_settled", F.last(settled, ignorenulls=True).over(frame))
    odd = (F.col("_swaps") - F.coalesce("_settled.at", F.lit(0))) % 2 == 1
    to = F.col("_settled.to")
    return df.withColumns(
        {"from_outside": F.coalesce(to, F.lit(False)) != odd, "from_inside": F.coalesce(to, F.lit(True)) != odd}
    ).drop("_swaps", "_settled")


#: `value` is a whole record where `record` is true; else a line, of which is told, for a block that begins outside a
#: cell and for one that begins inside: whether a record begins there, whether the line ends inside a cell, and the
#: `pos` of the last line of the block where a record has begun. A row without `value` tells how its block ends.
PIECES = """path string, block long, pos long, value string, record boolean,
    outside_begun boolean, outside_open boolean, outside_start long,
    inside_begun boolean, inside_open boolean, inside_start long"""


def _in_tasks():
    """What tasks run over the lines they read. All of it is defined in here, so that Spark ships it with the query and
    executors need not have this package."""
    names = ["path", "block", "pos", "value", "record", *[f"{case}_{what}" for case in ("outside", "inside") for what in ("begun", "open", "start")]]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), *[pa.bool_(), pa.bool_(), pa.int64()] * 2]

    def runs_of(path: pa.Array, block: np.ndarray) -> list[tuple[int, int]]:
        """First and next-to-last place of each stretch of lines of one block."""
        new = np.flatnonzero(block[1:] != block[:-1]) + 1
        if len(path) > 1:
            new = np.union1d(new, np.flatnonzero(pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)) + 1)
        edges = [0, *new.tolist(), len(path)]
        return list(zip(edges[:-1], edges[1:]))

    class Block:
        """The block a task reads: where its lines so far lead from either state, and the lines of the open record."""

        def __init__(self, path: str, block: int):
            self.path, self.block = path, block
            self.state = [False, block > 0]  # the first block of a file begins outside
            self.start: list[int | None] = [None, None]
            self.met = False
            self.open: list[tuple[np.ndarray, pa.Array]] = []

        def _rows(self, pos: object, value: pa.Array, record: bool, sides: Sequence[object] = (None,) * 6) -> pa.RecordBatch:
            own = [pa.repeat(pa.scalar(v, t), len(value)) for v, t in ((self.path, pa.string()), (self.block, pa.int64()), (record, pa.bool_()))]
            told = [pa.nulls(len(value), t) if side is None else pa.array(side, t) for side, t in zip(sides, types[5:])]
            return pa.RecordBatch.from_arrays([own[0], own[1], pa.array(pos, pa.int64()), value, own[2], *told], names)

        def add(self, pos: np.ndarray, value: pa.Array, outside: np.ndarray, inside: np.ndarray) -> Iterator[pa.RecordBatch]:
            """The next lines, and where each leads from outside a cell and from inside one; what is told of them so far."""
            settled = np.maximum.accumulate(np.where(outside == inside, np.arange(len(pos)), -1))
            known, swaps = settled >= 0, np.cumsum(outside & ~inside)
            odd = (swaps - np.where(known, swaps[settled], 0)) % 2 == 1
            after = [np.where(known, outside[settled], state) ^ odd for state in self.state]
            begun = [~np.concatenate([[state], a[:-1]]) for state, a in zip(self.state, after)]
            self.state = [bool(a[-1]) for a in after]
            if not self.met:
                both = np.flatnonzero(begun[0] & begun[1])  # from here on the two cases are one
                self.met, n = len(both) > 0, int(both[0]) if len(both) else len(pos)
                if n:
                    sides = [side for k in (0, 1) for side in (begun[k][:n], after[k][:n], self._starts(k, begun[k][:n], pos))]
                    yield self._rows(pos[:n], value[:n], False, sides)
                if n == len(pos):
                    return
                begun[0], pos, value = begun[0][n:], pos[n:], value[n:]
            yield from self._join(begun[0], pos, value)

        def _starts(self, case: int, begun: np.ndarray, pos: np.ndarray) -> pa.Array:
            place = np.maximum.accumulate(np.where(begun, np.arange(len(begun)), -1))
            before = self.start[case]
            start = pa.array(np.where(place >= 0, pos[place], before or 0), pa.int64(), mask=(place < 0) & (before is None))
            self.start[case] = start[-1].as_py()
            return start

        def _join(self, begun: np.ndarray, pos: np.ndarray, value: pa.Array) -> Iterator[pa.RecordBatch]:
            """The records that end in these lines, which go on with the open one."""
            if self.open and not begun.any() and self.state[0]:
                self.open.append((pos, value))
                return
            if self.open:
                before = sum(len(lines) for _, lines in self.open)
                begun = np.concatenate([np.arange(before) == 0, begun])
                pos, value = np.concatenate([p for p, _ in self.open] + [pos]), pa.concat_arrays([v for _, v in self.open] + [value])
                self.open = []
            begins = np.flatnonzero(begun)
            end = int(begins[-1]) if self.state[0] else len(value)
            begins = begins[begins < end]
            if len(begins) == end > 0:
                yield self._rows(pos[:end], value[:end], True)
            elif end:
                lines = pa.ListArray.from_arrays(pa.array([*begins, end], pa.int32()), value[:end])
                yield self._rows(pos[begins], pc.binary_join(lines, "\n"), True)
            if end < len(value):
                self.open = [(pos[end:], value[end:])]

        def end(self) -> Iterator[pa.RecordBatch]:
            if self.open:
                pos, value = np.concatenate([p for p, _ in self.open]), pa.concat_arrays([v for _, v in self.open])
                yield self._rows(pos, value, False, [np.arange(len(pos)) == 0, np.ones(len(pos), bool), np.full(len(pos), pos[0])] * 2)
            ends = [None, [self.state[0]], None, None, [self.state[1]], None]
            yield self._rows([None], pa.nulls(1, pa.string()), False, ends)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            path, block, raw, opens = (batch.column(name) for name in ("path", "block", "raw", "opens"))
            for start, end in runs_of(path, block.to_numpy()) if len(path) else ():
                head = found.setdefault((path[start].as_py(), block[start].as_py()), [None, False])
                if head[0] is None:
                    given = raw[start:end].drop_null()
                    head[0] = given[0].as_py() if len(given) else None
                head[1] = head[1] or bool(pc.any(opens[start:end]).as_py())
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0] for key in found], pa.string()), pa.array([key[1] for key in found], pa.int64()),
            pa.array([head[0] for head in found.values()], pa.binary()),
            pa.array([head[1] for head in found.values()], pa.bool_()),
        ], ["path", "block", "raw", "opens"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Block | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            path, block, pos, value, outside, inside = (batch.column(i) for i in range(6))
            block, pos = block.to_numpy(), pos.to_numpy()
            outside, inside = (c.to_numpy(zero_copy_only=False).astype(bool) for c in (outside, inside))
            for start, end in runs_of(path, block):
                if at is None or (at.path, at.block) != (path[start].as_py(), int(block[start])):
                    if at is not None:
                        yield from at.end()
                    at = Block(path[start].as_py(), int(block[start]))
                yield from at.add(pos[start:end], value[start:end], outside[start:end], inside[start:end])
        if at is not None:
            yield from at.end()

    return heads, read


def block_heads(lines: DataFrame) -> DataFrame:
    """`path`, `block`, `raw` (the first one that is not null, in the order of `lines`) and `opens` (one is true)."""
    given = lines.select("path", "block", "raw", "opens")
    return given.mapInArrow(_in_tasks()[0], "path string, block long, raw binary, opens boolean")


def pieces(lines: DataFrame) -> DataFrame:
    """The records and lines of blocks, as `PIECES` tells; `lines` has `path`, `block`, `pos` and `value`, the text, as
    they are read. A task holds a batch of lines and those of the record that is open. Blank records are left out."""
    told = lines.select(
        "path", "block", "pos", "value", opens_cell(F.col("value")).alias("outside"), _stays_in_cell(F.col("value")).alias("inside")
    )
    return told.mapInArrow(_in_tasks()[1], PIECES).where(~F.col("record") | (F.trim("value") != ""))


def blocks_of(found: DataFrame) -> DataFrame:
    """`path`, `block`, `begins` (it begins inside a cell) and `unclosed` (its file ends inside one) of `pieces`."""
    ends = found.where("value is null").select("path", "block", F.col("outside_open").alias("outside"), F.col("inside_open").alias("inside"))
    of_file = Window.partitionBy("path").orderBy("block")
    return _composed(ends, ["path"], "block", "outside", "inside").select(
        "path", "block", F.lag("from_outside", 1, False).over(of_file).alias("begins"),
        F.last("from_outside").over(of_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("unclosed"),
    )


def csv_records(found: DataFrame, scratch: str) -> DataFrame:
    """`path`, `record`, `header` (the first one of its file) and `broken` of each record; blank ones are left out.

    `found` is what `pieces` gives, written as a table. Lines of one record are joined with line feeds. What is found on
    the way is written under `scratch`: a row for each block and each file, and what lies across blocks.
    """
    spark = found.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    lines = _placed_lines(found, kept(blocks_of(found), "blocks"))
    alone = F.col("begun") & ~F.col("open")
    joined = kept(_joined_lines(kept(lines.where(~alone).drop("open"), "placed")), "records")
    whole = found.where("record").select("path", "block", "pos", F.col("value").alias("record"), F.lit(False).alias("broken"))
    single = lines.where(alone & (F.trim("value") != "")).select(
        "path", "block", "pos", F.col("value").alias("record"), F.lit(False).alias("broken")
    )
    every = whole.unionAll(single).unionAll(joined)
    # Numbers only, so that they are hashed and not sorted; `pos` ascends within a block, not over a file.
    first = every.groupBy("path", "block").agg(F.min("pos").alias("pos"))
    first = first.groupBy("path").agg(F.min(F.struct("block", "pos")).alias("first"))
    first = kept(first.select("path", "first.block", "first.pos", F.lit(True).alias("header")), "first")
    return every.join(first, ["path", "block", "pos"], "left").select(
        "path", "record", F.coalesce("header", F.lit(False)).alias("header"), "broken"
    )


def _placed_lines(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """The lines that `pieces` has not joined: `begun` (a record begins there), `open` (it ends inside a cell) and
    `start`, the `pos` of the last one that has begun in this block."""
    lines = found.where("not record and value is not null").join(blocks, ["path", "block"])

    def told(name: str) -> Column:
        return F.when(F.col("begins"), F.col(f"inside_{name}")).otherwise(F.col(f"outside_{name}")).alias(name)

    return lines.select("path", "block", "pos", "value", "unclosed", told("begun"), told("open"), told("start"))


def _joined_lines(placed: DataFrame) -> DataFrame:
    """`path`, `block`, `pos`, `record` and `broken` of the records of `_placed_lines`."""
    # A block that begins inside a cell goes on with the last record that began before it.
    last = placed.groupBy("path", "block").agg(F.max("start").alias("start"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.when(F.col("start").isNotNull(), F.struct("block", "start"))
    carried = last.select("path", "block", F.last(begins, ignorenulls=True).over(before).alias("carried"))
    ends = last.select("path", begins.alias("at")).groupBy("path").agg(F.max("at").alias("last"))
    home = F.when(F.col("start").isNotNull(), F.struct("block", "start")).otherwise(F.col("carried"))
    placed = placed.join(carried, ["path", "block"]).join(ends, "path").withColumn("home", home)
    # The record that is never closed falls apart into its lines.
    loose = F.col("unclosed") & (F.col("home") == F.col("last"))
    placed = placed.select(
        "path", "block", "pos", "value", (loose & F.col("begun")).alias("broken"),
        F.when(loose, F.struct("block", F.col("pos").alias("start"))).otherwise(F.col("home")).alias("home"),
    )
    grouped = placed.groupBy("path", "home").agg(
        F.sort_array(F.collect_list(F.struct("block", "pos", "value"))).alias("own"), F.bool_or("broken").alias("broken")
    )
    record = F.array_join("own.value", "\n")
    return grouped.select("path", F.col("home.block").alias("block"), F.col("home.start").alias("pos"), record.alias("record"), "broken").where(
        F.trim("record") != ""
    )
