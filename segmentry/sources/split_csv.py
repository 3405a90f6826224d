"""CSV rows with quoted line breaks, read by many tasks per file.

A split of a file may begin inside a quoted cell. Whether it does depends on all text before it, but what a split does
to that state is a function of two values (begins outside, begins inside), and such functions compose. So one
pass finds the function of every split, and the functions of a file are composed in order. In most splits every line is
a row; they never leave the JVM. The others are cut into rows by a second pass that knows how each begins, and rows that cross
a split border are pieced together at the end, of at most two pieces a split.

A quote opens a cell only at its beginning, and a quoted cell ends at a quote that is not doubled; what follows up to the
delimiter belongs to the cell. A lone quote inside an unquoted cell is text. A cell that is never closed reaches to the
end of its file. Lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'


def after_cell(line: str, at: int) -> int:
    """Position after the quote that closes the cell whose text begins at `at`, or -1."""
    while True:
        at = line.find(QUOTE, at)
        if at < 0:
            return -1
        if line[at + 1 : at + 2] != QUOTE:
            return at + 1
        at += 2


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether the line feed after this line lies inside a quoted cell, if the line begins inside or outside one."""
    at = 0
    if not inside:
        at = 1 if line.startswith(QUOTE) else line.find(delimiter + QUOTE) + 2
        if at == 1 and not line.startswith(QUOTE):
            return False
    while True:
        at = after_cell(line, at)
        if at < 0:
            return True
        at = line.find(delimiter + QUOTE, at)
        if at < 0:
            return False
        at += 2


def text_lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Lines of all files in the order of their split, with file (as a number, and its name), start of the split and number."""
    reader = spark.read.option("lineSep", "\n")
    lines = (reader.option("pathGlobFilter", pattern) if pattern else reader).text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("file_name"), F.make_valid_utf8("value").alias("value"),
        F.monotonically_increasing_id().alias("line"),  # the same in every scan of these files by one query
    )


def _splits(batch: pa.RecordBatch):
    """The rows of a batch by split: file, start, rows."""
    if not batch.num_rows:
        return
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    cuts = [0, *(1 + ((file[1:] != file[:-1]) | (block[1:] != block[:-1])).nonzero()[0]).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield int(file[begin]), int(block[begin]), batch.slice(begin, end - begin)


_FUNCTIONS = "file long, block long, outside boolean, inside boolean, is_plain boolean, header long"


def split_functions(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Per split: whether it ends inside a quoted cell, if it begins outside (`outside`) or inside (`inside`) one;
    whether all its lines are rows if it begins outside; and the number of the header line, in the first split of a file."""
    names = [c.split()[0] for c in _FUNCTIONS.split(", ")]

    def run(batches):
        split, state = None, None

        def row():
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*split, *state], kinds)], names)

        for batch in batches:
            for file, block, rows in _splits(batch):
                if split != (file, block):
                    if split is not None:
                        yield row()
                    split, state = (file, block), [False, True, True, None]
                for line in rows.column("quoted").drop_null().to_pylist():
                    state[:2] = ends_inside(line, state[0], delimiter), ends_inside(line, state[1], delimiter)
                    state[2] = state[2] and not state[0]
                if block == 0 and state[3] is None:
                    state[3] = pc.min(rows.column("text_line")).as_py()
        if split is not None:
            yield row()

    value = F.col("value")
    quoted = F.when(value.contains(QUOTE), value)  # other lines change nothing
    text_line = F.when((F.col("block") == 0) & ~value.isin("", "\r"), F.col("line"))
    return lines.select("file", "block", quoted.alias("quoted"), text_line.alias("text_line")).mapInArrow(run, _FUNCTIONS)


def split_states(functions: DataFrame) -> DataFrame:
    """Per split: whether it `begins` inside a quoted cell, whether it is `broken` (not all its lines are rows), `header`.

    A file's splits are composed in order, in one row of 40 bytes a split.
    """
    start = "named_struct('now', false, 'found', array_repeat(named_struct('block', 0L, 'begins', false, 'broken', false, 'header', 0L), 0))"
    found = "named_struct('block', s.block, 'begins', x.now, 'broken', x.now or not s.is_plain, 'header', s.header)"
    step = f"(x, s) -> named_struct('now', if(x.now, s.inside, s.outside), 'found', concat(x.found, array({found})))"
    parts = F.struct("block", "outside", "inside", "is_plain", "header")
    per_file = functions.groupBy("file").agg(F.sort_array(F.collect_list(parts)).alias("splits"))
    return per_file.select("file", F.inline(F.expr(f"aggregate(splits, {start}, {step}, x -> x.found)")))


#: Whole rows of a split, the end of a row that began before it, the begin of a row that ends after it, a split inside one cell.
WHOLE, END, BEGIN, MIDDLE = 0, 1, 2, 3
_ROWS = "file long, block long, file_name string, kind int, is_first boolean, value string"


def _rows_of_splits(lines: DataFrame, want_whole: bool, delimiter: str) -> DataFrame:
    """Rows, or only the pieces of rows, of splits with their state in `begins`. Empty lines between rows are left out."""
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def run(batches):
        split, name, began_inside, inside, held, is_first = None, None, False, False, [], False

        def out(kind, values, first):
            n = len(values)
            columns = [[split[0]] * n, [split[1]] * n, [name] * n, [kind] * n, [first] + [False] * (n - 1)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.array(values, pa.string())], names)

        def last():
            if inside and not want_whole:
                yield out(MIDDLE if began_inside else BEGIN, ["\n".join(held)], is_first)

        for batch in batches:
            for file, block, rows in _splits(batch):
                if split != (file, block):
                    if split is not None:
                        yield from last()
                    began_inside = inside = rows.column("begins")[0].as_py()
                    split, name, held, is_first = (file, block), rows.column("file_name")[0].as_py(), [], block == 0
                values, whole = rows.column("value"), []
                if not inside and not pc.any(pc.match_substring(values, QUOTE)).as_py():
                    whole = [x for line in values.to_pylist() if (x := line.removesuffix("\r"))]
                else:
                    for line in values.to_pylist():
                        if QUOTE in line:
                            inside = ends_inside(line, inside, delimiter)
                        held.append(line)
                        if inside:
                            continue
                        value, held = "\n".join(held).removesuffix("\r"), []
                        if began_inside:
                            began_inside = False
                            if not want_whole:
                                yield out(END, [value], False)
                        elif value:
                            whole.append(value)
                if whole:
                    if want_whole:
                        yield out(WHOLE, whole, is_first)
                    is_first = False
        if split is not None:
            yield from last()

    return lines.select("file", "block", "file_name", "begins", "value").mapInArrow(run, _ROWS)


def csv_rows(spark: SparkSession, path: str | list[str], pattern: str | None = None, delimiter: str = ",") -> DataFrame:
    """The logical rows of CSV files: `file_name`, `is_first` (the header row of a file), `value`.

    The broadcast tables have a row of numbers for each broken split and one for each file, at most 24 bytes per
    `spark.sql.files.maxPartitionBytes` of input and file.
    """
    lines = text_lines(spark, path, pattern)
    states = split_states(split_functions(lines, delimiter))
    broken = F.broadcast(states.filter("broken").select("file", "block", "begins"))
    headers = F.broadcast(states.filter("block = 0").select("file", "header"))
    value = F.when(F.col("value").endswith("\r"), F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    plain = lines.join(broken, ["file", "block"], "left_anti").join(headers, "file", "left").select(
        "file_name", (F.col("line") == F.coalesce("header", F.lit(-1))).alias("is_first"), value.alias("value")
    ).filter("value <> ''")
    others = lines.join(broken, ["file", "block"])
    whole, pieces = (_rows_of_splits(others, want, delimiter) for want in (True, False))
    per_row = pieces.withColumn("row", F.expr(f"sum(if(kind = {BEGIN}, 1, 0)) over (partition by file order by block, kind)"))
    joined = per_row.groupBy("file", "row").agg(
        F.any_value("file_name").alias("file_name"), F.bool_or("is_first").alias("is_first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "value"))), lambda x: x["value"]), "\n").alias("value"),
    )
    columns = ["file_name", "is_first", "value"]
    return plain.unionByName(whole.select(columns)).unionByName(joined.select(columns))
