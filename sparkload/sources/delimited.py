"""Reading delimited files, and guessing their format."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_if, trim_space
from ..operators.skew import stored
from ..session import session_conf
from .copytext import CORRUPT

# --- records -------------------------------------------------------------------------

# A record that grows beyond this many characters has a quote that nobody closed.
MAX_RECORD_CHARS = 64 * 1024 * 1024
PLACE = ("_file", "_start", "_at")  # file, its split, line within the split: the order of lines


@dataclass(frozen=True)
class _Format:
    delimiter: str
    quote: str
    escape: str
    comment: str | None
    lazy: bool

    @property
    def quoted(self) -> bool:
        return bool(self.quote) and not self.lazy

    def odd(self, line: Column) -> Column:
        """Whether a line has an odd number of quotes, so that a quote opens in it or closes."""
        if self.escape and self.escape != self.quote:
            line = F.regexp_replace(line, f"(?s){_literal(self.escape)}.", "")
        return (F.length(line) - F.length(F.replace(line, F.lit(self.quote), F.lit("")))) % 2 == 1

    def valid(self, record: Column) -> Column:
        """Whether quotes stand around whole fields only, each closed."""
        if not self.quoted:
            return F.lit(True)
        q, d = _literal(self.quote), _literal(self.delimiter)
        own = self.escape and self.escape != self.quote
        other = f"[^{_class(self.quote + self.escape if own else self.quote)}]*+"
        pair = f"{_literal(self.escape)}." if own else q + q
        plain = f"[^{_class(self.quote + self.delimiter)}]*+" if len(self.delimiter) == 1 else f"(?:(?!{d})[^{_class(self.quote)}])*+"
        field = f"(?:{q}{other}(?:{pair}{other})*+{q}|{plain})"
        return ~F.contains(record, F.lit(self.quote)) | record.rlike(f"(?s)\\A{field}(?:{d}{field})*+\\z")


def _literal(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in text)


def _class(chars: str) -> str:
    return "".join("\\" + c if c in "\\^-[]&" else c for c in chars)


def _lines(spark: SparkSession, path, encoding: str | None) -> DataFrame:
    """Lines between newlines, without the carriage return of a CRLF, and their place."""
    reader = spark.read.option("lineSep", "\n")
    if encoding:
        reader = reader.option("encoding", encoding)
    place = (
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # The reader hands over a line's bytes as they are; other encodings are decoded here.
    text = F.decode(F.col("value").cast("binary"), encoding) if encoding else F.col("value")
    with session_conf(spark, spark__sql__legacy__javaCharsets="true"):
        lines = reader.text(path).select(text.alias("value"), *place)
    bare = F.when(F.endswith("value", F.lit("\r")), F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    return lines.select(bare.alias("value"), *PLACE)


def _open_after(fmt: _Format):
    """A function that tells whether a quote is open after a line, from whether one was before it."""
    escaped = re.compile("(?s)" + re.escape(fmt.escape) + ".") if fmt.escape and fmt.escape != fmt.quote else None

    def after(line: str, opened: bool) -> bool:
        if fmt.quote not in line or (not opened and fmt.comment and line.startswith(fmt.comment)):
            return opened
        if escaped:
            line = escaped.sub("", line)
        return opened ^ bool(line.count(fmt.quote) % 2)

    return after


def _splits_that_begin_quoted(lines: DataFrame, fmt: _Format) -> DataFrame:
    """``_file, _start`` of the splits whose first line continues a quoted field.

    Every split tells how it would end if it began outside and inside quotes, two bits; going through the
    splits of a file in order gives how each begins.
    """

    def ends(batches):
        import pyarrow as pa

        after, key, out = _open_after(fmt), None, []
        for batch in batches:
            for line, file, start in zip(*(batch.column(c).to_pylist() for c in ("value", "_file", "_start"))):
                if (file, start) != key:
                    key = (file, start)
                    out.append([file, start, False, True])
                row = out[-1]
                row[2], row[3] = after(line, row[2]), after(line, row[3])
        if out:
            types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(columns, ["_file", "_start", "outside", "inside"])

    found = lines.select("value", "_file", "_start").mapInArrow(ends, "_file string, _start long, outside boolean, inside boolean")
    splits = found.groupBy("_file").agg(F.sort_array(F.collect_list(F.struct("_start", "outside", "inside"))).alias("splits"))
    begun = F.aggregate(
        "splits",
        F.struct(F.lit(False).alias("now"), F.array().cast("array<bigint>").alias("quoted")),
        lambda s, x: F.struct(
            F.when(s["now"], x["inside"]).otherwise(x["outside"]).alias("now"),
            F.when(s["now"], F.concat(s["quoted"], F.array(x["_start"]))).otherwise(s["quoted"]).alias("quoted"),
        ),
    )
    return splits.select("_file", F.explode(begun["quoted"]).alias("_start"))


def _joined(lines: DataFrame, fmt: _Format) -> DataFrame:
    """Records: lines joined where the newline is inside quotes. All splits of a file are read at once.

    A record that crosses splits comes in pieces, at most two of them a split, which are put together in
    order afterwards; all other records stay where they are.
    """
    quoted = stored(_splits_that_begin_quoted(lines, fmt), "quoted-splits").withColumn("_inside", F.lit(True))
    # at most a row for every split
    marked = lines.join(F.broadcast(quoted), ["_file", "_start"], "left").select("value", *PLACE, F.col("_inside").isNotNull().alias("_inside"))
    schema = "value string, _file string, _start long, _at long, _piece int"

    def records(batches):
        import pyarrow as pa

        after = _open_after(fmt)
        key, begun, size, place, opened, piece = None, [], 0, None, False, 0
        out = []

        def done(kind):
            nonlocal begun, size
            out.append(("\n".join(begun), *place, kind))
            begun, size = [], 0

        def batch_of(rows):
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, ["value", *PLACE, "_piece"])

        for batch in batches:
            for line, file, start, at, inside in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != key:
                    if begun:
                        done(_FIRST if piece == _WHOLE else _MIDDLE)
                    key, opened = (file, start), inside
                    piece = _LAST if inside else _WHOLE
                if not begun:
                    place = (file, start, at)
                begun.append(line)
                size += len(line)
                if size > MAX_RECORD_CHARS:
                    raise ValueError(f"{file}: a quote is not closed within {MAX_RECORD_CHARS} characters")
                opened = after(line, opened)
                if not opened:
                    done(piece)
                    piece = _WHOLE
            if out:
                yield batch_of(out)
                out.clear()
        if begun:
            done(_FIRST if piece == _WHOLE else _MIDDLE)
        if out:
            yield batch_of(out)

    found = stored(marked.mapInArrow(records, schema), "records")
    order = Window.partitionBy("_file").orderBy("_start", "_at")
    pieces = found.filter(F.col("_piece") != _WHOLE).withColumn("_n", F.sum((F.col("_piece") == _FIRST).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("_start", "_at", "value")))
    whole = pieces.groupBy("_file", "_n").agg(parts.alias("p")).select(
        F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"),
        "_file",
        F.get("p", F.lit(0))["_start"].alias("_start"),
        F.get("p", F.lit(0))["_at"].alias("_at"),
    )
    return found.filter(F.col("_piece") == _WHOLE).drop("_piece").unionByName(whole)


_WHOLE, _FIRST, _MIDDLE, _LAST = range(4)


def _heads(records: DataFrame, n: int) -> DataFrame:
    """``_file, _start, _at`` of record number ``n`` (from 1) of every file, or of its last if it has fewer.

    Records of the splits that files begin with are enough unless one of these has fewer than ``n``;
    their text is not read for it, and of each split only the first ``n`` places travel.
    """

    def first(batches):
        import pyarrow as pa

        key, seen, out = None, 0, []
        for batch in batches:
            files, starts = batch.column("_file").to_pylist(), batch.column("_start").to_pylist()
            if key == (files[0], starts[0]) == (files[-1], starts[-1]) and seen >= n:
                continue
            for file, start, at in zip(files, starts, batch.column("_at").to_pylist()):
                if (file, start) != key:
                    key, seen = (file, start), 0
                if seen < n:
                    seen += 1
                    out.append((file, start, at))
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, list(PLACE))

    def numbered(places: DataFrame) -> DataFrame:
        order = Window.partitionBy("_file").orderBy("_start", "_at")
        found = places.mapInArrow(first, "_file string, _start long, _at long")
        found = found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n)
        return found.groupBy("_file").agg(F.max(F.struct("_start", "_at")).alias("p"), F.count(F.lit(1)).alias("_n"))

    places = records.select(*PLACE)
    heads = stored(numbered(places.filter("_start = 0")), "heads")
    files = places.filter("_start > 0").select("_file").distinct()
    short = files.join(heads.filter(F.col("_n") == n), "_file", "left_anti")
    if short.head(1):
        heads = stored(numbered(places), "heads")
    return heads.select("_file", F.col("p._start").alias("_head_start"), F.col("p._at").alias("_head_at"), "_n")


def _after_head(records: DataFrame, heads: DataFrame) -> DataFrame:
    """The records after their file's head; ``heads`` has a row a file."""
    met = records.join(F.broadcast(heads), "_file")
    later = (F.col("_start") > F.col("_head_start")) | ((F.col("_start") == F.col("_head_start")) & (F.col("_at") > F.col("_head_at")))
    # Blanked before they are left out: no check of a record can be moved ahead of this and meet a head.
    return met.select(F.when(later, F.col("value")).alias("value"), *PLACE).filter("value IS NOT NULL")


def _fields(record: str, fmt: _Format) -> list[str]:
    """The fields of one record, read on the driver: names of a header."""
    options = {"delimiter": fmt.delimiter, "strict": fmt.quoted}
    if not fmt.quote:
        options["quoting"] = csv.QUOTE_NONE
    else:
        options.update(quotechar=fmt.quote, doublequote=fmt.escape == fmt.quote)
        if fmt.escape and fmt.escape != fmt.quote:
            options["escapechar"] = fmt.escape
    return next(csv.reader([record.replace("\r", " ")], **options))


# --- reading -------------------------------------------------------------------------

HEADERS_SHOWN = 1000


def read_delimited(
    spark: SparkSession,
    path,
    *,
    delimiter: str = ",",
    quote_char: str = '"',
    escape: str = '"',
    header: bool = False,
    skip_records: int = 0,
    columns=None,
    null_if_values=(),
    keep_empty: bool = False,
    trim: bool = True,
    comment: str | None = None,
    lazy_quotes: bool = False,
    encoding: str | None = None,
    multiline: bool | None = None,
    on_ragged: str = "fail",
) -> DataFrame:
    """Delimited files as one string column per field.

    Per file: skip ``skip_records`` records, then the header, then data. Names come from
    ``columns``, else from the header, which must be the same in all files, else ``col_1`` ... by the
    width of the first record. Empty lines and comment lines do not count. Records end at
    newlines outside quotes; a carriage return before a newline is dropped, any other is data.

    A record of another width, or with a quote that does not stand around a whole field or stays
    open, fails the job, or with on_ragged='reject' shows in ``_corrupt_record``. ``lazy_quotes``
    takes stray quotes as text. An empty ``quote_char`` turns quoting off.

    ``multiline`` says whether quoted fields may hold newlines: if so, lines are joined by the parity of quotes, carried
    over the splits of a file. None looks whether any line has an odd number of quotes; False spares that pass, and such a
    line is then a bad record.
    """
    if on_ragged not in ("fail", "reject"):
        raise ValueError(f"on_ragged must be fail or reject, not {on_ragged!r}")
    fmt = _Format(delimiter, quote_char, escape, comment, lazy_quotes)
    records = lines = _lines(spark, path, encoding)
    is_comment = F.startswith("value", F.lit(comment)) if comment else F.lit(False)
    if fmt.quoted and multiline is None:
        multiline = bool(lines.filter(~is_comment & fmt.odd(F.col("value"))).head(1))
    if fmt.quoted and multiline:
        records = _joined(lines, fmt)
    records = records.filter((F.col("value") != "") & ~is_comment)

    names = list(columns) if columns else None
    dropped = skip_records + int(header)
    if dropped:
        heads = _heads(records, dropped)
        if header and not names:
            names = _header_names(records, heads.filter(F.col("_n") == dropped), fmt)
        records = _after_head(records, heads)
    if not names and not header:
        first = records.head(1)
        names = [f"col_{i + 1}" for i in range(len(_fields(first[0].value, fmt)))] if first else None
    if not names:
        if lines.head(1):
            raise ValueError(f"no record to take the names of the fields from in {path}")
        return spark.createDataFrame([], T.StructType([]))

    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*[f"_f{i}" for i in range(len(names))], CORRUPT]])
    options = {
        "sep": delimiter,
        "quote": quote_char,
        "escape": escape if quote_char else "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "multiLine": "true",  # newlines within a record are its own
        "emptyValue": "",
        "unescapedQuoteHandling": "STOP_AT_DELIMITER",
    }
    valid = fmt.valid(F.col("value"))
    parsed = records.select("value", valid.alias("_valid"), F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options).alias("_p"))
    bad = F.when(~F.col("_valid") | F.col(f"_p.{CORRUPT}").isNotNull(), F.col("value"))
    if on_ragged == "fail":
        message = F.concat(F.when(F.col("_valid"), F.lit(f"expected {len(names)} fields: ")).otherwise("bad quotes: "), bad)
        # A filter is never pruned away, so the check runs whatever columns are used later.
        parsed = parsed.filter(F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    # The parser gives NULL for an empty field; with keep_empty that is the empty text.
    whole = parsed.select(
        *[F.when(bad.isNull(), F.coalesce(F.col(f"_p._f{i}"), F.lit(""))).alias(n) for i, n in enumerate(names)],
        bad.alias(CORRUPT),
    )
    cleaned = null_if(whole, names, null_if_values, keep_empty, trim)
    return cleaned.drop(CORRUPT) if on_ragged == "fail" else cleaned


def _header_names(records: DataFrame, heads: DataFrame, fmt: _Format) -> list[str] | None:
    """The names that the headers of all files agree on; None without any header."""
    place = (F.col("_start") == F.col("_head_start")) & (F.col("_at") == F.col("_head_at"))
    found = records.join(F.broadcast(heads), "_file").filter(place)
    found = found.groupBy("value").agg(F.min("_file").alias("file")).orderBy("file").limit(HEADERS_SHOWN).collect()
    headers = {tuple(h.strip() for h in _fields(r.value, fmt)): r.file for r in reversed(found)}
    if len(headers) > 1:
        (one, a), (two, b) = list(headers.items())[:2]
        raise ValueError(f"headers differ: {list(one)} in {a}, {list(two)} in {b}")
    return list(next(iter(headers))) if headers else None


# --- format guess --------------------------------------------------------------------

# Candidate delimiters, best-known first.
DELIMITERS = (",", ";", "|", "\t", "^")
PROFILE_LINES = 10
NUMERIC_CELL = r"^[0-9.+\-eE]+$"


def _file_heads(spark: SparkSession, path) -> DataFrame:
    """(file, first lines) of every file; opens each file once and reads only its head."""

    def heads(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            out = []
            for uri in batch.column("path").to_pylist():
                # Spark writes local files as file:/x, the filesystem layer wants file:///x.
                if uri.startswith("file:/") and not uri.startswith("file://"):
                    uri = "file://" + uri[len("file:"):]
                filesystem, name = fs.FileSystem.from_uri(uri)
                lines, rest = [], b""
                with filesystem.open_input_stream(name, compression="detect") as stream:
                    while len(lines) < PROFILE_LINES:
                        chunk = stream.read(64 * 1024)
                        *full, rest = (rest + chunk).split(b"\n")
                        lines += full
                        if not chunk:
                            lines += [rest] if rest else []
                            break
                out.append([line.rstrip(b"\r").decode("utf-8", "replace") for line in lines[:PROFILE_LINES]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(out, pa.list_(pa.string()))], names=["file", "lines"]
            )

    # Only the path is selected, so the listing never reads file contents.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.coalesce(spark.sparkContext.defaultParallelism * 4).mapInArrow(
        heads, "file string, lines array<string>"
    )


def _count_of(line, delimiter: str):
    return F.length(line) - F.length(F.replace(line, F.lit(delimiter), F.lit("")))


def _score(delimiter: str):
    """Occurrences over the lines that hold the delimiter more than once."""

    def add(total, line):
        n = _count_of(line, delimiter)
        return total + F.when(n > 1, n).otherwise(0)

    return F.aggregate("lines", F.lit(0), add)


def profile_delimited(spark: SparkSession, path) -> DataFrame:
    """Guess the format of every file below ``path``: file, delimiter, header, n_cols, score.

    Many files are profiled in one job; a file is one row, so nothing is shuffled. Files
    without any byte have no format and give no row.
    """
    df = _file_heads(spark, path)
    scores = [_score(d).alias(f"_s{i}") for i, d in enumerate(DELIMITERS)]
    scored = df.select("file", "lines", *scores)
    score = F.greatest(*[F.col(f"_s{i}") for i in range(len(DELIMITERS))])
    best = F.lit(DELIMITERS[0])
    for i, d in reversed(list(enumerate(DELIMITERS))):
        best = F.when((F.col(f"_s{i}") == F.col("score")) & (F.col("score") > 0), F.lit(d)).otherwise(best)
    guessed = scored.select("*", score.alias("score")).select("*", best.alias("delimiter"))
    first, second = F.get("lines", F.lit(0)), F.get("lines", F.lit(1))

    def cells(line):
        # The delimiter is literal text to a splitter that takes patterns.
        return F.split(line, F.concat(F.lit("\\Q"), F.col("delimiter"), F.lit("\\E")), F.lit(-1))

    def numeric(cell):
        return trim_space(cell).rlike(NUMERIC_CELL)

    header = (
        (F.size("lines") > 1)
        & (F.size(cells(first)) == F.size(cells(second)))
        & ~F.exists(cells(first), numeric)
    )
    return guessed.select(
        "file",
        "delimiter",
        F.coalesce(header, F.lit(False)).alias("header"),
        F.size(cells(first)).alias("n_cols"),
        "score",
    )
