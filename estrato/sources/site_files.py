"""Site files: many small-schema delimited text files -> one table.

Each site delivers its own ``;`` file with its own header and encoding. The
work is two distributed scans:

1. *sniff*: one splittable text scan, aggregated per file, finds header,
   encoding, row widths and multi-line quoting, without opening a file whole;
2. *parse*: one splittable text scan of all files, whatever their headers. Each
   line meets the number of its file's layout in a small broadcast dictionary, is
   cut into fields, and every column of the result takes the field at the column's
   place in that layout.

Files with line breaks inside quotes are split like the others. Whether a split
begins inside quotes follows from the splits before it: each tells where it would
end if it began outside and if it began inside, and what is left of a record that
it begins inside of. These few bytes a split are chained per file; a task then
drops what the split before it finishes, and finishes its own last record.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato import config
from estrato.functions import columns as C
from estrato.session import materialise

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
#: Files whose layouts are broadcast, of about 64 bytes each; more are joined.
BROADCAST_FILES = 1 << 20
#: Characters of a record beyond the split it begins in, and bytes of all such ends sent at once.
RECORD_REST, REST_BYTES = 1 << 20, 64 << 20


class NoInputError(FileNotFoundError):
    """Nothing to read: no matching file, or every file was rejected."""


@dataclass
class SiteFiles:
    """An ingested directory."""

    table: DataFrame        # union of all accepted files, every column text
    files: DataFrame        # one row per file; ``reason`` is NULL if accepted
    names: dict[str, str]   # safe column name -> header text

    def quarantine(self) -> DataFrame:
        return self.files.filter("reason is not null").select("file_name", "reason")


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """The matching files with size and time. Content is not read.

    A scan leaves out files of zero bytes, so the names come from the file
    index, which Spark builds for any scan of the directory.
    """
    scan = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    found = scan.select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))
    listed = scan.inputFiles()
    if found.count() < len(listed):         # some are empty; else no name has to travel
        # The index writes ``file:///x`` where file metadata says ``file:/x``.
        names = [(re.sub(r"^(\w+):///", r"\1:/", p),) for p in listed]
        found = spark.createDataFrame(names, "file_path string").join(found, "file_path", "left")
    name = C.decode_file_name(F.substring_index("file_path", "/", -1))
    return found.select("file_path", name.alias("file_name"), F.coalesce("size", F.lit(0)).alias("size"), "modified")


def _outside_quotes(line: Column, sep: str) -> Column:
    """The line without its complete quoted fields."""
    at_start = f"(^|{re.escape(sep)})"
    quoted = at_start + '"[^"]*+(?:""[^"]*+)*+"'
    return F.when(F.instr(line, '"') > 0, F.regexp_replace(line, quoted, "$1")).otherwise(line)


def _ends_open(line: Column, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside of them."""
    return _outside_quotes(line, sep).rlike(f'(^|{re.escape(sep)})"')


def _field_count(bare: Column, sep: str) -> Column:
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _trailing(line: Column, sep: str) -> Column:
    """Separators at the end of a line, with nothing but white space among them."""
    end = F.regexp_extract(line, f"[{re.escape(sep)}\\s]*$", 0)
    return F.length(end) - F.length(F.replace(end, F.lit(sep), F.lit("")))


def sniff_files(spark: SparkSession, path: str, pattern: str = "*.csv",
                sep: str = ";") -> DataFrame:
    """One row per file: what is needed to parse it, or why it is rejected.

    A file is rejected for a row with values beyond its header; surplus fields
    that are empty are trailing separators and do no harm. Partial results merge
    map-side, so one huge file is no hot key.
    """
    lines = (spark.read.option("pathGlobFilter", pattern).text(path)
             .select("value", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_block_start").alias("block_start"))
             .filter(F.trim("value") != ""))
    bare = _outside_quotes(F.col("value"), sep)
    # Surplus fields that are empty are trailing separators: they say nothing.
    measured = lines.select(
        "file_path", "value", (_field_count(bare, sep) - _trailing(F.col("value"), sep)).alias("filled"),
        F.when(F.col("block_start") == 0, F.monotonically_increasing_id()).alias("line_no"),
        F.is_valid_utf8("value").alias("utf8"),
        _field_count(bare, sep).alias("width"),
        bare.rlike(f'(^|{re.escape(sep)})"').alias("open_quote"))
    seen = measured.groupBy("file_path").agg(
        F.bool_and("utf8").alias("utf8"),
        F.min_by("value", "line_no").alias("header"),
        F.min_by("width", "line_no").alias("header_fields"),
        F.min_by("open_quote", "line_no").alias("header_open"),
        F.max("filled").alias("filled"),
        (F.count("*") - 1).alias("data_rows"),
        F.bool_or("open_quote").alias("multi_line"))
    reason = (
        F.when(F.col("header").isNull(), "empty file")
        .when(F.col("header_fields") <= 1, "fewer than two columns")
        .when(F.col("header_open"), "header spans several lines")
        .when(~F.col("multi_line") & (F.col("filled") > F.col("header_fields")),
              "row longer than header"))
    latin = F.decode(F.col("header").cast("binary"), LATIN1)
    return (list_files(spark, path, pattern).join(seen, "file_path", "left")
            .select("file_path", "file_name", "size", "modified",
                    F.when(F.col("utf8"), UTF8).when(~F.col("utf8"), LATIN1).alias("encoding"),
                    F.when(F.col("utf8"), F.col("header")).otherwise(latin).alias("header"),
                    F.col("header_fields").cast("int").alias("header_fields"),
                    F.col("data_rows").cast("long").alias("data_rows"),
                    "multi_line", reason.alias("reason")))


def raw_inventory(spark: SparkSession, path: str, pattern: str = "*.csv",
                  width: int = 80, files: DataFrame | None = None) -> DataFrame:
    """File names with the first ``width`` characters of their header line.

    Pass the ``files`` of an ingest to reuse its scan.
    """
    files = sniff_files(spark, path, pattern) if files is None else files
    return files.select(
        "file_name", "size", "modified",
        F.substring(F.trim("header"), 1, width).alias("header"),
        F.when(F.col("header").isNull(), "empty file").alias("error"))


# --- header names -----------------------------------------------------------

def split_header(header: str, sep: str = ";") -> list[str]:
    """Header texts, made unique: ``a;a;;`` -> ``a, a.1, Unnamed: 2, Unnamed: 3``."""
    raw = next(csv.reader([header], delimiter=sep, quotechar='"', doublequote=True))
    labels = [text if text != "" else f"Unnamed: {i}" for i, text in enumerate(raw)]
    given, out = set(labels), []
    for label in labels:
        name, n = label, 0
        while name in out or (n and name in given):
            n += 1
            name = f"{label}.{n}"
        out.append(name)
    return out


def safe_names(labels, known: dict[str, str] | None = None) -> dict[str, str]:
    """Header text -> safe column name, over all headers of an ingest.

    Known texts keep their preset name. Others are reduced to letters, digits
    and ``_``; texts that differ only in case or punctuation stay apart.
    """
    known = config.SAFE_NAMES if known is None else known
    out = {label: known[label] for label in labels if label in known}
    taken = set(out.values()) | {"archivo"}
    for label in sorted(set(labels) - set(out)):
        base = re.sub(r"\W+", "_", label.lower()).strip("_") or "columna"
        name, n = base, 0
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out[label] = name
    return out


def _columns_of(labels: list[str], naming: dict[str, str]) -> list[str]:
    """Safe names of one header; two spellings of one name stay apart."""
    out: list[str] = []
    for label in labels:
        name, n = naming[label], 0
        while name in out:
            n += 1
            name = f"{naming[label]}_{n}"
        out.append(name)
    return out


# --- parse ------------------------------------------------------------------

def _text_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", pattern).text(path).select(
        "value", F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_name").alias(NAME),
        F.col("_metadata.file_block_start").alias("block"))


def _with_layout(lines: DataFrame, files: DataFrame, layouts: DataFrame) -> DataFrame:
    """The lines of accepted files with ``header``, ``places`` and ``multi_line`` of their
    layout, decoded. ``layouts``: (layout, header, places). Up to ``BROADCAST_FILES`` files
    the lines stay where they are read."""
    known = (files.filter("reason is null").join(F.broadcast(layouts.select("layout", "header")), "header")
             .select("file_path", "layout", "multi_line", (F.col("encoding") == UTF8).alias("utf8")))
    key = F.xxhash64("file_path")
    n, keys = files.agg(F.count("*"), F.count_distinct(key)).first()
    if n <= BROADCAST_FILES and n == keys:
        found = lines.join(F.broadcast(known.select(key.alias("key"), "layout", "multi_line", "utf8")),
                           F.xxhash64(PATH) == F.col("key")).drop("key")
    else:
        found = lines.withColumn("at", F.monotonically_increasing_id()).join(known.withColumnRenamed("file_path", PATH), PATH)
    text = F.when(F.col("utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), LATIN1))
    found = found.withColumn("value", text).drop("utf8").join(F.broadcast(layouts), "layout").drop("layout")
    if "at" in found.columns:      # the lines of a split come from one task: they only have to be in order again
        found = found.sortWithinPartitions(PATH, "block", "at").drop("at")
    return found


def _split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """(path, block, open0, open1, rest, closed) of each split of the files with line
    breaks in quotes: whether it ends inside quotes if it begins outside (inside) of
    them; the lines up to the end of a record that it begins inside of, and whether
    that is in it. ``rest`` of over ``RECORD_REST`` characters is NULL."""
    def run(batches):
        now, out = None, []

        def done():
            rest = "\n".join(now["rest"]) if now["size"] <= RECORD_REST else None
            return {"path": now["path"], "block": now["block"], "open0": now["s0"], "open1": now["s1"], "rest": rest, "closed": now["closed"]}

        for batch in batches:
            for value, path, block, open0, open1 in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or (path, block) != (now["path"], now["block"]):
                    if now is not None:
                        out.append(done())
                    now = {"path": path, "block": block, "s0": False, "s1": True, "rest": [], "size": 0, "closed": False}
                if not now["closed"]:
                    now["size"] += len(value) + 1
                    if now["size"] <= RECORD_REST:
                        now["rest"].append(value)
                now["s0"], now["s1"] = (open1 if now["s0"] else open0), (open1 if now["s1"] else open0)
                now["closed"] = now["closed"] or not now["s1"]
        if now is not None:
            out.append(done())
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("path", pa.string()), ("block", pa.int64()), ("open0", pa.bool_()), ("open1", pa.bool_()), ("rest", pa.string()), ("closed", pa.bool_())]))

    return (lines.filter("multi_line")
            .select("value", PATH, "block", _ends_open(F.col("value"), sep).alias("open0"),
                    _ends_open(F.concat(F.lit('"'), "value"), sep).alias("open1"))
            .mapInArrow(run, "path string, block long, open0 boolean, open1 boolean, rest string, closed boolean"))


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    """(path, block, inside, rest, too_long) of one file's splits: whether a split
    begins inside quotes, and what later ones hold of the record that it ends in."""
    frame = frame.sort_values("block")
    inside, state = [], False
    for open0, open1 in zip(frame["open0"], frame["open1"]):
        inside.append(state)
        state = bool(open1 if state else open0)
    ends, rests, closed = [*inside[1:], state], frame["rest"].tolist(), frame["closed"].tolist()
    out, after, too_long = [None] * len(frame), None, False
    for k in range(len(frame) - 1, -1, -1):      # ``after``: what follows split k of the record it ends in
        out[k] = after if ends[k] else None
        if inside[k]:
            own = rests[k]
            whole = None if own is None else own if closed[k] or after is None else f"{own}\n{after}"
            too_long |= whole is None or len(whole) > RECORD_REST
            after = whole if whole is not None and len(whole) <= RECORD_REST else ""
        else:
            after = None
    return pd.DataFrame({"path": frame["path"].to_numpy(), "block": frame["block"].to_numpy(), "inside": inside, "rest": out, "too_long": too_long})


def _glued(lines: DataFrame, sep: str, borders: dict[tuple[str, int], tuple[bool, str | None]]) -> DataFrame:
    """Whole records instead of lines, for the lines of files with line breaks in quotes.
    ``borders`` has the splits of files with several: those of other files begin outside
    quotes. Records leave a task batch by batch, as its lines come in."""
    kept = [c for c in lines.columns if c not in ("value", "block", "multi_line")]

    def run(batches):
        key, state, skip, parts, first = None, False, False, [], None

        def records(texts, rows, batch):
            own = batch.take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *(own.column(c) for c in kept)], names=["value", *kept])

        def left_open():
            """The record that its split leaves open, with what later splits hold of it."""
            rest = borders.get(key, (False, None))[1]
            return "\n".join([*parts, rest] if rest is not None else parts)

        for batch in batches:
            value, path, block, open0, open1 = (batch.column(c).to_pylist() for c in ("value", PATH, "block", "open0", "open1"))
            texts, rows, carried = [], [], None
            start = None        # where the open record begins; None: in an earlier batch, as ``first``
            for i, line in enumerate(value):
                if (path[i], block[i]) != key:
                    if parts and start is None:
                        carried = left_open()
                    elif parts:
                        texts.append(left_open())
                        rows.append(start)
                    key, parts = (path[i], block[i]), []
                    if block[i] > 0 and key not in borders:
                        raise RuntimeError(f"{path[i]} is split otherwise than when it was looked through: read it again")
                    state = skip = borders.get(key, (False, None))[0]
                begins, state = not state, open1[i] if state else open0[i]
                if skip:
                    skip = state
                    continue
                if begins:
                    parts, start = [line], i
                else:
                    parts.append(line)
                if not state:
                    text = line if len(parts) == 1 else "\n".join(parts)
                    if start is None:
                        carried = text
                    else:
                        texts.append(text)
                        rows.append(start)
                    parts = []
            if carried is not None:
                yield records([carried], [0], first)
            if texts:
                yield records(texts, rows, batch)
            if parts and start is not None:
                first = batch.take(pa.array([start], pa.int64()))
        if parts:
            yield records([left_open()], [0], first)

    marked = lines.withColumns({
        "open0": _ends_open(F.col("value"), sep),
        "open1": _ends_open(F.concat(F.lit('"'), "value"), sep)})
    schema = T.StructType([lines.schema["value"], *[lines.schema[c] for c in kept]])
    return marked.mapInArrow(run, schema)


def _whole(lines: DataFrame, sep: str, borders: DataFrame) -> DataFrame:
    """The records of the files with line breaks in quotes."""
    lines = lines.filter("multi_line")
    size = borders.agg(F.sum(F.coalesce(F.length("rest"), F.lit(0)) + 64)).first()[0] or 0
    scans = max(1, -(-size // REST_BYTES))      # ends of records that are too many for one go take several
    part = F.pmod(F.xxhash64(PATH), F.lit(scans))
    found = []
    for k in range(scans):
        own = borders.withColumnRenamed("path", PATH).filter(part == k).collect()
        known = {(r[PATH], r["block"]): (r["inside"], r["rest"]) for r in own}
        found.append(_glued(lines if scans == 1 else lines.filter(part == k), sep, known))
    return reduce(DataFrame.union, found)


def _records(lines: DataFrame, sep: str, borders: DataFrame | None) -> DataFrame:
    """Lines, or in files with line breaks in quotes, records. The lines of other files
    pass no worker."""
    if borders is None:
        return lines.drop("block", "multi_line")
    return lines.filter("not multi_line").drop("block", "multi_line").unionByName(_whole(lines, sep, borders))


def read_site_files(spark: SparkSession, path: str, pattern: str = "*.csv", sep: str = ";",
                    site_from: str | None = None, known: dict[str, str] | None = None,
                    with_file: bool = False) -> SiteFiles:
    """Ingest a directory: sniff, quarantine, parse, union by name.

    ``site_from`` is a pattern whose first group is the site's file name within
    the decoded path, for layouts that keep a site's parts in one folder; the
    default is the base name of the file. A line that repeats its file's header
    is no data.
    """
    files = materialise(sniff_files(spark, path, pattern, sep), "site-files")
    if not files.take(1):
        raise NoInputError(f"no {pattern} file in {path}")
    # Spellings of a header, not files: their number is that of the layouts in use.
    headers = [r["header"] for r in files.filter("reason is null").select("header").distinct()
               .orderBy("header").collect()]
    if not headers:
        raise NoInputError(f"no readable {pattern} file in {path}")

    labels = {h: split_header(h, sep) for h in headers}
    naming = safe_names({x for own in labels.values() for x in own}, known)
    columns = {h: _columns_of(own, naming) for h, own in labels.items()}
    shown: dict[str, str] = {}
    for h in headers:
        for name, label in zip(columns[h], labels[h]):
            shown.setdefault(name, label)
    lines = _text_lines(spark, path, pattern)
    layouts, names = _layouts(spark, columns)
    borders = None
    if files.filter("reason is null and multi_line").take(1):
        ends = _split_ends(_with_layout(lines, files, layouts), sep)
        chained = materialise(ends.groupBy("path").applyInPandas(
            _chained, "path string, block long, inside boolean, rest string, too_long boolean"), "split-borders")
        borders = chained.filter("not too_long").drop("too_long")
        files = _without_wide(lines, files, layouts, sep, chained)
    rows = _columns_at_places(_records(_with_layout(lines, files, layouts), sep, borders), names, sep, max(map(len, columns.values())))
    table = _tagged(rows, {c: c for c in shown}, site_from, with_file)
    return SiteFiles(table, files.withColumn("archivo", _shown_name(F.col("file_path"), F.col("file_name"), site_from)), shown)


def _shown_name(path: Column, name: Column, site_from: str | None) -> Column:
    """The file name that a row and its site go by."""
    return name if site_from is None else F.regexp_extract(C.decode_file_name(path), site_from, 1)


PATH, NAME = "__file_path", "__file_name"


def _layouts(spark: SparkSession, columns: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """(layout, header, places) and the columns of the result: ``places`` has, for each
    of them, its place in the header."""
    names = list(dict.fromkeys(c for h in sorted(columns) for c in columns[h]))
    places = [(k, h, [own.index(c) if c in own else None for c in names]) for k, (h, own) in enumerate(columns.items())]
    return spark.createDataFrame(places, "layout int, header string, places array<int>"), names


def _without_wide(lines: DataFrame, files: DataFrame, layouts: DataFrame, sep: str, chained: DataFrame) -> DataFrame:
    """``files`` with a reason for those with line breaks in quotes that have a record
    wider than their header, or one that goes on for too long."""
    long = chained.filter("too_long").select("path").distinct().withColumn("long", F.lit(True))
    files = files.join(long.withColumnRenamed("path", "file_path"), "file_path", "left")
    files = files.withColumn("reason", F.when(F.col("long"), f"record of over {RECORD_REST} characters").otherwise(F.col("reason"))).drop("long")
    files = materialise(files, "site-files")
    own = _with_layout(lines, files.filter("multi_line"), layouts)
    records = _whole(own, sep, chained.filter("not too_long").drop("too_long"))
    bare = _outside_quotes(F.col("value"), sep)
    filled = _field_count(bare, sep) - _trailing(F.col("value"), sep)
    wide = records.filter(filled > F.size(F.filter("places", F.isnotnull))).select(F.col(PATH).alias("file_path"), F.lit(True).alias("wide"))
    wide = wide.distinct()
    files = files.join(wide, "file_path", "left").withColumn(
        "reason", F.when(F.col("wide"), "row longer than header").otherwise(F.col("reason"))).drop("wide")
    return materialise(files, "site-files")


def _columns_at_places(records: DataFrame, names: list[str], sep: str, width: int) -> DataFrame:
    """The records as text columns, repeated headers and blank lines left out."""
    lines = records.filter((F.trim("value") != "") & (F.col("value") != F.col("header")))
    schema = ", ".join(f"f{i} string" for i in range(width))
    fields = F.from_csv("value", schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    # The line is cut once: through a generator, filters on its cells do not move
    # below it, where they would repeat the cutting for each cell.
    cells = lines.select(PATH, NAME, "places", fields.alias("f")).select(
        PATH, NAME, "places", F.explode(F.array(F.array(*[F.col(f"f.f{i}") for i in range(width)]))).alias("cells"))
    return cells.select(PATH, NAME, *[F.get("cells", F.get("places", F.lit(k))).alias(c) for k, c in enumerate(names)])


def _tagged(rows: DataFrame, names: dict[str, str], site_from: str | None,
            with_file: bool) -> DataFrame:
    """Missing tokens, empty rows, sentinel, site name: in this order, so a row
    of nothing but sentinels is not an empty row.

    The row test is written on the raw cells, apart from the output cells: a
    filter that repeats the expressions of all output columns makes the
    optimizer's inferred constraints double with every column.
    """
    file_name = _shown_name(F.col(PATH), C.decode_file_name(F.col(NAME)), site_from)
    filled = reduce(Column.__or__, [~C.col(field).isin(*config.NA_TOKENS) for field in names])
    missing = (*config.NA_TOKENS, config.SENTINEL)
    cells = [C.blank_to_null(C.col(field), missing).alias(name)
             for field, name in names.items() if name != "colegio"]
    out = [*cells, C.site_name(file_name).alias("colegio")]
    if with_file:
        out.append(file_name.alias("archivo"))
    return rows.filter(filled).select(*out)
