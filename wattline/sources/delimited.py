"""Many delimited reading files with differing separators and headers, read as one frame."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import canonical_id, parse_reading_time, quarter_label, row_hash, safe_double, time_text
from wattline.sources.scratch import written
from wattline.spec import HEADER_ALIASES, POWER_COLUMNS, READING_COLUMNS, REQUIRED_COLUMNS, SEPARATORS


MAX_HEADER_BYTES = 1 << 19


class UnmappableFiles(ValueError):
    """Some files' headers cannot be mapped to the required columns."""


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """Path, name and size of the files of a folder; file contents are not opened."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    return file_columns(reader.load(folder))


def file_columns(listed: DataFrame) -> DataFrame:
    """The file frame all functions here take, from a binary-file listing (batch or stream)."""
    path = one_spelling(F.col("path"))
    return listed.select(path.alias("path"), base_name(path).alias("source_filename"), F.col("length").alias("file_size_bytes"))


def one_spelling(path: Column) -> Column:
    """A file's full path as the file listing spells it: local paths have one slash after the scheme."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scanned_path() -> Column:
    """The path of the file a row was scanned from, in the listing's spelling (scans encode odd characters). As it is computed for
    every row, a path without such characters is not decoded, and slashes are cut without a regular expression."""
    path = F.col("_metadata.file_path")
    decoded = F.when(F.contains(path, F.lit("%")), F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.when(decoded.startswith("file:/"), F.concat(F.lit("file:/"), F.ltrim(F.substr(decoded, F.lit(7)), F.lit("/")))).otherwise(decoded)


def literal_path(path: str) -> str:
    """A path for a reader, which would take these characters as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def open_file(path: str):
    """A stream of a file's bytes; the path is taken as it is, whatever characters it holds."""
    from pyarrow import fs

    scheme, authority, rest = re.match(r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/]*))?(.*)$", path, re.S).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem().open_input_stream(rest)
    store, base = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}://{authority or ''}/")
    return store.open_input_stream(base.rstrip("/") + rest)


def sniff_headers(files: DataFrame, max_header_bytes: int = MAX_HEADER_BYTES) -> DataFrame:
    """Header line, separator and header names of each file.

    Each task opens its share of the files and reads up to the first line end (of any kind) only; a Spark text
    scan would have to read the files whole. A file without a line end in its first ``max_header_bytes`` has no header
    line (null) unless it ends before. Names are in file order, one per column: columns without a name are empty.
    """

    def first_lines(batches):
        import pyarrow as pa

        def first_line(path):
            data = b""
            with open_file(path) as stream:
                while len(data) < max_header_bytes and not re.search(rb"[\r\n]", data):
                    chunk = stream.read(min(65536, max_header_bytes - len(data)))
                    if not chunk:
                        break
                    data += chunk
                else:
                    if not re.search(rb"[\r\n]", data):
                        return None
            return re.split(rb"[\r\n]", data, maxsplit=1)[0].decode("utf-8-sig", "replace").strip(" ")

        for batch in batches:
            lines = [first_line(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.string())], [*batch.schema.names, "header_line"])

    # a few files per task, and for very many files a hundred
    count = files.count()
    spread = files.repartition(max(1, min(count // 4, max(1_000, count // 100))))
    lines = spread.mapInArrow(first_lines, T.StructType([*spread.schema, T.StructField("header_line", T.StringType())]))
    separator = detect_separator(F.col("header_line"))
    return lines.withColumn("separator", separator).withColumn("headers", header_names(F.col("header_line"), F.col("separator")))


def named_headers() -> Column:
    """The header names that are not empty."""
    return F.filter("headers", lambda h: F.length(h) > 0)


def detect_separator(line: Column) -> Column:
    """The candidate that occurs most often; earlier candidates win ties, none present means comma."""

    def occurrences(sep: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit("")))

    most = F.greatest(*[occurrences(s) for s in SEPARATORS])
    choice = F.when(most <= 0, F.lit(SEPARATORS[0]))
    for sep in SEPARATORS:
        choice = choice.when(occurrences(sep) == most, F.lit(sep))
    return F.coalesce(choice, F.lit(SEPARATORS[0]))


def header_names(line: Column, separator: Column) -> Column:
    """Unquoted, trimmed names in file order, one per column; separators inside quotes do not count."""
    plain = F.concat(F.lit("\\Q"), separator, F.lit("\\E"))
    outside = F.concat(plain, F.lit('(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    fields = F.when(F.contains(line, F.lit('"')), F.split(line, outside)).otherwise(F.split(line, plain))
    return F.transform(fields, lambda h: F.trim(F.replace(h, F.lit('"'), F.lit(""))))


def _normal(name: Column) -> Column:
    return F.upper(F.trim(name))


def map_headers(sniffed: DataFrame, proposals: DataFrame | None = None) -> DataFrame:
    """How each file's columns map to the expected ones.

    Adds ``kind``, ``mapping`` (expected name to 0-based position in the file) and, for files that
    cannot be used, ``problem``:
    ``full`` when the headers are the whole expected list in order, ignoring case; else
    ``required`` when every required column is found under one of its known spellings; else
    ``required`` when ``proposals`` (path, incoming, target), repaired against the real headers,
    cover the required columns, or ``full`` when they cover all expected columns without
    duplicates; else ``reject``.
    """
    upper = F.transform("headers", lambda h: _normal(h))
    files = sniffed.withColumn("upper_headers", upper)
    expected = F.array(*[F.lit(c) for c in READING_COLUMNS])
    exact = F.filter("upper_headers", lambda h: F.length(h) > 0) == expected

    # headers spelled alike: the last one counts
    def position(name: Column) -> Column:
        return F.size("upper_headers") - F.array_position(F.reverse("upper_headers"), name)

    def by_alias(target: str) -> Column:
        found = F.filter(
            F.array(*[F.lit(a) for a in HEADER_ALIASES[target]]), lambda a: F.array_contains("upper_headers", a)
        )
        return F.when(F.size(found) > 0, position(F.get(found, F.lit(0))))

    def mapping(positions: dict[str, Column]) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(k) for k in positions]), F.array(*[v.cast("int") for v in positions.values()])
        )

    aliases = {c: by_alias(c) for c in REQUIRED_COLUMNS}
    all_found = reduce(lambda a, b: a & b, [p.isNotNull() for p in aliases.values()])
    mapped = files.withColumn(
        "kind", F.when(exact, "full").when(all_found, "required").otherwise("reject")
    ).withColumn(
        "mapping",
        F.when(exact, mapping({c: position(F.lit(c)) for c in READING_COLUMNS})).when(all_found, mapping(aliases)),
    )
    missing = F.filter(
        F.array(*[F.when(aliases[c].isNull(), F.lit(c)) for c in REQUIRED_COLUMNS]), lambda c: c.isNotNull()
    )
    reason = F.concat(F.lit("no column for "), F.concat_ws(", ", missing))
    no_line = F.lit(f"no line end in the first {MAX_HEADER_BYTES} bytes")
    reason = F.when(F.col("header_line").isNull(), no_line).otherwise(reason)
    mapped = mapped.withColumn("problem", F.when(F.col("kind") == "reject", reason))
    if proposals is not None:
        mapped = _apply_proposals(mapped, proposals)
    return mapped.drop("upper_headers")


def repair_proposals(sniffed: DataFrame, proposals: DataFrame) -> DataFrame:
    """Proposed (incoming, target) pairs with the incoming name as the file spells it.

    An exact name is kept, another case is corrected, a name the file lacks is dropped.
    """
    names = sniffed.select("path", F.posexplode("headers").alias("pos", "name"))
    names = names.where("length(name) > 0")
    pairs = proposals.join(names, "path").where(_normal(F.col("incoming")) == _normal(F.col("name")))
    best = F.max_by(F.struct("pos", "name"), F.struct(F.col("name") == F.col("incoming"), "pos"))
    return pairs.groupBy("path", "incoming", "target").agg(best.alias("b")).select("path", "b.pos", "b.name", "target")


def _apply_proposals(mapped: DataFrame, proposals: DataFrame) -> DataFrame:
    repaired = repair_proposals(mapped, proposals)
    # one target per file column; the result names of a file after renaming
    proposed = repaired.groupBy("path").agg(F.collect_list(F.struct("target", "pos")).alias("pairs"))
    joined = mapped.join(proposed, "path", "left").withColumn("pairs", F.coalesce("pairs", F.array().cast("array<struct<target:string,pos:int>>")))
    targets = F.transform("pairs", lambda p: p["target"])
    required = F.array(*[F.lit(c) for c in REQUIRED_COLUMNS])
    covers = F.size(F.array_except(required, targets)) == 0
    # names after renaming: a header keeps its own name unless a pair names its position
    renamed = F.transform(
        "headers",
        lambda h, i: F.coalesce(
            F.get(F.transform(F.filter("pairs", lambda p: p["pos"] == i), lambda p: p["target"]), F.lit(0)), h
        ),
    )
    expected = F.array(*[F.lit(c) for c in READING_COLUMNS])
    lacking = F.array_except(expected, renamed)
    some = F.filter(renamed, lambda h: F.length(h) > 0)
    repeated = F.size(F.array_distinct(some)) < F.size(some)
    complete = (F.size(lacking) == 0) & ~repeated

    def positions(columns: list[str], names: Column) -> Column:
        return F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]),
            F.array(*[(F.array_position(names, c) - 1).cast("int") for c in columns]),
        )

    open_file = F.col("kind") == "reject"
    by_pairs = F.map_from_arrays(
        required, F.transform(required, lambda c: F.get(F.filter("pairs", lambda p: p["target"] == c), F.lit(0))["pos"])
    )
    problem = F.when(repeated, F.lit("names repeat after mapping")).otherwise(
        F.concat(F.lit("no column for "), F.concat_ws(", ", lacking))
    )
    return joined.withColumns(
        {
            "mapping": F.when(open_file & covers, by_pairs)
            .when(open_file & complete, positions(READING_COLUMNS, renamed))
            .otherwise(F.col("mapping")),
            "kind": F.when(open_file & covers, "required").when(open_file & complete, "full").otherwise(F.col("kind")),
            "problem": F.when(open_file & ~covers & ~complete, F.when(F.size("pairs") > 0, problem).otherwise(F.col("problem"))),
        }
    ).drop("pairs")


def read_layouts(spark: SparkSession, mapped: DataFrame, with_rejects: bool = False) -> DataFrame:
    """Rows of all mapped files as text columns under their expected names, with the file's path in ``source_filename``.

    Files of one layout (separator and column positions) are one scan; there are as many scans as
    layouts, not files. Only file names reach the driver, which lists them for any scan anyway.
    Columns are read by their true position in the file, unnamed columns counted, so repeated or odd header
    names do no harm.
    A file without data rows adds nothing; columns its layout lacks are null.

    ``with_rejects`` adds ``rejected``: whether a line holds more fields than its file's header, so that nobody can tell which column a
    value belongs to. Lines with fewer fields lack the last columns and are kept.
    """
    usable = mapped.where("kind <> 'reject'").select(
        "path", "separator", "kind", F.size("headers").alias("width"), F.sort_array(F.map_entries("mapping")).alias("at")
    )
    layouts: dict[tuple, list[str]] = {}
    for row in usable.toLocalIterator():
        layout = (row["separator"], row["kind"], row["width"], tuple((e["key"], e["value"]) for e in row["at"]))
        layouts.setdefault(layout, []).append(row["path"])
    frames = []
    for (separator, kind, width, at), paths in sorted(layouts.items()):
        fields = [f"c{i} string" for i in range(width)] + ["_line string"] * with_rejects
        rows = (
            spark.read.schema(", ".join(fields))
            .option("header", True)
            .option("sep", separator)
            .option("quote", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_line")
            .csv([literal_path(p) for p in sorted(paths)])
        )
        position = dict(at)
        order = READING_COLUMNS if kind == "full" else REQUIRED_COLUMNS
        # Spark sets the line aside when its number of fields is another than the header's; it refuses plans that read
        # nothing but that column, hence the second condition, which always holds
        too_many = (F.size(header_names(F.col("_line"), F.lit(separator))) > width) & (F.coalesce(F.length("c0"), F.lit(0)) >= 0)
        frames.append(
            rows.select(
                *[F.col(f"c{position[n]}").alias(n) for n in order],
                scanned_path().alias("source_filename"),
                *([(F.col("_line").isNotNull() & too_many).alias("rejected")] if with_rejects else []),
            )
        )
    if not frames:
        names = ", ".join(f"{c} string" for c in [*REQUIRED_COLUMNS, "source_filename"])
        return spark.createDataFrame([], names + (", rejected boolean" if with_rejects else ""))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_readings(raw: DataFrame, with_hash: bool = True) -> DataFrame:
    """Typed and keyed readings from text columns: ids without leading zeros, times at whole
    minutes, power as double (unparsable text is null), time text, quarter and row hash."""
    return with_derived(typed_readings(raw), with_hash)


def typed_readings(raw: DataFrame) -> DataFrame:
    """Readings from text columns, without what is derived from meter and time."""
    return raw.withColumns(
        {
            "METER_ID": canonical_id(F.col("METER_ID")),
            "DATA_TIME": parse_reading_time(F.col("DATA_TIME")),
            **{c: safe_double(F.col(c)) for c in POWER_COLUMNS if c in raw.columns},
        }
    )


def with_derived(typed: DataFrame, with_hash: bool = True) -> DataFrame:
    """Time text, quarter and row hash of typed readings."""
    derived = typed.withColumns(
        {
            "DATA_TIME_STR": time_text(F.col("DATA_TIME")),
            "QUARTER": quarter_label(F.col("DATA_TIME")),
        }
    )
    if not with_hash:
        return derived
    return derived.withColumn("ROW_HASH", row_hash(F.col("METER_ID"), F.col("DATA_TIME_STR")))


Resolver = Callable[[DataFrame], DataFrame]


def read_readings(
    spark: SparkSession,
    files: DataFrame,
    *,
    resolver: Resolver | None = None,
    on_reject: str = "fail",
    with_hash: bool = True,
    with_rejects: bool = False,
    derived: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Clean readings of a set of files, and the files' mapping frame. Lines that hold more fields than their file's header are left
    out, or with ``with_rejects`` marked in a column ``rejected``. Without ``derived`` the columns that ``with_derived`` adds are left
    to the caller, who may have fewer rows by then.

    ``resolver`` may propose mappings for files whose headers are unknown: it gets the rejected
    files (path, headers) and returns (path, incoming, target). Files still unknown stop the run
    unless ``on_reject="skip"``, when the mapping frame tells their problem; files without any header name are always
    skipped.
    """
    sniffed = written(sniff_headers(files), "headers").where(F.col("header_line").isNull() | (F.size(named_headers()) > 0))
    mapped = map_headers(sniffed)
    if resolver is not None:
        unknown = mapped.where("kind = 'reject'").select("path", "headers")
        mapped = map_headers(sniffed, resolver(unknown))
    if on_reject == "fail":
        rejected = mapped.where("kind = 'reject'").select("source_filename", "problem")
        shown = rejected.limit(20).collect()
        if shown:
            more = rejected.count() - len(shown)
            raise UnmappableFiles("; ".join(f"{name}: {problem}" for name, problem in shown) + (f"; and {more} more" if more else ""))
    rows = read_layouts(spark, mapped, with_rejects=True)
    kept = rows if with_rejects else rows.where(~F.col("rejected")).drop("rejected")
    return clean_readings(kept, with_hash) if derived else typed_readings(kept), mapped


def count_rows(raw: DataFrame) -> DataFrame:
    """Rows per input file, by its path; where rows are marked ``rejected`` also those kept."""
    kept = [F.count_if(~F.col("rejected")).alias("rows_kept")] if "rejected" in raw.columns else []
    return raw.groupBy(F.col("source_filename").alias("path")).agg(F.count("*").alias("rows_input"), *kept)
