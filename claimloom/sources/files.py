"""Raw claim files: recursive scan, text-column detection, cleaning, incremental runs."""

from __future__ import annotations

import csv
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.functions.clean import clean
from claimloom.sources.uris import opened

# Suffix -> separator, and the names a text column may have.
SEPARATORS = {".csv": ",", ".tsv": "\t"}
TEXT_NAMES = ("text", "tweet", "statement", "title", "1", "2")
CORRUPT = "_corrupt_record"
GLOB = "*.{csv,tsv}"
FILES_AT_ONCE = 1000


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, suffix`` of every CSV and TSV file below a folder, at any depth; contents are not read."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", GLOB)
    return scan.load(folder).select("path", F.regexp_extract("path", r"(\.[a-z]+)$", 1).alias("suffix"))


def plain_name(path: Column) -> Column:
    """A file path as it is, from the percent-encoded form that file metadata has."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path that the readers take as it is, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def headers(files: DataFrame, sep: str | None = None, most: int = 1 << 20) -> DataFrame:
    """``path, header, names, error``: the first line of every file of ``files(path)``, at most ``most`` bytes of it, and its fields if ``sep`` is given.

    Executors read the beginning of each file and no more; an empty file has an empty header, and a file that can't be read an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, errors = [], []
            for path in batch["path"].to_pylist():
                line, error = _first_line(path, most)
                lines.append(line)
                errors.append(error)
            names = [header_names(x, sep) if sep and x else None for x in lines]
            columns = [batch["path"], pa.array(lines, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "header", "names", "error"])

    return files.select("path").mapInArrow(run, "path string, header string, names array<string>, error string")


def _first_line(path: str, most: int) -> tuple[str | None, str | None]:
    try:
        store, name = opened(path)
        with store.open_input_stream(name, compression=None) as file:
            data = b""
            while len(data) < most and not re.search(rb"[\r\n]", data) and (more := file.read(min(4096, most - len(data)))):
                data += more
        return re.split(rb"[\r\n]", data, maxsplit=1)[0].decode("utf-8", "replace"), None
    except OSError as error:
        return None, str(error).splitlines()[0]


def header_names(header: str, sep: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep))


def read_raw(
    spark: SparkSession, paths: str | list[str], sep: str, names: list[str], multi_line: bool = True
) -> DataFrame:
    """Delimited files of one header, with ``source_file``.

    Rows with too many fields are skipped; short rows are padded with nulls. Quoted
    line breaks need whole-file splits; switch ``multi_line`` off for huge plain files.
    """
    schema = StructType([StructField(c, StringType()) for c in [*names, CORRUPT]])
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"')
    reader = reader.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    df = reader.option("columnNameOfCorruptRecord", CORRUPT).csv([literal(p) for p in ([paths] if isinstance(paths, str) else paths)])
    too_long = F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT), sep) > len(names))
    return df.where(~F.coalesce(too_long, F.lit(False))).select(
        *[F.col(f"`{c}`") for c in names], plain_name(F.col("_metadata.file_path")).alias("source_file")
    )


def field_count(record: Column, sep: str) -> Column:
    """Fields of a raw record, not counting separators inside quotes."""
    bare = F.regexp_replace(record, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def mean_lengths(df: DataFrame) -> DataFrame:
    """``position, column, mean_length`` of every column as text, in one pass; a null counts as ``nan``."""
    means = df.agg(
        *[
            F.avg(F.length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")))).alias(f"m{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"m{i}").alias("mean_length"))
        for i, c in enumerate(df.columns)
    ]
    return means.select(F.inline(F.array(*rows)))


def named_text_column(columns: list[str]) -> str | None:
    return next((c for c in columns if c.lower().strip() in TEXT_NAMES), None)


def text_column(df: DataFrame) -> str:
    """The column with a known name, else the one with the longest mean text (the first on a tie)."""
    named = named_text_column(df.columns)
    if named is not None:
        return named
    return mean_lengths(df).orderBy(F.desc("mean_length"), "position").first()["column"]


def text_of(df: DataFrame, names: list[str]) -> DataFrame:
    """Add ``_text``, the text column of each source file.

    A known name settles it for all files of a header. Otherwise each file takes its
    own longest column, from one aggregate per file.
    """
    named = named_text_column(names)
    if named is not None:
        return df.withColumn("_text", F.col(f"`{named}`"))
    lengths = [
        F.struct(F.avg(F.length(F.coalesce(F.col(f"`{c}`"), F.lit("nan")))).alias("mean"), F.lit(-i).alias("at"))
        for i, c in enumerate(names)
    ]
    widest = F.greatest(*lengths) if len(lengths) > 1 else lengths[0]
    chosen = df.groupBy("source_file").agg((-widest["at"]).alias("_at"))
    by_position = F.array(*[F.col(f"`{c}`") for c in names])
    return df.join(chosen, "source_file").withColumn("_text", F.get(by_position, F.col("_at"))).drop("_at")


def plain_path(path: str) -> str:
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def clean_group(
    spark: SparkSession, paths: list[str], sep: str, names: list[str], raw: str, multi_line: bool = True
) -> DataFrame:
    """Files of one header cleaned together: input columns, ``cleaned_text``, and the mirrored place."""
    df = text_of(read_raw(spark, paths, sep, names, multi_line), names)
    df = df.withColumn("cleaned_text", clean(F.coalesce("_text", F.lit("nan"))))
    relative = F.regexp_replace(
        F.regexp_replace("source_file", "^file:/*", "/"), f"^{re.escape(plain_path(raw))}/?", ""
    )
    return df.select(
        *[F.col(f"`{c}`") for c in names],
        "cleaned_text",
        F.regexp_extract(relative, "^(.*)/[^/]*$", 1).alias("source_dir"),
        F.concat(F.lit("cleaned_"), F.regexp_extract(relative, r"([^/]*)\.[a-z]+$", 1)).alias("source_name"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).limit(1).count()
        return True
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def clean_folder(
    spark: SparkSession, raw: str, processed: str, multi_line: bool = True, files_at_once: int = FILES_AT_ONCE
) -> DataFrame:
    """Clean every file not cleaned before and return ``path, status, detail``.

    Files go in lots of at most ``files_at_once``; of a lot, those with the same header are
    one job. If that job fails, its files are tried one by one, so that a bad file fails alone.
    Output is CSV under ``schema=<hash of the header>``, in one folder per source file;
    rewriting a file replaces only its own folder. What was done is in tables under
    ``processed``, not on the driver. With ``multi_line`` off, quoted line breaks are not
    kept together, and large files are split among tasks.
    """
    processed = processed.rstrip("/")
    log, run = f"{processed}/_cleaned", f"{processed}/_runs/{uuid.uuid4().hex}"
    schema = "path string, status string, detail string"
    files = list_files(spark, raw)
    todo = files
    if path_exists(spark, log):
        done = spark.read.schema("path string").parquet(log)
        todo = pending(files, done)
        skipped = files.join(done, "path", "left_semi")
        skipped.select("path", F.lit("skipped").alias("status"), F.lit("cleaned before").alias("detail")).write.parquet(run)
    # the list is kept in a table, because the log it depends on changes while the job runs; files of one header come together
    todo.join(headers(todo), "path").select("path", "suffix", "header", "error").orderBy("suffix", "header", "path").write.parquet(f"{run}-todo")
    waiting = spark.read.schema("path string, suffix string, header string, error string").parquet(f"{run}-todo").toLocalIterator()
    while lot := list(itertools.islice(waiting, files_at_once)):
        rows = [(r["path"], "failed", r["error"]) for r in lot if r["error"] is not None]
        for (sep, header), paths in _by_header(lot).items():
            target = f"{processed}/schema={hashlib.md5((sep + header).encode()).hexdigest()}"
            trials = [paths]
            while trials:
                trial = trials.pop()
                try:
                    out = clean_group(spark, trial, sep, header_names(header, sep), raw, multi_line)
                    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    writer.option("header", True).option("escape", '"').partitionBy("source_dir", "source_name").csv(target)
                    spark.createDataFrame([(p,) for p in trial], "path string").write.mode("append").parquet(log)
                    rows += [(p, "cleaned", target) for p in trial]
                except Exception as error:  # noqa: BLE001
                    if len(trial) > 1:
                        trials += [[p] for p in trial]
                    else:
                        rows.append((trial[0], "failed", str(error).splitlines()[0]))
        spark.createDataFrame(rows, schema).write.mode("append").parquet(run)
    if not path_exists(spark, run):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(run)


def _by_header(lot: list) -> dict[tuple[str, str], list[str]]:
    """Paths of a lot by separator and header."""
    out: dict[tuple[str, str], list[str]] = {}
    for r in lot:
        if r["error"] is None:
            out.setdefault((SEPARATORS[r["suffix"]], r["header"]), []).append(r["path"])
    return out


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files without a finished output: an anti-join on the path."""
    return files.join(done.select("path"), "path", "left_anti")


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned claims folder; rows whose cleaned text is missing or empty are dropped."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return drop_blank(reader.csv(path))


def drop_blank(df: DataFrame, column: str = "cleaned_text") -> DataFrame:
    return df.na.drop(subset=[column]).where(~F.col(column).isin("", "nan"))


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    words = vocabulary.select(F.col("term").alias("word")).orderBy("word")
    words.write.mode("errorifexists").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("errorifexists").option("header", True).csv(path)
