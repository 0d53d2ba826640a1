"""Reading CSV sources and reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fieldlake.contracts import ServingContract, SourceContract
from fieldlake.errors import SourceError
from fieldlake.operators.conform import spark_schema
from fieldlake.sources import skipping, versions
from fieldlake.sources.records import quoted_records

SOURCE_FILE = "_source_file"
MALFORMED = "_malformed"

# The writers of the sources double their quotes; Spark's own default escape is a backslash.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def csv_options(contract: SourceContract) -> dict[str, str]:
    """Options of a contract's files, a line being a record. A header in another order than the contract's is an error."""
    return {**CSV_DIALECT, "enforceSchema": "false", "columnNameOfCorruptRecord": MALFORMED}


def find_contract(contracts: Mapping[str, SourceContract], name: str) -> SourceContract:
    if name not in contracts:
        raise SourceError(f"unknown source {name!r}; known are {sorted(contracts)}")
    return contracts[name]


def _load_csv(spark: SparkSession, contract: SourceContract, path: str, schema: str) -> DataFrame:
    """Rows with their malformed text and their file. Files with free text are cut into records first."""
    schema, options = f"{schema}, `{MALFORMED}` string", csv_options(contract)
    records = quoted_records(spark, path, contract.column_names) if contract.free_text else None
    if records is not None:
        parsed = records.select("file", F.from_csv("record", schema, {**options, "multiLine": "true"}).alias("row"))
        return parsed.select("row.*", F.col("file").alias(SOURCE_FILE))
    try:
        rows = spark.read.schema(schema).options(**options).csv(path)
    except AnalysisException as problem:
        raise SourceError(f"{contract.name}: nothing to read at {path}") from problem
    return rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_source(spark: SparkSession, contract: SourceContract, path: str) -> DataFrame:
    """A CSV source with its contract's types. A malformed cell is NULL; its row keeps the rest.

    The text of a row with a malformed cell is in ``_malformed``.
    """
    return _load_csv(spark, contract, path, contract.columns).drop(SOURCE_FILE)


def read_raw(spark: SparkSession, contract: SourceContract, path: str) -> DataFrame:
    """A CSV source as text, with the file each row came from."""
    return _load_csv(spark, contract, path, contract.text_schema)


def ingest_raw(
    spark: SparkSession, contract: SourceContract, path: str, table: str, fmt: str = "parquet", kept: int = versions.KEPT
) -> dict[str, int]:
    """Copy a source into its raw table, replacing the table. The source files stay as they are.

    Returns the number of rows and of malformed rows, both counted while writing.
    """
    raw = read_raw(spark, contract, path)
    return write_counted(raw, table, fmt, reads=[path], counts={"malformed": MALFORMED}, kept=kept)


def malformed_rows(raw: DataFrame) -> DataFrame:
    """One row: rows and how many of them did not fit the schema."""
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path as its file system names it, so that ``/a``, ``file:/a`` and ``/b/../a`` are the same."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = found.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri().normalize()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def _overlaps(spark: SparkSession, one: str, other: str) -> bool:
    a, b = (qualified(spark, path).rstrip("/") + "/" for path in (one, other))
    return a.startswith(b) or b.startswith(a)


def _observed(seen: Observation, names: Sequence[str]) -> dict[str, int]:
    """What a finished write has counted. Where Spark found while running that there is no row, it drops the
    counting with the rest of the plan, and an observation without a row is an assertion that fails."""
    try:
        return {name: int(value) for name, value in seen.get.items()}
    except Py4JJavaError as problem:
        if "AssertionError" not in str(problem.java_exception):
            raise
        return dict.fromkeys(names, 0)


def write_counted(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    reads: Sequence[str] = (),
    counts: Mapping[str, str] | None = None,
    cluster_by: Sequence[str] = (),
    index: Sequence[str] = (),
    kept: int = versions.KEPT,
) -> dict[str, int]:
    """Write a table and return what was written: ``rows``, and the non-NULL values of the columns
    in ``counts``. Both are observed during the write; nothing is computed twice.

    With the format ``versioned`` the rows go to a new version of a Parquet table, which readers see when it
    is complete (see ``versions``). Other formats are replaced in place: ``reads`` are the paths the frame
    comes from, and a table may not replace its own input, since the input would be gone before it is read.
    Partitioned tables are first rebalanced on their
    partition columns: a partition becomes a few files of good size, a large one is split, and with
    ``cluster_by`` so that equal values of these columns lie together. A versioned table may have an
    ``index`` of columns (see ``skipping``), and ``kept`` of its versions stay.
    """
    for source in reads:
        if mode == "overwrite" and fmt != versions.FORMAT and _overlaps(df.sparkSession, source, path):
            raise SourceError(f"{path} cannot replace {source}, which it is read from")
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    measures += [F.count(F.col(column)).alias(name) for name, column in (counts or {}).items()]
    counted, names = df.observe(seen, *measures), ["rows", *(counts or {})]
    if partition_by:
        counted = counted.hint("rebalance", *partition_by, *cluster_by)
    if fmt == versions.FORMAT:
        if mode != "overwrite":
            raise SourceError(f"{path}: a version holds the whole table, so mode {mode} is not possible")
        number, folder = versions.next_folder(df.sparkSession, path)
        counted.write.partitionBy(*partition_by).parquet(folder, compression=versions.codec(df.sparkSession))
        written = _observed(seen, names)
        if index:
            skipping.write_index(df.sparkSession, folder, index)
        versions.publish(df.sparkSession, path, number, folder, df.dtypes, written, kept)
        return written
    writer = counted.write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return _observed(seen, names)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> int:
    """Write a table, by default replacing it and its schema, and return its number of rows."""
    return write_counted(df, path, fmt, **options)["rows"]


def _resolved(spark: SparkSession, path: str, fmt: str) -> tuple[str, str]:
    """The path and format to read: of a table with versions the folder of the current one."""
    folder = versions.folder_of(spark, path) if fmt in ("parquet", versions.FORMAT) else None
    return (path, "parquet" if fmt == versions.FORMAT else fmt) if folder is None else (folder, "parquet")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table as it is now; of one with versions the current one, even if it is replaced before the frame is used."""
    try:
        path, fmt = _resolved(spark, path, fmt)
        return spark.read.format(fmt).load(path)
    except AnalysisException as problem:
        raise SourceError(f"no table at {path}") from problem


def read_typed(
    spark: SparkSession, contract: ServingContract, path: str, fmt: str = "parquet", view: str | None = None
) -> DataFrame:
    """A typed view over files that are already there, without copying them."""
    where, fmt = _resolved(spark, path, fmt)
    reader = spark.read.format(fmt)
    if fmt != "delta":
        reader = reader.schema(spark_schema(contract))
    try:
        table = reader.load(where).select(*contract.columns)
    except AnalysisException as problem:
        raise SourceError(f"{contract.name}: no table at {path}") from problem
    if view:
        table.createOrReplaceTempView(view)
    return table
