"""Files: readers with declared schemas, and writers with a chosen layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from claimscale import fixed
from claimscale.functions.text import file_key
from claimscale.functions.topics import Labels, ordered_labels
from claimscale.operators.compute import with_computed
from claimscale.operators.joins import held_bytes
from claimscale.session import shuffle_width

CLUSTER_BITS = 8  # per column: 256 shares of its rows
CLUSTER_SAMPLE = 100_000  # rows that the shares are cut by
CLUSTER_BYTES = 256 * 1024 * 1024

BINARY_SCHEMA = (
    "path string, modificationTime timestamp, length bigint, content binary"
)
ORGANISATION_SCHEMA = (
    "organisation string, description string, ticker string, url string, logo string"
)


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file, its bytes in ``content``.

    Files may lie in subfolders.  A query that does not select ``content`` does
    not read it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | StructType = ORGANISATION_SCHEMA,
    sep: str = "|",
) -> DataFrame:
    """Delimited text with a header line."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=False)


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=True)


def read_json(
    spark: SparkSession, path: str, schema: str | StructType = fixed.TOPIC_SCHEMA
) -> DataFrame:
    """JSON records with a declared schema: ids stay integers and nothing is inferred."""
    return spark.read.schema(schema).json(path)


def local_rows(
    spark: SparkSession, rows: Iterable[Sequence[object]], schema: str | StructType
) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def topic_dimension(
    spark: SparkSession, labels: Labels = fixed.TOPIC_LABELS
) -> DataFrame:
    """The topic labels as a table (topic_id, topic, policy)."""
    rows = [
        F.struct(*[F.lit(label[f]).alias(f) for f in ("topic_id", "topic", "policy")])
        for label in ordered_labels(labels)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A table addressed by its path."""
    return spark.read.parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Give the work after a small table scan at least one task per core.

    A Parquet row group is read by one task.  Pattern matching over a table of few
    row groups would leave most cores idle, so its rows are dealt out first.  A
    scan that already has a task for every core is returned as it is: no table
    that is large for its cluster is ever shuffled here.  ``scan`` must be a plain
    scan, for which counting the splits runs nothing.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(2 * cores)


def path_in_sql(path: str) -> str:
    """The same table as a relation in SQL text."""
    return "parquet.`" + path.replace("`", "``") + "`"


def replace_path(df: DataFrame, path: str) -> None:
    """Replace the files at a path."""
    df.write.mode("overwrite").parquet(path)


def clustered(
    df: DataFrame, key: str, spread: Sequence[str], files: int | None = None
) -> DataFrame:
    """Range-cluster rows by ``key`` so that a reader can skip files.

    ``spread`` must tell rows of one key apart: a key with very many rows is then
    cut into several files instead of filling one task.
    """
    by = [key, *spread]
    if files is None:
        return df.repartitionByRange(*by).sortWithinPartitions(*by)
    return df.repartitionByRange(files, *by).sortWithinPartitions(*by)


def value_borders(df: DataFrame, columns: Sequence[str], bits: int = CLUSTER_BITS) -> list[list]:
    """Per column the values that cut its rows into 2 ** ``bits`` shares, from a bounded sample."""
    rows = df.count()
    fraction = min(1.0, CLUSTER_SAMPLE / max(rows, 1))
    seen = df.select(*columns)
    seen = seen.sample(fraction, seed=1) if fraction < 1 else seen
    shares = 1 << bits
    held = seen.agg(*[F.array_sort(F.collect_list(c)).alias(f"b{n}") for n, c in enumerate(columns)])
    picked = [
        F.expr(
            f"transform(sequence(1, {shares - 1}), i -> get(b{n}, CAST(i * size(b{n}) DIV {shares} AS INT)))"
        )
        for n in range(len(columns))
    ]
    found = held.select(*picked).first()
    return [sorted({v for v in found[i] or [] if v is not None}) for i in range(len(columns))]


def _share_of(value: Column, borders: list, kind: DataType) -> Column:
    """How many of the sorted borders are not above the value: first by every 16th, then within."""
    if not borders:
        return F.lit(0)

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= value))

    parts = [borders[i : i + 16] for i in range(0, len(borders), 16)]
    told = [F.array(*[F.lit(b).cast(kind) for b in part]) for part in parts]
    part = at_most(F.array(*[F.lit(p[0]).cast(kind) for p in parts]))
    within = at_most(F.get(F.array(*told), part - 1))
    return F.when(part == 0, 0).otherwise((part - 1) * 16 + within)


def with_curve(
    df: DataFrame, columns: Sequence[str], name: str, bits: int = CLUSTER_BITS
) -> DataFrame:
    """``df`` with a key of the bits of every column's share, one of each in turn.

    Rows that are near in all columns have near keys.  Nulls count as the least value.
    At most 63 bits together.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits are more than 63")
    shares = []
    for c, borders in zip(columns, value_borders(df, columns, bits)):
        share = _share_of(F.col(c), borders, df.schema[c].dataType)
        shares.append(F.when(F.col(c).isNull(), 0).otherwise(share).cast("long"))
    keyed = with_computed(df, name, F.array(*shares))
    key = F.lit(0).cast("long")
    for i in range(len(columns)):
        share = F.get(name, F.lit(i))
        for bit in range(bits):
            one = F.shiftright(share, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
    return keyed.withColumn(name, key)


def clustered_by(
    df: DataFrame,
    columns: Sequence[str],
    spread: Sequence[str],
    files: int | None = None,
    target_bytes: int = CLUSTER_BYTES,
    bits: int = CLUSTER_BITS,
) -> DataFrame:
    """Cluster rows by several columns at once, so that a reader can skip files by each.

    Files follow a curve through the columns' quantiles.  ``spread`` tells rows apart
    that are equal in them, so a value with very many rows becomes several files.
    Without ``files`` there are as many as the rows' size asks for.
    """
    if files is None:
        files = max(1, -(-held_bytes(df) // target_bytes))
    keyed = with_curve(df, columns, "_curve", bits)
    placed = keyed.repartitionByRange(files, "_curve", *spread)
    return placed.sortWithinPartitions("_curve", *spread).drop("_curve")


def with_file_key(
    files: DataFrame, key: str = "ticker", pattern: str = fixed.FILE_KEY
) -> DataFrame:
    return files.withColumn(key, file_key(F.col("path"), pattern))


def write_document_files(
    pages: DataFrame, key: str, content: str, path: str, order: Sequence[str] = ()
) -> str:
    """Write one text file per key, under ``<key>=<value>/``.

    The rows of a key are the pages of its document, in the given order.  Returns
    the pattern that takes the key from the path of such a file.
    """
    tasks = shuffle_width(pages.sparkSession)
    (
        pages.select(key, content, *order)
        .repartition(tasks, key)
        .sortWithinPartitions(key, *order)
        .select(key, content)
        .write.partitionBy(key)
        .text(path)
    )
    return rf"/{key}=([^/]*)/"
