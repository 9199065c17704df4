"""Report writers: ordered text parts, single files, compressed text, tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from opsledger.functions.cleaning import report_text
from opsledger.session import new_run_dir, remove_dir

# largest report in one file, as stored
SINGLE_BYTES = 256 << 20
# codecs whose files can be joined end to end
JOINABLE = {"none": "", "gzip": ".gz", "bzip2": ".bz2"}


def report_line(df: DataFrame, separator: str = ",") -> Column:
    """One text line per row: text columns cleaned, NULL written as 'null'."""
    cells = []
    for f in df.schema:
        cell = F.col(f"`{f.name}`")
        cell = report_text(cell) if isinstance(f.dataType, StringType) else cell.cast("string")
        cells.append(F.coalesce(cell, F.lit("null")))
    return F.concat_ws(separator, *cells)


def write_text_report(df: DataFrame, path: str, compression: str = "none") -> None:
    """Replace ``path`` with the report; a sorted frame gives part files in that order.

    Small reports come out as one part because adaptive execution joins small partitions;
    large ones stay parallel.
    """
    lines = df.select(report_line(df).alias("value"))
    lines.write.mode("overwrite").option("compression", compression).text(path)


def write_single_text(df: DataFrame, path: str, compression: str = "none") -> None:
    """Replace ``path`` with a folder that holds a report of at most ``SINGLE_BYTES`` as one text file.

    Tasks write the parts in parallel; then the files are joined end to end in the order of the parts. One file has one
    writer, so a larger report is refused and ``path`` stays as it was: :func:`write_text_report` writes its
    ordered parts in parallel.
    """
    if compression not in JOINABLE:
        raise ValueError(f"one file can be written with {sorted(JOINABLE)}, not {compression}")
    spark = df.sparkSession
    parts = new_run_dir(spark, "report-parts")
    df.select(report_line(df).alias("value")).write.option("compression", compression).text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    source, store = folder.getFileSystem(conf), target.getFileSystem(conf)
    size = source.getContentSummary(folder).getLength()
    if size > SINGLE_BYTES:
        remove_dir(spark, parts)
        raise ValueError(f"a report of {size} bytes stays in parts; use write_text_report")
    names = sorted(s.getPath().getName() for s in source.listStatus(folder) if s.getPath().getName().startswith("part-"))
    store.delete(target, True)
    out = store.create(jvm.org.apache.hadoop.fs.Path(target, f"part-00000.txt{JOINABLE[compression]}"))
    try:
        for name in names:
            piece = source.open(jvm.org.apache.hadoop.fs.Path(folder, name))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, out, conf, False)
            finally:
                piece.close()
    finally:
        out.close()
    remove_dir(spark, parts)


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> None:
    """Any data source by format and options (files here, external tables on a cluster)."""
    writer = df.write.format(fmt).mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer.save(path)
    else:
        writer.save()
