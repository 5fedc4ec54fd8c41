"""Sources and sinks: scan trees, tables with odd headers, box labels, traces."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# fixed values: what windows-1252 has at the bytes 0x80 to 0x9F, where ISO-8859-1 has control characters; five bytes are free
WINDOWS_1252 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž",
    0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}


def as_windows_1252(text: Column) -> Column:
    """Text that was decoded as ISO-8859-1, as if it had been decoded as windows-1252."""
    return F.translate(text, "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values()))


def located(files: DataFrame) -> DataFrame:
    """files with directory, subdirectory and filename from their path."""
    parts = F.split("path", "/")
    return files.select("*", *[F.try_element_at(parts, F.lit(-i)).alias(n) for i, n in ((3, "directory"), (2, "subdirectory"), (1, "filename"))])


def has_extension(path: Column, extension: str) -> Column:
    return F.endswith(F.lower(path), F.lit(extension.lower()))


def scan_tree(spark: SparkSession, root: str, extension: str = ".png") -> DataFrame:
    """path, directory, subdirectory, filename and size of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return located(files.where(has_extension(F.col("path"), extension)))


def inventory(files: DataFrame) -> DataFrame:
    return files.groupBy("directory", "subdirectory").agg(F.count("*").alias("images")).withColumn("subdir_id", F.concat_ws("_", "directory", "subdirectory"))


def directory_counts(files: DataFrame) -> DataFrame:
    """Subdirectories and files of each directory."""
    return files.groupBy("directory").agg(F.count_distinct("subdirectory").alias("subdirectories"), F.count("*").alias("images"))


def pruned(files: DataFrame, excluded: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(files outside the excluded folders, folders that were skipped)."""
    hit = F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(e) for e in excluded]))
    skipped = files.where(hit).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    return files.where(~hit), skipped


def names_with(path: Column, keywords: Sequence[str], every: bool = False) -> Column:
    """Whether a path holds one, or all, of some keywords, in any case."""
    tests = [F.contains(F.lower(path), F.lit(k.lower())) for k in keywords]
    out = tests[0]
    for t in tests[1:]:
        out = out & t if every else out | t
    return out


def images(spark: SparkSession, root: str) -> DataFrame:
    """Pictures decoded by Spark: path, height, width, nChannels, data."""
    return spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(root).select(F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels", "image.data")


def pixel_table(pictures: DataFrame) -> DataFrame:
    """(path, height, width, y, x, v) of the pixels above 0 of decoded pictures, colours by luma; a batch of rows for each picture."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["nChannels"])
                # Spark's order of colours is blue, green, red
                grey = a[:, :, 0] if r["nChannels"] == 1 else np.round(a[:, :, :3].astype(float) @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)
                y, x = (p.astype(np.int32) for p in np.nonzero(grey))
                same = [pa.array(np.full(len(y), r[c], np.int32)) for c in ("height", "width")]
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(y), pa.string()), *same, pa.array(y), pa.array(x), pa.array(grey[y, x].astype(np.int32))], ["path", "height", "width", "y", "x", "v"])

    return pictures.select("path", "height", "width", "nChannels", "data").mapInArrow(run, "path string, height int, width int, y int, x int, v int")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8", nulls: str | None = None, header: bool = True) -> DataFrame:
    """Delimited text with a declared schema; many files at once, with the file of each row.

    windows-1252 is read as ISO-8859-1, and the bytes in which both differ are put right in the text columns.
    """
    western = encoding.lower() in ("cp1252", "windows-1252")
    encoding = "ISO-8859-1" if western else {"utf-8-sig": "UTF-8"}.get(encoding.lower(), encoding)
    reader = spark.read.schema(schema).option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    rows = (reader.option("nullValue", nulls) if nulls is not None else reader).csv(path).withColumn("source_file", F.col("_metadata.file_path"))
    texts = [f.name for f in rows.schema if f.dataType == T.StringType() and f.name != "source_file"] if western else []
    return rows.withColumns({c: as_windows_1252(F.col(f"`{c}`")) for c in texts}) if texts else rows


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text: UTF-8 if valid, else as windows-1252."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", F.coalesce(F.try_validate_utf8(F.expr("CAST(content AS STRING)")), as_windows_1252(F.decode("content", "ISO-8859-1"))).alias("text"))


def read_spaced(spark: SparkSession, path: str, names: Sequence[str], fields: int | None = None) -> DataFrame:
    """Lines of space-separated fields behind a preamble: those with the right number of fields and not the header."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(F.size(parts) == (fields or len(names)))
    return lines.select(*[parts[i].alias(n) for i, n in enumerate(names)]).where(F.lower(F.col(names[0])) != names[0].lower())


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """First line of each label file: class, centre and size."""
    parts = F.split("value", r"\s+")
    first = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.trim(F.split("value", "\n")[0]).alias("value"))
    return first.select("path", *[F.try_element_at(parts, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(("cls", "cx", "cy", "w", "h"))])


def write_boxes(boxes: DataFrame, path: str) -> None:
    boxes.select(F.concat_ws(" ", *[F.format_string("%.6f", F.col(c)) if c != "cls" else F.col(c).cast("int").cast("string") for c in ("cls", "cx", "cy", "w", "h")]).alias("value")).write.mode("overwrite").text(path)


def write_traces(points: DataFrame, path: str) -> None:
    """Long table of points (directory, ..., x, y), a folder for each directory; rows of a large directory go to several files."""
    points.write.mode("overwrite").partitionBy("directory").parquet(path)


def read_traces(spark: SparkSession, path: str, schema: T.StructType | str, directories: Sequence[str] = ()) -> DataFrame:
    """Points of all or some directories; only the folders of those are read."""
    points = spark.read.schema(schema).parquet(path)
    return points.where(F.col("directory").isin(*directories)) if directories else points


def append_once(new: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Append the rows whose key is not in the delimited files yet, the first time as well, each file with its header; returns the table."""
    spark = new.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    fresh = new.join(spark.read.schema(new.schema).option("header", True).csv(path).select(*keys), list(keys), "left_anti") if there else new
    fresh.write.mode("append").option("header", True).csv(path)
    return spark.read.schema(new.schema).option("header", True).csv(path)


def scaled_to_bytes(pixels: DataFrame, key: str, value: str) -> DataFrame:
    """Pixels of any depth with the value of each picture's range spread over 0 to 255, rounded down; 0 for pictures of one value."""
    ends = pixels.groupBy(key).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    spread = F.when(F.col("__high") > F.col("__low"), F.floor((F.col(value) - F.col("__low")) * 255 / (F.col("__high") - F.col("__low")))).otherwise(0)
    return pixels.join(ends, key).withColumn(value, spread.cast("int")).drop("__low", "__high")
