"""Page and label files from directory trees and zip archives.

``zipmembers`` is a Python data source with a partition for each range of members
of ``SPLIT_BYTES``, so a large archive is read by many tasks. Contents
are read only if asked for. Of files with the same base name the first by path
wins, as a tree that lists a page twice means the same page.
"""

from __future__ import annotations

import glob
import os
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from gridloom.operators.csv_records import SUFFIXES

#: Bytes of members that one task reads, or one member.
SPLIT_BYTES = 64 << 20


@dataclass
class _Members(InputPartition):
    path: str
    first: int
    end: int


def _ranges(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of members that hold at most so many bytes, or one member."""
    first = held = 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.pattern = options["path"]
        self.content = options.get("content", "true").lower() == "true"
        self.bytes = int(options.get("bytes", SPLIT_BYTES))

    @staticmethod
    def _listed(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
        return sorted((i for i in archive.infolist() if not i.is_dir()), key=lambda i: i.filename)

    def partitions(self) -> list[InputPartition]:
        """Ranges of members from the directory at the end of each archive; no member is read here."""
        out = []
        for path in sorted(glob.glob(self.pattern)):
            with zipfile.ZipFile(path) as archive:
                sizes = [i.file_size if self.content else 1 for i in self._listed(archive)]
            out += [_Members(path, first, end) for first, end in _ranges(sizes, self.bytes)]
        return out

    def read(self, partition: _Members) -> Iterator[tuple]:
        with zipfile.ZipFile(partition.path) as archive:
            for info in self._listed(archive)[partition.first : partition.end]:
                yield partition.path, info.filename, info.file_size, archive.read(info) if self.content else None


class ZipMembers(DataSource):
    """``spark.read.format("zipmembers").load("/in/*.zip")``; option ``content=false`` lists members only, ``bytes`` is what a task reads at most."""

    @classmethod
    def name(cls) -> str:
        return "zipmembers"

    def schema(self) -> str:
        return "archive string, member string, size bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _ZipReader(dict(self.options))


def zip_members(spark: SparkSession, pattern: str, content: bool = True) -> DataFrame:
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zipmembers").option("content", str(content).lower()).load(pattern)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def is_data_file(path: Column, suffixes: tuple[str, ...]) -> Column:
    """Has one of the suffixes and is no leftover of an operating system."""
    name = F.lower(base_name(path))
    fits = F.lit(False)
    for s in suffixes:
        fits = fits | name.endswith(s)
    return fits & ~name.startswith("._") & (name != ".ds_store") & ~path.rlike("(^|/)__MACOSX(/|$)")


def _under(path: Column, prefixes: tuple[str, ...]) -> Column:
    fits = F.lit(not prefixes)
    for p in prefixes:
        fits = fits | path.startswith(p)
    return fits


def first_by_name(rows: DataFrame, *order: str) -> DataFrame:
    by = Window.partitionBy("file_name").orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")


def zip_images(spark: SparkSession, pattern: str, prefixes: tuple[str, ...] = (), content: bool = True) -> DataFrame:
    rows = zip_members(spark, pattern, content)
    kept = rows.where(is_data_file(F.col("member"), SUFFIXES) & _under(F.col("member"), prefixes))
    named = kept.select(base_name(F.col("member")).alias("file_name"), "archive", "member", "content")
    return first_by_name(named, "archive", "member").withColumn("source", F.concat_ws("!", "archive", "member")).drop("archive", "member")


def zip_markdown(spark: SparkSession, pattern: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Labels, keyed by the name of their page."""
    rows = zip_members(spark, pattern)
    kept = rows.where(is_data_file(F.col("member"), (".md",)) & _under(F.col("member"), prefixes))
    name = F.regexp_replace(base_name(F.col("member")), r"\.[^.]*$", ".jpg")
    named = kept.select(name.alias("file_name"), "archive", "member", F.decode("content", "UTF-8").alias("text"))
    return first_by_name(named, "archive", "member").withColumn("source", F.concat_ws("!", "archive", "member")).drop("archive", "member")


def directory_images(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = files.where(is_data_file(F.col("path"), SUFFIXES)).select(base_name(F.col("path")).alias("file_name"), F.col("path").alias("source"), *(["content"] if content else []))
    return first_by_name(rows, "source")


def directory_markdown(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.regexp_replace(base_name(F.col("path")), r"\.[^.]*$", ".jpg")
    rows = files.where(is_data_file(F.col("path"), (".md",))).select(name.alias("file_name"), F.col("path").alias("source"), F.decode("content", "UTF-8").alias("text"))
    return first_by_name(rows, "source")


def page_images(spark: SparkSession, raw: str, content: bool = True) -> DataFrame:
    """Images of a raw folder: its directories if it has any, else its archives."""
    if any(os.path.isdir(os.path.join(raw, d)) for d in os.listdir(raw)):
        return directory_images(spark, raw, content)
    return zip_images(spark, os.path.join(raw, "*.zip"), content=content)


def extract(pattern: str, target: str) -> list[str]:
    """Unpack archives below ``target``; members that would land elsewhere are refused."""
    written = []
    base = os.path.realpath(target)
    for path in sorted(glob.glob(pattern)):
        with zipfile.ZipFile(path) as archive:
            for info in archive.infolist():
                name = os.path.basename(info.filename)
                if info.is_dir() or name.startswith("._") or name == ".DS_Store" or "__MACOSX" in info.filename.split("/"):
                    continue
                to = os.path.realpath(os.path.join(base, info.filename))
                if os.path.commonpath([base, to]) != base:
                    raise ValueError(f"{info.filename} leads out of the target")
                os.makedirs(os.path.dirname(to), exist_ok=True)
                with archive.open(info) as source, open(to, "wb") as out:
                    out.write(source.read())
                written.append(to)
    return written


def inspect(spark: SparkSession, raw: str, template: DataFrame | None = None) -> dict[str, int]:
    """Counts of pages, labels, pages without label and, with a template, names it lacks."""
    pages = page_images(spark, raw, content=False).select("file_name")
    dirs = any(os.path.isdir(os.path.join(raw, d)) for d in os.listdir(raw))
    labels = (directory_markdown(spark, raw) if dirs else zip_markdown(spark, os.path.join(raw, "*.zip"))).select("file_name")
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    out = {"images": pages.count(), "labels": labels.count()}
    out["unlabelled"] = pages.join(labels, stem(pages.file_name) == stem(labels.file_name), "left_anti").count()
    if template is not None:
        out["in_template"] = pages.join(template, "file_name", "left_semi").count()
        out["not_in_template"] = pages.join(template, "file_name", "left_anti").count()
    return out
