"""Members of zip archives on shared storage, read by many tasks at once."""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import ArrowInvalid, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medialoom.functions.columns import base_name
from medialoom.session import cut_lineage

PIECE_BYTES = 256 * 2**20  # unpacked bytes of an archive after which another task goes on
BATCH_BYTES = 16 * 2**20  # contents that leave a task together
READ = ["archive", "path", "content", "error"]
CONTENTS = "location string, archive string, member string, bytes long, place long, piece int, error string"
#: What a damaged member raises: a bad header or check sum, a broken or unknown compression.
DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """Archive locations; the bytes are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(F.col("path").alias("location"), base_name(F.col("path")).alias("archive"))


def _open(location: str) -> zipfile.ZipFile:
    system, path = fs.FileSystem.from_uri(location)
    return zipfile.ZipFile(system.open_input_file(path))


def archive_contents(archives: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(location, archive, member, bytes, place, piece, error): the tables of contents.

    ``place`` is where a member begins; the members of an archive in that order fall into
    pieces of about ``piece_bytes`` unpacked bytes. A corrupt archive gives one row with the
    error and no member. Its names are few beside its bytes, so the number of tasks is the
    session's and is not cut down to the size of the rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in frame.itertuples(index=False):
                try:
                    with _open(a.location) as z:
                        held = sorted((i.header_offset, i.filename, i.file_size) for i in z.infolist() if not i.is_dir())
                except (zipfile.BadZipFile, ArrowInvalid) as bad:
                    yield pd.DataFrame([(a.location, a.archive, None, None, None, None, str(bad))], columns=names, dtype=object)
                    continue
                found = pd.DataFrame(held, columns=["place", "member", "bytes"])
                before = found["bytes"].cumsum() - found["bytes"]
                found = found.assign(location=a.location, archive=a.archive, piece=before // piece_bytes, error=None)
                yield found[names].astype({"place": "int64", "bytes": "int64", "piece": "int32"})

    names = [c.split()[0] for c in CONTENTS.split(", ")]
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("location", "archive").repartition(tasks, "location").mapInPandas(run, CONTENTS)


def archive_members(archives: DataFrame) -> DataFrame:
    """(location, archive, member, error): the table of contents of every archive."""
    return archive_contents(archives).select("location", "archive", "member", "error")


def needed_in_archive(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Members that are wanted (column MaskPath)."""
    names = wanted.select(F.col("MaskPath").alias("member"))
    return members.filter(F.col("member").isNotNull()).join(names, "member", "left_semi")


def not_found(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted names that no archive holds."""
    return wanted.join(
        members.select(F.col("member").alias("MaskPath")), "MaskPath", "left_anti"
    )


def found_members(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Names that are both wanted and held."""
    return wanted.select("MaskPath").intersect(members.select(F.col("member").alias("MaskPath")))


def read_members(chosen: DataFrame, with_content: bool = True) -> DataFrame:
    """(archive, path, content, error) of chosen rows of ``archive_contents``, as a stream.

    Each piece of an archive is read by one task from front to back; there are as many tasks
    as pieces. A damaged member has an error instead of content. Without content members
    are read and checked, and nothing but errors leaves the tasks.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, place = None, None
        for frame in frames:
            held, size = [], 0
            for m in frame.itertuples(index=False):
                if m.location != place:
                    if opened:
                        opened.close()
                    opened, place = _open(m.location), m.location
                try:
                    content, error = opened.read(m.member), None
                except DAMAGE as bad:
                    content, error = None, str(bad)
                if not with_content:
                    content = None
                held.append((m.archive, m.member, content, error))
                size += len(content or b"")
                if size >= BATCH_BYTES:
                    yield pd.DataFrame(held, columns=READ, dtype=object)
                    held, size = [], 0
            if held:
                yield pd.DataFrame(held, columns=READ, dtype=object)
        if opened:
            opened.close()

    tasks = chosen.select("location", "piece").distinct().count()
    spread = chosen.select("location", "archive", "member", "place", "piece").repartition(max(1, tasks), "location", "piece")
    in_order = spread.sortWithinPartitions("location", "place")
    return in_order.mapInPandas(run, "archive string, path string, content binary, error string")


def extract_archive_members(
    archives: DataFrame, wanted: DataFrame, piece_bytes: int = PIECE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Content of the wanted members, and what could not be read: (archive, member, error).

    Only the tables of contents are written to the shared folder; content goes from the
    archives to whoever takes it. So an archive that holds most of the bytes is the work of as
    many tasks as it has pieces. Asking for what could not be read checks the members by a
    reading of its own; ``read_members`` gives content and errors from one. An archive
    without a readable table of contents has an error and no member.
    """
    members = cut_lineage(archive_contents(archives, piece_bytes), "members")
    chosen = needed_in_archive(members, wanted)
    content = read_members(chosen).filter(F.col("error").isNull()).select("archive", "path", "content")
    damaged = read_members(chosen, with_content=False).filter(F.col("error").isNotNull()).select(
        "archive", F.col("path").alias("member"), "error"
    )
    unread = members.filter(F.col("error").isNotNull()).select("archive", "member", "error")
    return content, unread.unionByName(damaged)
