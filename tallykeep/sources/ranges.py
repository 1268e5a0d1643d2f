"""First and last records of text files, from short ranges at both ends instead of whole files.

Control cells and column names stand in the first and last line of an object. Tasks open the files of a listing themselves
and read a range at the start and one at the end, which grow until they hold a whole record, so a file of any size
costs about 128 KB. Where the file system is one that only Spark can open, callers scan the lines instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of a first range; a range that holds no whole record is read again four times as long, up to the most.
RANGE = 1 << 16
MOST = 1 << 26

EDGES = "file string, first_line string, last_line string"


def first_record(data: bytes, whole: bool, quoted: bool) -> bytes | None:
    """The first record in the beginning of a file, None if that is too short. ``whole``: it is all of the file.

    Empty lines before it are passed over. With ``quoted``, a record ends at a line end that an even number of quotes stands
    before. A file whose quotes never pair up has its first line as the first record.
    """
    lines = data.split(b"\n")
    if not whole:
        lines.pop()
    lines = [x.rstrip(b"\r") for x in lines]
    start = next((i for i, x in enumerate(lines) if x), None)
    if start is None:
        return b"" if whole else None
    odd = 0
    for end in range(start, len(lines) if quoted else start + 1):
        odd ^= lines[end].count(b'"') & 1 if quoted else 0
        if not odd:
            return b"\n".join(lines[start:end + 1])
    return lines[start] if whole else None


def last_record(data: bytes, whole: bool, quoted: bool) -> bytes | None:
    """The last record in the end of a file, None if that is too short. ``whole``: it is all of the file.

    A last line with an odd number of quotes closes a cell that the line with the next odd number before it has opened.
    """
    lines = data.split(b"\n")
    if not whole:
        lines = lines[1:]
    lines = [x.rstrip(b"\r") for x in lines]
    end = next((i for i in range(len(lines) - 1, -1, -1) if lines[i]), None)
    if end is None:
        return b"" if whole else None
    if not quoted or lines[end].count(b'"') % 2 == 0:
        return lines[end]
    start = next((i for i in range(end - 1, -1, -1) if lines[i].count(b'"') % 2), None)
    if start is not None:
        return b"\n".join(lines[start:end + 1])
    return lines[end] if whole else None


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path


def can_be_opened(path: str) -> bool:
    """Whether tasks can open a file of this file system themselves: it is one that pyarrow knows and can reach."""
    from pyarrow import fs

    try:
        system, inside = fs.FileSystem.from_uri(_uri(path).replace("%", "%25").replace(" ", "%20"))
        return system.get_file_info(inside).type != fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def ends_of_files(files: DataFrame, quoted: bool) -> DataFrame:
    """``(file, first_line, last_line)`` from ``(file, length)``; files without a line that isn't empty are left out."""
    first, last, uri, begin, most = first_record, last_record, _uri, RANGE, MOST

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def grown(file, length: int, record, at_end: bool) -> bytes:
            size = begin
            while True:
                size = min(size, length)
                data = file.read_at(size, length - size if at_end else 0)
                # Beyond the most, what is there is taken as all there is.
                found = record(data, size == length or size >= most, quoted)
                if found is not None:
                    return found
                size *= 4

        for frame in frames:
            out = []
            for path, length in zip(frame.file, frame.length):
                system, inside = fs.FileSystem.from_uri(uri(path).replace("%", "%25").replace(" ", "%20"))
                with system.open_input_file(inside) as file:
                    ends = [grown(file, int(length), r, e).decode("utf-8", "replace") for r, e in ((first, False), (last, True))]
                if ends[0]:
                    out.append((path, *ends))
            if out:
                yield pd.DataFrame(out, columns=["file", "first_line", "last_line"])

    return files.select("file", "length").mapInPandas(work, EDGES)


def file_ends(spark: SparkSession, roots: list[str], quoted: bool) -> DataFrame | None:
    """``ends_of_files`` of all files below the roots, or None where tasks can't open them. Names that begin with an underscore
    or a dot are no files of an object."""
    if not all(can_be_opened(root) for root in roots):
        return None
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    return ends_of_files(listed.select(F.replace("path", F.lit(":///"), F.lit(":/")).alias("file"), "length"), quoted)
