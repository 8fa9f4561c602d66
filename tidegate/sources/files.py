"""File discovery by name pattern and last-modified window."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.temporal import bound_instant

LISTED = "place string, is_folder boolean, modified_ms long, length long"
FOUND = "path string, modified_time timestamp_ntz, length long"


def name_rule(pattern: str) -> str:
    """The regular expression of a file-name pattern: ``*``, ``?``, ``[...]`` and ``{a,b}``."""
    out, depth, rest = [], 0, iter(re.findall(r"\\.|\[!?\^?\]?[^\]]*\]|.", pattern, re.S))
    for part in rest:
        if len(part) > 1 and part[0] == "[":
            inner = part[1:-1]
            negated = inner[:1] in ("!", "^")
            chars = re.sub(r"([\[\]\\^&])", r"\\\1", inner[negated:])
            out.append(f"[{'^' if negated else ''}{chars}]")
        elif part in ("*", "?"):
            out.append("[^/]*" if part == "*" else "[^/]")
        elif part == "{":
            depth += 1
            out.append("(?:")
        elif part == "}" and depth:
            depth -= 1
            out.append(")")
        elif part == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(part[-1]))
    return "".join(out) + ")" * depth


def store_uri(root: str) -> str:
    """A qualified Hadoop path as Arrow's file systems take it."""
    scheme, _, rest = root.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    rest = rest if rest.startswith("//") else "//" + rest
    return f"{scheme}:{quote(rest)}"


def list_folders(folders: DataFrame, root: str, hidden: bool) -> DataFrame:
    """What lies directly in each folder (``place`` below the root), listed by tasks."""
    uri = store_uri(root)

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        base = base.rstrip("/")
        for batch in batches:
            for place in batch["place"]:
                inside = store.get_file_info(fs.FileSelector(f"{base}/{place}".rstrip("/") or "/"))
                rows = [
                    (f"{place}/{info.base_name}".lstrip("/"), info.type == fs.FileType.Directory,
                     (info.mtime_ns or 0) // 1_000_000, info.size or 0)
                    for info in inside
                    if hidden or info.base_name[0] not in "._"
                ]
                for start in range(0, len(rows), 10_000):
                    names = ["place", "is_folder", "modified_ms", "length"]
                    yield pd.DataFrame(rows[start : start + 10_000], columns=names)

    return folders.mapInPandas(listing, LISTED)


def discover(
    spark: SparkSession, root: str, pattern: str = "*", hidden: bool | None = None
) -> DataFrame:
    """One row per matching file at any depth: path, modified time, length.

    The tree is walked level by level: each round, tasks list the folders the round before
    found, so a wide tree is listed in parallel and the driver holds no file names. Empty
    files are listed. Hidden files (names starting with ``_`` or ``.``) and folders are taken
    if the pattern itself starts so, or by ``hidden``. File contents are not read. A root
    that is a file is that one file.
    """
    pattern = (pattern or "").strip() or "*"
    hidden = pattern[0] in "._" if hidden is None else hidden
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    status = files.getFileStatus(path)  # raises FileNotFoundException where nothing is there
    full = status.getPath().toString().rstrip("/")
    if status.isFile():
        one = (full, status.getModificationTime(), status.getLen())
        found = spark.createDataFrame([one], "path string, modified_ms long, length long")
        named = found
    else:
        level, found, width = spark.createDataFrame([("",)], "place string"), None, 1
        while width:
            tasks = min(width, 4 * spark.sparkContext.defaultParallelism)
            listed = list_folders(level.repartition(tasks), full, hidden).checkpoint()
            seen = listed.where("NOT is_folder").select("place", "modified_ms", "length")
            found = seen if found is None else found.unionByName(seen)
            level = listed.where("is_folder").select("place")
            width = level.count()
        named = found.withColumn("path", F.concat(F.lit(full + "/"), "place"))
    name = F.substring_index("path", "/", -1)
    return named.where(F.rlike(name, F.lit(f"^(?s:{name_rule(pattern)})$"))).select(
        "path", F.timestamp_millis("modified_ms").cast("timestamp_ntz").alias("modified_time"), "length"
    )


def modified_window(files: DataFrame, low: str, high: str) -> DataFrame:
    """Files with LOW <= modified time < HIGH (UTC)."""
    stamp = F.col("modified_time")
    return files.where((stamp >= bound_instant(low)) & (stamp < bound_instant(high)))


def rows_in_modified_window(df: DataFrame, low: str, high: str) -> DataFrame:
    """Rows of a file source whose file lies in the window [LOW, HIGH).

    The file's own time is compared, which lets Spark skip whole files.  The
    reader option ``modifiedAfter`` is not used: it would drop a file exactly at LOW.
    """
    stamp = F.col("_metadata.file_modification_time")
    return df.where(
        (stamp >= bound_instant(low).cast("timestamp"))
        & (stamp < bound_instant(high).cast("timestamp"))
    )


def relative_to(path: Column, root: str) -> Column:
    """Path below the root, without scheme or leading slash.

    Exactly the root is cut off, by length, wherever its name occurs again below it. A path
    that is not below the root keeps its full name.
    """
    place = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    plain_root = re.sub(place, "", root).rstrip("/") + "/"
    plain = F.regexp_replace(path, place, "")
    below = F.substring(plain, len(plain_root) + 1, F.length(plain))
    return F.when(plain.startswith(plain_root), below).otherwise(plain)
