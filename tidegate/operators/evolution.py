"""Columns of an appended table, kept beside it.

Each distinct row type ever appended is one small file in a hidden folder of the
table, named by its content, so concurrent appends cannot overwrite each other.
Readers merge the few files there are instead of every data file's footer, and
an append that would contradict them is refused before it writes.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from tidegate.errors import INCOMPATIBLE_SCHEMA, LoadError

FOLDER = "_row_types"


def _location(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def merged(types: list[StructType]) -> StructType:
    """All columns in order of first appearance; one name has one type.

    Names differing in case are one column, and types are compared without regard
    to missing values, which lake files always allow.
    """
    fields: dict[str, StructField] = {}
    for row_type in types:
        for field in row_type.fields:
            known = fields.setdefault(field.name.lower(), field)
            if known.dataType.simpleString() != field.dataType.simpleString():
                raise LoadError(
                    INCOMPATIBLE_SCHEMA,
                    f"column {field.name} is {known.dataType.simpleString()},"
                    f" not {field.dataType.simpleString()}",
                )
    return StructType(list(fields.values()))


def declared_types(spark: SparkSession, table: str) -> list[StructType]:
    """Row types appended so far, oldest first; none for a table written by other means."""
    files, pattern = _location(spark, f"{table}/{FOLDER}/*.json")
    found = []
    listed = list(files.globStatus(pattern) or [])
    listed.sort(key=lambda status: (status.getModificationTime(), status.getPath().getName()))
    for status in listed:
        stream = files.open(status.getPath())
        try:
            reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
            text = spark._jvm.java.io.BufferedReader(reader).readLine()
        finally:
            stream.close()
        if text:  # an empty file is one that is being written
            found.append(StructType.fromJson(json.loads(text)))
    return found


def check_type(spark: SparkSession, table: str, schema: StructType) -> tuple[StructType, list[StructType]]:
    """The row type and those declared so far; LoadError where they contradict each other."""
    plain = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    known = declared_types(spark, table)
    merged([*known, plain])
    return plain, known


def declare_type(spark: SparkSession, table: str, schema: StructType) -> None:
    """Check the row type against the table's columns and record it if it is new.

    Called after the rows were written: of two first appends with types that contradict
    each other, the later one fails here and its rows are cleaned up.
    """
    plain, known = check_type(spark, table, schema)
    if any(plain.simpleString() == one.simpleString() for one in known):
        return
    text = plain.json()
    name = hashlib.sha256(text.encode()).hexdigest()
    files, target = _location(spark, f"{table}/{FOLDER}/{name}.json")
    stream = files.create(target, True)
    try:
        stream.writeBytes(text)  # the JSON form is plain ASCII on one line
    finally:
        stream.close()
