"""Text helpers: blanks, display names, keys, path checks and cuts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.schemas import UNKNOWN_SOURCE

# fixed value: the characters a required text may not consist of alone
BLANK_CHARACTERS = "\t\n\r "


def has_text(column: Column) -> Column:
    """True when something other than tab, line feed, return or space is left."""
    return F.length(F.trim(column, F.lit(BLANK_CHARACTERS))) > 0


def source_name(column: Column) -> Column:
    """Trimmed source system, or the fixed name for a missing one."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(UNKNOWN_SOURCE))


def source_entity(schema: Column, name: Column) -> Column:
    """``schema.object``; the object alone where the schema is blank."""
    qualified = F.concat(schema, F.lit("."), F.coalesce(name, F.lit("")))
    return F.when(F.length(F.rtrim(schema)) > 0, qualified).otherwise(name)


def match_key(column: Column) -> Column:
    """Key under which two names count as equal: no case, no trailing blanks."""
    return F.lower(F.rtrim(column))


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the last ``width`` digits of the zero-padded number."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.right(F.concat(F.lit("0" * width), digits), F.lit(width))
    )


def fixed_payload(prefix: str, number: Column, digits: int, width: int) -> Column:
    """A text of exactly ``width`` characters: prefix, padded number, filler."""
    head = F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"), F.lit("-"))
    return F.rpad(head, width, "X")


def bucket_label(number: Column, labels: list[str]) -> Column:
    """Label picked by the number modulo the number of labels."""
    return F.get(F.array(*[F.lit(label) for label in labels]), F.pmod(number, F.lit(len(labels))))


# fixed values: longest texts an audit row keeps
MESSAGE_LIMIT = 4000
PAIRED_MESSAGE_LIMIT = 1500
CLEANUP_MESSAGE_LIMIT = 3000
DUPLICATE_LIST_LIMIT = 1800
DUPLICATE_LIST_MARK = " ..."


def audit_message(message: Column) -> Column:
    return F.left(message, F.lit(MESSAGE_LIMIT))


def paired_message(first_label: str, first: Column, second_label: str, second: Column) -> Column:
    """Two labelled messages, each cut so that neither hides the other."""
    cut = F.lit(PAIRED_MESSAGE_LIMIT)
    return F.concat(
        F.lit(f"{first_label}: "),
        F.left(F.coalesce(first, F.lit("")), cut),
        F.lit(f" | {second_label}: "),
        F.left(F.coalesce(second, F.lit("")), cut),
    )


def duplicate_list(text: Column) -> Column:
    """A list of duplicates, marked where it had to be cut."""
    cut = F.concat(F.left(text, F.lit(DUPLICATE_LIST_LIMIT)), F.lit(DUPLICATE_LIST_MARK))
    return F.when(F.length(text) > DUPLICATE_LIST_LIMIT, cut).otherwise(text)


def path_segments(path: Column) -> Column:
    """Non-empty parts of a slash-separated path."""
    return F.filter(F.split(path, "/"), lambda part: part != "")


def as_folder(path: Column) -> Column:
    """The path with exactly the trailing slash it needs to be a prefix."""
    return F.when(F.endswith(path, F.lit("/")), path).otherwise(F.concat(path, F.lit("/")))


# a folder name holds no slash, and something besides dots and blanks
FOLDER_NAME = r"[^/\\]*[^/\\.\s][^/\\]*"


def is_folder_name(name: Column) -> Column:
    """A name that cannot leave its parent folder."""
    return F.coalesce(F.rlike(name, F.lit(f"^{FOLDER_NAME}$")), F.lit(False))
