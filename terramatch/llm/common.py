"""What the operators of this subpackage share: durable tables and the treatment of white space."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import durable, new_path

__all__ = ["WHITE", "WHITE_CHARS", "WORD", "WorkerTable", "durable", "new_path", "row_key", "text_of", "word_count"]

#: Characters that separate words: space, and tab to carriage return.
WHITE = "\\x20\\x09-\\x0D"
WORD = f"[^{WHITE}]+"
#: The same characters, for use outside regular expressions.
WHITE_CHARS = " \t\n\x0b\x0c\r"


def text_of(name: str) -> Column:
    """A text column; null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text without building them: a word is its first character, after the start or white space."""
    return F.regexp_count(text, F.lit(f"(?<![^{WHITE}])[^{WHITE}]")).cast("long")


def row_key(*columns: Column) -> Column:
    """128 bits that stand for a row's values; nulls differ from all values."""
    parts = [x for c in columns for x in (c, c.isNull())]
    return F.struct(F.xxhash64(F.lit(17), *parts).alias("a"), F.xxhash64(F.lit(71), *parts).alias("b"))


class WorkerTable:
    """A table that a worker process keeps from task to task. A process has one at a time: Spark uses its workers again for other
    stages, so the first use of one table drops the one before."""

    held: WorkerTable | None = None

    def __init__(self, make: Callable[[], Any]) -> None:
        self.make, self.table = make, None

    def get(self) -> Any:
        if WorkerTable.held is not self:
            if WorkerTable.held is not None:
                WorkerTable.held.table = None
                release_memory()
            WorkerTable.held, self.table = self, self.make()
        return self.table

    def __reduce__(self) -> tuple:
        return WorkerTable, (self.make,)


def release_memory() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass
