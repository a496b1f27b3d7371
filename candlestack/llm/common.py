"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.session import materialize, scratch_path

__all__ = ["WORD", "materialize", "scratch_path", "on_workers", "on_workers_grouped",
           "slices", "text_key", "no_null_text",
           "word_count"]

#: A word: a run of anything but space, tab, line feed, vertical tab, form
#: feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def give_back() -> None:
    """Return freed memory to the system: workers wait for their next task
    beside the executor, and neither allocator does that by itself."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # not glibc
        return
    trim(0)


def forget_others(module: str) -> None:
    """Drop what other modules of this package keep for their next task
    (vocabularies, memos): this worker now serves another step."""
    package = __name__.rpartition(".")[0]
    for name, other in list(sys.modules.items()):
        if name.startswith(f"{package}.") and name != f"{package}.{module}":
            getattr(other, "forget", lambda: None)()


def _then_give_back(out: Iterator) -> Iterator:
    try:
        yield from out
    finally:
        give_back()


def on_workers(module: str, name: str, *args, **kwargs) -> Callable:
    """A function for ``mapInArrow`` and the like that calls ``name`` of
    ``candlestack.llm.<module>`` with its first argument(s) from Spark, then
    ``args``.  The worker imports the module once, so what the module keeps
    (compiled patterns, vocabularies, memos) serves all tasks of the worker, until
    it serves another module; freed memory goes back after each task.
    Executors without the package on their path add the driver's folder,
    which covers local sessions started from anywhere."""
    root = _ROOT

    def call(*given):
        import importlib
        import sys
        from types import GeneratorType

        if root not in sys.path:
            sys.path.append(root)
        fn = getattr(importlib.import_module(f"candlestack.llm.{module}"), name)
        common = importlib.import_module("candlestack.llm.common")
        common.forget_others(module)
        out = fn(*given, *args, **kwargs)
        return common._then_give_back(out) if isinstance(out, GeneratorType) else out

    return call


def on_workers_grouped(module: str, name: str, *args) -> Callable:
    """``on_workers`` for ``applyInArrow``, which wants one named argument."""
    fn = on_workers(module, name, *args)

    def call(table):
        return fn(table)

    return call


def slices(batches: Iterator, rows: int = 1_000) -> Iterator:
    """Arrow batches in pieces of at most ``rows`` rows, so that the Python
    objects of a whole batch never exist at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def no_null_text(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_key(col: Column) -> Column:
    """128-bit key of a text: 32 hex digits."""
    return F.md5(col.cast("binary"))


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")
