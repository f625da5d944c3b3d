"""Rows of delimited text as Arrow blocks of strings (SRC-07, SRC-08, SRC-10)."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.csv

from railweave.functions.text import clean_header

#: Spellings of a missing value in CSV cells.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
BLOCK = 8 << 20


def names_of(line: bytes, sep: str = ",") -> list[str]:
    """SRC-10: the cleaned names in a file's first line."""
    return [clean_header(n) for n in next(csv.reader([line.decode("utf-8-sig").rstrip("\r\n")], delimiter=sep), [])]


def blocks(f, names: Sequence[str], sep: str, wanted: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The wanted columns of a file's rows, whose header has been read, in blocks."""
    if not f.peek(1) if hasattr(f, "peek") else not f.getbuffer().nbytes:
        return
    yield from pyarrow.csv.open_csv(
        f, read_options=pyarrow.csv.ReadOptions(column_names=list(names), block_size=BLOCK), parse_options=pyarrow.csv.ParseOptions(delimiter=sep, newlines_in_values=True),
        convert_options=pyarrow.csv.ConvertOptions(column_types={n: pa.string() for n in names}, null_values=MISSING, strings_can_be_null=True, include_columns=list(wanted)),
    )
