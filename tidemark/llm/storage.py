"""Files and tables in the folder that the driver and all executors share.

Tasks may run more than once, so a task writes its file under a name of its own
attempt and reports that name as a row; only rows of the attempts that Spark
committed reach a saved table, and readers follow those rows alone.
"""

from __future__ import annotations

import io
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_folder


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table of the shared folder and read again: its lineage ends there."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def filesystem(uri: str):
    """The file system and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def attempt_file(folder: str, stem: str, suffix: str) -> str:
    """A name that no other attempt uses."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """A binary output stream; its folder is made first."""
    store, path = filesystem(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path)


def open_stream(uri: str, buffer: int = 1 << 20) -> io.BufferedReader:
    """A buffered binary input stream from the start of the file."""
    store, path = filesystem(uri)
    return io.BufferedReader(store.open_input_stream(path), buffer)


def open_random(uri: str):
    """A binary input file that can seek."""
    store, path = filesystem(uri)
    return store.open_input_file(path)


def text_column(df: DataFrame, name: str):
    """A text column with null as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))
