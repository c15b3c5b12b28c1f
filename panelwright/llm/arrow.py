"""Arrow batches of ``(id, text)`` turned into other columns inside tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Called once per task; gives a function from the texts of a batch (null: "") to the new columns.
Maker = Callable[[], Callable[[list[str]], list]]


#: Texts are handed over in runs of about this many characters, so that what is made of them stays small.
AT_ONCE = 1_000_000


def runs_of(sizes: Iterable[int], most: int = AT_ONCE) -> Iterator[slice]:
    """Slices of consecutive texts, given by their lengths, with at most ``most`` characters, or one longer text."""
    begin = total = end = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
        end = i + 1
    if begin < end:
        yield slice(begin, end)


def give_back() -> None:
    """Hand memory that this worker process has kept from earlier tasks back to the system, and keep less from now on."""
    pa.default_memory_pool().release_unused()
    pa.set_memory_pool(pa.system_memory_pool())
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(
    df: DataFrame, id_cols: list[str], text_col: str, new: str, make: Maker, at_once: int = AT_ONCE,
) -> DataFrame:
    """``id_cols`` of every row beside the columns ``new`` (a DDL string) computed from its whole text.

    ``make`` runs once per task, so what it sets up serves all batches of the task and no other.
    """
    schema = T.StructType([*[df.schema[c] for c in id_cols], *T.StructType.fromDDL(new).fields])
    names = schema.names
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[len(id_cols):]]
    k = len(id_cols)
    # a text that is kept is sent once
    place = id_cols.index(text_col) if text_col in id_cols and df.schema[text_col].dataType == T.StringType() else k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            # only the texts of a run become Python's
            for part in runs_of(pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_pylist(), at_once):
                old = batch.slice(part.start, part.stop - part.start)
                out = work([t or "" for t in old.column(place).to_pylist()])
                columns = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays([*old.columns[:k], *columns], names=names)

    hidden = f"_text_{uuid.uuid4().hex}"
    text = F.col(f"`{text_col}`").cast("string").alias(hidden)
    sent = [] if place < k else [text]
    return df.select(*[F.col(f"`{c}`") for c in id_cols], *sent).mapInArrow(run, schema)
