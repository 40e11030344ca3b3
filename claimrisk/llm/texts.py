"""Small helpers for columns of texts inside Arrow batches."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts are handed to the kernels in slices of about this many bytes, so that the memory of a task does
# not follow the number of rows in an Arrow batch. A longer text makes a slice of its own.
SLICE_BYTES = 500_000


def quoted(name: str) -> Column:
    """The column of that very name, also where the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_slices(batch, column="text", slice_bytes=SLICE_BYTES):
    """Yield (first row, list of bytes or None): the UTF-8 texts of an Arrow batch in bounded slices.

    Only one slice at a time is held as Python objects.
    """
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    first, total = 0, 0
    for row, size in enumerate(sizes):
        if row > first and total + size > slice_bytes:
            yield first, values.slice(first, row - first).to_pylist()
            first, total = row, 0
        total += size
    if len(sizes) > first:
        yield first, values.slice(first).to_pylist()


def map_texts(df: DataFrame, kernel, schema: str, keep=("doc_id",), text="text", slice_bytes=SLICE_BYTES):
    """Apply ``kernel`` to the texts of ``df`` in each task, one result row per row.

    ``kernel()`` is called once per task and returns a function from a list of texts (bytes or None)
    to a dictionary of equally long columns. ``keep`` names the columns that go with the texts, no
    others are sent to Python. ``schema`` lists the new columns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    kept = StructType([df.schema[c] for c in keep])
    out = StructType([*kept.fields, *added.fields])
    arrow = to_arrow_schema(added)
    # Python gets the columns by place: it can't name those with dots or backticks.
    sent = list(dict.fromkeys([*keep, text]))
    places, of_text = [sent.index(c) for c in keep], f"c{sent.index(text)}"

    def run(batches):
        work = kernel()
        for batch in batches:
            for first, texts in text_slices(batch, of_text, slice_bytes):
                made = work(texts)
                part = batch.slice(first, len(texts))
                columns = [part.column(i) for i in places]
                columns += [pa.array(made[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, names=out.fieldNames())

    return df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(sent)]).mapInArrow(run, out)
