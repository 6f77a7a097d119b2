"""Small helpers the corpus operators share: tables, staging in the shared folder, sizes."""

import numpy as np
import pyarrow as pa

from candlemill.session import scratch_path

#: Bytes of text hashed at once inside a task; longer texts are hashed piece by piece.
PIECE_BYTES = 1 << 21


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df, name):
    """``df`` written once to the folder in ``spark.checkpoint.dir`` and read from there.

    Used where several later steps read the same rows; the lineage ends at the files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches, column, limit=PIECE_BYTES):
    """Runs of whole rows holding at most ``limit`` bytes of text, or one longer row.

    Yields ``(record batch, binary array of its texts)``; NULL texts count as empty.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        texts = texts.fill_null(b"")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop
