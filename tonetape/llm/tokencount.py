"""Token counts of whole texts, by rank-synchronous merging on ragged arrays (see bpe)."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from tonetape.llm.bpe import encoder
from tonetape.llm.common import slices

#: Bytes of text that are encoded together.
SLICE = 4 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per row of docs: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer is the path of a word-level BPE file, there on every executor.  No
    begin, end or padding tokens are added; special strings inside a text count
    as the library counts them, one each.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated
    rows are counted one by one; an empty table gives an empty one.  Columns other
    than the id and the text are not read, whatever their names.
    """
    kept = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = kept.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches):
        model = encoder(tokenizer)
        for part in slices(batches, "text", SLICE):
            texts = part.column("text")
            n = model.counts(texts.to_pylist())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), size, pa.array(n, pa.int64()), pa.array(n > limit)], names=schema.names
            )

    out = kept.mapInArrow(count, schema)
    return out.withColumnRenamed("id", id_col)
