"""Token counts by a compiled finite-state transducer.

transducer.py compiles the tokenizer to a deterministic transducer over bytes,
whose transitions emit token counts. A text is cut into chunks of bytes without
regard to words or characters. Each chunk becomes a map of states (where it
ends, and how many tokens it emits, for the state it is entered in); all chunks
of many texts are evaluated side by side, and the maps of a text are composed
pairwise in a logarithmic number of rounds, as a parallel prefix scan does.

Spark spreads the rows; one pass, no shuffle. A tokenizer of another kind than
the transducer's (word ends, merges, and the pre-tokenizer of segments.py) is
asked for each text in whole.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; repeated
rows give repeated results; an empty table gives an empty table; a text of any
length is counted in whole; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.segments import default_tokenizer
from weftline.llm.shingles import in_steps
from weftline.llm.transducer import CHUNK, transducer

#: The count above which a text is over the limit.
LIMIT = 2048


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[doc_id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_tokens = [n for a, b in in_steps(texts) for n in machine.counts(texts[a:b], chunk).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
