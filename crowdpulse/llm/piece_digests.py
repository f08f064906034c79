"""Token ids of documents by a sentencepiece model, as digests."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from crowdpulse.llm.frames import picked
from crowdpulse.llm.pieces import piece_codec

_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(documents: DataFrame, model: str) -> DataFrame:
    """Per row the number of ids of its whole text, and digests of the ids and of the decoded text.

    ids_sha256 is of the decimal ids joined by commas. A null text is empty;
    an empty one has no ids. Rows are read one by one, so repeated rows repeat
    their result. Only doc_id and text take part.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column("text"))
            rows = [
                (n, sha256(ids.encode()).hexdigest(), sha256(text.encode()).hexdigest())
                for n, ids, text in codec.digests(texts)
            ]
            counts, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return picked(documents, doc_id="long", text="string").mapInArrow(encode, _SCHEMA)
