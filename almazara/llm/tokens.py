"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almazara.runtime import materialize

#: Ranks of the byte-level vocabulary; a path that the driver can read, the file goes to the executors with the job.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the vocabulary's pattern of pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a ranks file, made once in each worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def token_sizes(documents: DataFrame, *, path: str = TOKENIZER) -> DataFrame:
    """(item_id, doc_id, source, tokens) of every document row whose text has a token.

    Whole texts are encoded, once, and the sizes kept in the shared folder.
    ``item_id`` numbers the rows, so repeated rows stay apart. Null and empty
    texts have no tokens and give no row.
    """

    documents.sparkSession.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]

    def run(frames):
        encode = encoder(SparkFiles.get(name)).encode_ordinary
        for frame in frames:
            sizes = [len(encode(t)) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "source": frame["source"], "tokens": sizes})

    texts = documents.where(F.col("text").isNotNull() & (F.col("text") != "")).select("doc_id", "source", "text")
    sizes = texts.mapInPandas(run, "doc_id long, source string, tokens long")
    return materialize(sizes.select(F.monotonically_increasing_id().alias("item_id"), "doc_id", "source", "tokens"), "tokens")
