"""Text sizes in tokens of a public tokenizer; the vocabulary file stays where it is."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The word pattern this vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(4)
def encoding(vocabulary: str = DEFAULT_VOCABULARY):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, vocabulary: str = DEFAULT_VOCABULARY) -> Column:
    """Number of tokens of a text column; 0 for null and empty texts.  ``vocabulary`` must exist on every executor."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(vocabulary).encode_ordinary
        for texts in batches:
            yield texts.map(lambda t: len(encode(t)) if t else 0).astype("int64")

    return F.pandas_udf(count, "bigint")(F.col(text))
