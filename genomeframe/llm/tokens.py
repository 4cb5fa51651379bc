"""Sizes of texts in tokens of a public tokenizer (vocabulary files stay outside the repository)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = os.environ.get("GENOMEFRAME_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(path: str):
    """One encoder per Python worker. ``path`` is a vocabulary of byte strings and ranks, one pair a line."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = DEFAULT_VOCABULARY) -> int:
    """Tokens of the whole text. Lone surrogates, which cannot be encoded, count as the replacement character."""
    return len(_encoding(path).encode_ordinary(text.encode("utf-8", "replace").decode("utf-8"))) if text else 0


def with_token_count(df: DataFrame, text_col: str, columns: dict[str, str], path: str = DEFAULT_VOCABULARY, name: str = "n_tokens") -> DataFrame:
    """The given columns (new name to old name) and the token count of each row's text; null and empty texts have 0."""
    # values travel as text: pandas would round large numbers beside nulls
    slim = df.select(*(df[old].cast("string").alias(new) for new, old in columns.items()), df[text_col].cast("string").alias("__text"))
    kept = list(columns)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[kept].assign(**{name: [count_tokens(t, path) for t in pdf["__text"]]})

    out = slim.mapInPandas(count, ", ".join(f"`{c}` string" for c in kept) + f", {name} long")
    return out.select(*(F.col(new).cast(df.schema[old].dataType).alias(new) for new, old in columns.items()), name)
