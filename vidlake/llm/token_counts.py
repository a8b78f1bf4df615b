"""Token counts of every prefix, by dynamic programming over the text.

`prefix_tokens` stores, for each text, the exact count of byte-level BPE tokens of
every prefix (by code points), one signed byte per character; see
`tokens.PrefixCounts` for the recurrence. Questions about truncation and budgets are
then answered without encoding again: `tokens_in` and `fitting`.

Cases: null and empty texts have no token. Rows that repeat each get a row, null ids
too. Strings of special tokens count one, as the library's default is. Other columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vidlake.llm.common import map_texts, text_of
from vidlake.llm.tokens import prefix_counts

LIMIT = 1024


def prefix_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens, steps of every row."""

    def count(batch: pa.RecordBatch) -> dict:
        counter = prefix_counts(path)
        texts = [text_of(t) for t in batch.column("text").to_pylist()]
        steps = [counter.steps(t) for t in texts]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array([int(s.sum(dtype=np.int64)) for s in steps], pa.int64()),
            "steps": pa.array([s.tobytes() for s in steps], pa.binary()),
        }

    return map_texts(
        docs.select("doc_id", "text"), count, "doc_id long, n_bytes long, n_chars long, n_tokens long, steps binary"
    )


def tokens_in(steps: Column, n_chars: Column) -> Column:
    """Tokens of the first n_chars characters."""

    @pandas_udf("long")
    def read(stored: pd.Series, chars: pd.Series) -> pd.Series:
        return pd.Series(
            [int(np.frombuffer(s, np.int8)[: max(0, int(c))].sum(dtype=np.int64)) for s, c in zip(stored, chars)]
        )

    return read(steps, n_chars)


def fitting(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most so many tokens."""

    @pandas_udf("long")
    def read(stored: pd.Series, tokens: pd.Series) -> pd.Series:
        out = []
        for s, budget_ in zip(stored, tokens):
            fits = np.flatnonzero(np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64) <= budget_)
            out.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(out, dtype="int64")

    return read(steps, budget)


def counts(docs: DataFrame, path: str, *, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    found = prefix_tokens(docs, path)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
