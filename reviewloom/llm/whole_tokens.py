"""Exact token counts with a shortcut for pre-tokens that are whole vocabulary entries."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
# lengths of merged pre-tokens that a task remembers before it starts afresh
REMEMBERED = 300_000
ROWS_AT_ONCE = 256


def _loaded(definition: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(definition: str, pattern: str = public_tokenizers.PATTERN) -> list[str]:
    """Vocabulary strings proven to encode alone as exactly one token.

    Each entry is turned back into text and encoded by the library; it counts when the result is that one id and the
    text is a single pre-token. Merges never cross pre-tokens, so wherever such a pre-token stands it is one token.
    """
    tokenizer, split = _loaded(definition), regex.compile(pattern)
    special = {i for i, t in tokenizer.get_added_tokens_decoder().items()}
    ids = [i for i in tokenizer.get_vocab().values() if i not in special]
    texts = tokenizer.decode_batch([[i] for i in ids])
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return sorted(t for i, t, e in zip(ids, texts, encoded) if e.ids == [i] and split.findall(t) == [t])


class TokenCounter:
    """Counts tokens of texts; only pre-tokens outside the proven table are merged."""

    def __init__(self, definition: str, whole: list[str], pattern: str = public_tokenizers.PATTERN):
        self.tokenizer = _loaded(definition)
        self.split = regex.compile(pattern)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.whole = dict.fromkeys(whole, 1)
        self.table = dict(self.whole)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of the text, and how many special strings stand between them."""
        if self.special is None or not self.special.search(text):
            return self.split.findall(text), 0
        parts = self.special.split(text)
        return [t for part in parts for t in self.split.findall(part)], len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.table) > len(self.whole) + REMEMBERED:
            self.table = dict(self.whole)
        found = [self.pre_tokens(text) for text in texts]
        rest = list(set().union(*[tokens for tokens, _ in found]).difference(self.table)) if found else []
        merged = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.table.update(zip(rest, map(len, merged)))
        size = self.table.__getitem__
        return [sum(map(size, tokens)) + specials for tokens, specials in found]


def token_counts(
    documents: DataFrame, tokenizer: str = TOKENIZER, pattern: str = public_tokenizers.PATTERN, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text, as the tokenizer's own library counts it.

    ``tokenizer`` names a byte-level pair-merging definition whose pre-tokens are the matches of ``pattern``. The
    definition and the proven table are broadcast: both are bounded by the vocabulary. Null and empty texts have no
    tokens; repeated rows are counted each; an empty table gives no rows; other columns are not read. No shuffle.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    shared = documents.sparkSession.sparkContext.broadcast((definition, whole_tokens(definition, pattern)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*shared.value, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                texts = [t or "" for t in part["text"].to_pylist()]
                n = pa.array(counter.counts(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], n], ["doc_id", "n_bytes", "n_tokens"])

    rows = documents.select("doc_id", "text", F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).cast("long").alias("n_bytes"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)


@query("op10_whole_token_counts")
def _op10(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
