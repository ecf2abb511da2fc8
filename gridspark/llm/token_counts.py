"""Operator 5: token counts by a two-tier lookup on the map side.

Tier one is a table of frequent pre-token lengths, broadcast.  A byte-pair vocabulary lists the strings that were
frequent where it was trained, so the table holds each of its entries that is a word with its leading space; it is
bounded by the vocabulary.  Tier two is a cache of each worker; what both miss is encoded there by the library's model.
Nothing is shuffled.

A text is cut before each single space between two characters that are no white space.  The pre-tokenizer never joins
what such a cut separates: the space opens the next pre-token.  The counts of the parts hence add up to the text's.

Defined results: a null text counts as empty (0 tokens); repeated rows and ids are counted row by row; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import CACHE_ENTRIES, map_batches, resident, trimmed
from .pretokens import PreTokens

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Between characters that are no white space; texts without two such characters side by side need no look around.
_CUT, _TWO = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s\s")


def frequent_lengths(path: str) -> dict[str, int]:
    """Tier one: pre-token -> its number of tokens, for the vocabulary's words after a space."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    words = [w for w in (t.decode([i]) for i in range(t.get_vocab_size())) if re.fullmatch(r" [A-Za-z]+", w)]
    return {w: len(e.ids) for w, e in zip(words, t.encode_batch(words, add_special_tokens=False), strict=True)}


class Counter:
    """Counts tokens; one for each worker."""

    def __init__(self, path: str, frequent: dict[str, int], entries: int = CACHE_ENTRIES):
        import public_tokenizers

        self.frequent, self.entries = frequent, entries
        self.tokens = PreTokens(path, public_tokenizers.PATTERN, False, entries)
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def length(self, part: str) -> int:
        """Tokens of a part: looked up in the broadcast table, then in the worker's cache, else encoded."""
        return self.frequent.get(part) or sum(self.tokens.all(part))

    def count(self, texts: list[str]) -> list[int]:
        split = [_CUT.split(t) if _TWO.search(t) or t[:1] == " " or t[-1:] == " " else t.split(" ") for t in texts]
        first, later, length = self.first, self.later, self.length
        for p in (opening := [w for w in {p[0] for p in split} if w not in first]):
            first[p] = length(p)
        for p in (others := [w for w in set().union(*(p[1:] for p in split)) if w not in later]):
            later[p] = length(f" {p}")
        out = [first[p[0]] + sum(map(later.__getitem__, p[1:])) for p in split]
        self.first, self.later = trimmed(first, opening, self.entries), trimmed(later, others, self.entries)
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row for each of docs(doc_id, text): bytes, tokens, and whether it has more than ``limit`` tokens."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(tokenizer_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = resident(("token_counts", tokenizer_path), lambda: Counter(tokenizer_path, table.value, entries))
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n = counter.count(texts)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, SCHEMA)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
