"""Token counts: an exact histogram of encoded lengths, answered by suffix sums.

Documents are aggregated by their number of tokens. Suffix sums over that histogram give
for every context limit how many documents are longer, how many tokens there are in all,
and how many are left when each document is cut at the limit. Null and empty texts have
0 tokens. Special tokens are not looked for: their strings are ordinary text.
"""

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.conf import materialize

#: Lengths in one step of the two-step sums.
STEP = 128
#: The tokenizer's pattern needs stack for a long run of white space, so such a run is encoded on its own.
LONG_SPACE = 1000


def default_vocabulary() -> str:
    """Place of the byte-level BPE vocabulary of about 50,000 entries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Counts tokens under a vocabulary file of base64 tokens and ranks."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.long_space = re.compile(r"\s{%d,}" % LONG_SPACE)

    def count(self, text: str) -> int:
        """Tokens of the text.

        The pattern takes a run of white space but for its last character as one piece
        if something follows, so the text may be cut there without any change.
        """
        total, at = 0, 0
        for run in self.long_space.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            total += len(self.coding.encode_ordinary(text[at : run.start()]))
            total += len(self.coding._encode_single_piece(text[run.start() : end]))
            at = end
        return total + len(self.coding.encode_ordinary(text[at:] if at else text))


_ENCODERS: dict[str, Encoder] = {}


def token_count(text: str | Column, vocabulary: str | None = None) -> Column:
    """Tokens of a text column, under a vocabulary file that every executor has at that path."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        path = vocabulary or default_vocabulary()
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        return pa.array([encoder.count(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return count(text)


def length_histogram(docs: DataFrame, by: list[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """Columns `by`, length, docs: how many documents have each encoded length."""
    lengths = docs.select(*(by or []), token_count("text", vocabulary).alias("length"))
    return lengths.groupBy(*(by or []), "length").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(histogram: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The histogram with docs_at_least, tokens_at_least, truncated_tokens, docs_below, tokens, all_docs, all_tokens.

    Each row answers for its length as the context limit: truncated_tokens is what is
    left of all documents cut at it. Sums run over steps of lengths and then within
    each step, so neither lies in one task as lengths grow.
    """
    by = by or []
    rows = materialize(histogram, "token-lengths").withColumn("_step", F.floor(F.col("length") / STEP))
    rows = rows.withColumn("tokens", F.col("length") * F.col("docs"))
    steps = rows.groupBy(*by, "_step").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    after = Window.partitionBy(*by).orderBy("_step").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*by)
    zero = F.lit(0).cast("bigint")
    steps = steps.select(
        *(F.col(c).alias(f"_{c}") for c in by),
        F.col("_step").alias("_of"),
        F.coalesce(F.sum("_docs").over(after), zero).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(after), zero).alias("_tokens_after"),
        F.sum("_docs").over(whole).alias("all_docs"),
        F.sum("_tokens").over(whole).alias("all_tokens"),
    )
    same = F.col("_step") == F.col("_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy(*by, "_step").orderBy("length").rowsBetween(0, Window.unboundedFollowing)
    docs, tokens = F.sum("docs").over(within), F.sum("tokens").over(within)
    summed = rows.join(steps, same).withColumns(
        {"docs_at_least": docs + F.col("_docs_after"), "tokens_at_least": tokens + F.col("_tokens_after")}
    )
    return summed.select(
        *by,
        "length",
        "docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least")).alias("docs_below"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        "all_docs",
        "all_tokens",
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the least length that at least this share of the documents does not exceed."""
    wanted = sums.select("length", ((F.col("docs_below") + F.col("docs")) / F.col("all_docs")).alias("up_to"))
    return wanted.select("length", "up_to", F.explode(F.array(*map(F.lit, shares))).alias("share")).where(
        "up_to >= share"
    ).groupBy("share").agg(F.min("length").alias("length"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row, tokens: what is left when every document is cut at `limit`; null for no documents."""
    below = F.sum(F.when(F.col("length") < limit, F.col("tokens")).otherwise(F.col("docs") * limit))
    return sums.agg(below.alias("tokens"))
