"""Quality classifier by importance resampling.

Two generative models of hashed word and word-pair counts are set against each other:
one of good text, from a bounded sample of labelled documents, and one of raw text, from
all documents. The log importance weight of a document is the sum, over its words and
pairs, of the log of their probability in good over that in raw text. Documents are
drawn in proportion to their weights without replacement: of log weight plus Gumbel
noise the k largest are kept. k is the number of documents whose weight is beyond a
bound that is set on labelled documents the model has not learned from.

A few words that good text never has, such as insults, weigh little in that sum. So a
third model, of words alone and with buckets of its own, counts only words of so many
documents that good ones would have them by chance (MIN_EXPECTED), and whose number of
good documents is no chance either; a word counts at most MOST times in a text. A document whose words
weigh less there than a bound, set on the same labelled documents, counts as bad: its
log weight is lowered below the other bound by as much as it misses this one. As a few labelled
documents can't show that a bound loses no good ones, it counts as losing one more than they
show, so it has to find as many bad ones as that is worth.

Words are runs of letters, digits and characters beyond ASCII, or of other signs, in
lower case. A word that repeats the one before it counts as the mark of a repetition,
whatever it is. A null or empty text has weight 0, which speaks neither for nor against
it. Without good and bad labels nothing can be told, and everything is kept. Rows equal
in id and text have equal noise and stay or go together.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.conf import materialize
from footfall.llm.hashing import Words, byte_classes, mix, words
from footfall.llm.session import carries_columns

#: Hash buckets of the models.
BUCKETS = 1 << 16
#: Buckets of the model of words alone.
WORD_BUCKETS = 1 << 18
#: A bucket of that model counts if so many of the good documents learned from, were they like
#: all others, had its words. (Words may come in bursts, so documents are counted for this.)
MIN_EXPECTED = 10
#: How often a word counts in a text there, as words may come in bursts.
MOST = 4
#: Good documents that a bound of that model is taken to lose beyond those seen (rule of succession).
UNSEEN = 1
#: Bound on the labelled documents that are used (those with the least hash of doc_id).
LABELLED = 20_000
#: Share of the good counts in the model of good text; the rest is the raw model. A small
#: share keeps log ratios nearly linear in the counts, so that chance in the counts of rare
#: words does not add up to a bias against long or unusual documents.
GOOD_SHARE = 0.2
#: How many bad documents a good one that is rejected counts as when the bound is set.
GOOD_OVER_BAD = 10
SEED = 42

_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
TOKENS = byte_classes([[b for b in range(256) if b >= 128 or chr(b).isalnum()], _SIGNS], lower=True)
_SAME = np.uint64(0x5BD1E9955BD1E995)


def _repeats(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Which words repeat the one before them, and the first word of each row."""
    same = np.zeros(len(w.hashes), bool)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    heads = w.first[:-1][np.diff(w.first) > 0]
    same[heads] = False
    return same, heads


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and pairs of each row, and where each row's begin."""
    n = len(w.hashes)
    single, pair = w.hashes.copy(), np.zeros(n, np.uint64)
    if n:
        pair[1:] = mix(w.hashes[1:] + np.uint64(3) * w.hashes[:-1])
        same, heads = _repeats(w)
        pair[heads] = mix(w.hashes[heads] + np.uint64(1))
        single[same], pair[same] = _SAME, mix(_SAME[None])
    both = np.stack([single, pair], axis=1).reshape(-1)
    return (both % np.uint64(BUCKETS)).astype(np.int64), 2 * w.first


def word_features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words alone of each row, and where each row's begin."""
    single = np.where(_repeats(w)[0], _SAME, w.hashes)
    return (single % np.uint64(WORD_BUCKETS)).astype(np.int64), w.first


def labelled_sample(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, good, fold of at most `limit` labelled documents.

    Good means quality 1 and not toxic; of several labels of a document the worst holds.
    Rows without id or quality are left out. Fold 0 is learned from, 1 sets the bound.
    """
    worst = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good")
    )
    drawn = F.xxhash64("doc_id", F.lit(SEED))
    return worst.withColumn("h", drawn).orderBy("h", "doc_id").limit(limit).selectExpr("doc_id", "good", "cast(pmod(h, 2) as int) as fold")


def learn(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The log ratio of each bucket, its probability in good over that in raw text, and that of each word bucket.

    One pass over all documents; each task sends one sum for each bucket. Word buckets
    are numbered after the others.
    """
    n = BUCKETS + WORD_BUCKETS  # and one more for the documents themselves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good, having, good_having = (np.zeros(n + 1, np.int64) for _ in range(4))
        for batch in batches:
            chosen = batch.column("chosen").to_numpy(zero_copy_only=False).astype(bool)
            raw[n] += len(chosen)
            good[n] += chosen.sum()
            for w in words(batch.column("text"), TOKENS):
                for of, part in ((features, slice(0, BUCKETS)), (word_features, slice(BUCKETS, n))):
                    buckets, first = of(w)
                    size = part.stop - part.start
                    raw[part] += np.bincount(buckets, minlength=size)
                    own = np.repeat(chosen[w.lo : w.hi], np.diff(first))
                    if own.any():
                        good[part] += np.bincount(buckets[own], minlength=size)
                row = np.repeat(np.arange(w.hi - w.lo), np.diff(first))
                once = np.unique(row * WORD_BUCKETS + buckets)
                having[BUCKETS:n] += np.bincount(once % WORD_BUCKETS, minlength=WORD_BUCKETS)
                once = once[chosen[w.lo + once // WORD_BUCKETS]]
                good_having[BUCKETS:n] += np.bincount(once % WORD_BUCKETS, minlength=WORD_BUCKETS)
        used = np.flatnonzero(raw)
        columns = [pa.array(x) for x in (used, raw[used], good[used], having[used], good_having[used])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "good", "having", "good_having"])

    chosen = sample.where("good and fold = 0").select(F.col("doc_id").alias("_id"))  # at most LABELLED rows
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"), "left")
    counted = marked.select("text", F.col("_id").isNotNull().alias("chosen")).mapInArrow(
        run, "bucket bigint, raw bigint, good bigint, having bigint, good_having bigint"
    )
    sums = counted.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "good", "having", "good_having")))
    sums = sums.where(~F.col("bucket").between(BUCKETS, n - 1) | (F.col("having") >= MIN_EXPECTED)).toArrow()  # at most n + 1 rows
    raw, good, having, good_having = np.zeros((4, n + 1))
    for of, c in ((raw, "raw"), (good, "good"), (having, "having"), (good_having, "good_having")):
        of[sums.column("bucket").to_numpy()] = sums.column(c).to_numpy()
    part = good[n] / max(raw[n], 1)
    having, good_having = having[BUCKETS:n], good_having[BUCKETS:n]
    raw, raw_words, good, good_words = raw[:BUCKETS], raw[BUCKETS:n], good[:BUCKETS], good[BUCKETS:n]
    if not good.sum():
        return np.zeros(BUCKETS), np.zeros(WORD_BUCKETS)
    p_raw = (raw + 1) / (raw + 1).sum()
    p_good = GOOD_SHARE * good / good.sum() + (1 - GOOD_SHARE) * p_raw
    share = good.sum() / raw.sum()
    word_ratios = np.log((good_words + share) / (raw_words + 1) / share)
    document_ratios = np.log((good_having + part) / (having + 1) / part)
    weaker = np.where(np.abs(word_ratios) < np.abs(document_ratios), word_ratios, document_ratios)
    expected = having * part
    sure = (expected >= MIN_EXPECTED) & (np.abs(good_having - expected) > 3 * np.sqrt(expected)) & (word_ratios * document_ratios > 0)
    return np.log(p_good / p_raw), np.where(sure, weaker, 0.0)


def log_weight(ratios: np.ndarray, text: str | Column, of: Callable = features, most: int | None = None) -> Column:
    """The log importance weight of a text column by its features, each counted `most` times at most. `ratios` has a fixed size."""

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for w in words(texts, TOKENS):
            buckets, first = of(w)
            if most is not None:
                keys, n = np.unique(np.repeat(np.arange(w.hi - w.lo), np.diff(first)) * len(ratios) + buckets, return_counts=True)
                terms = ratios[keys % len(ratios)] * np.minimum(n, most)
                out[w.lo : w.hi] = np.round(np.bincount(keys // len(ratios), terms, w.hi - w.lo), 6)
                continue
            sums = np.concatenate([[0.0], np.cumsum(ratios[buckets])])
            out[w.lo : w.hi] = np.round(sums[first[1:]] - sums[first[:-1]], 6)
        return pa.array(out)

    return weigh(text)


def gumbel(seed: int = SEED) -> Column:
    """Gumbel noise from a hash of id and text."""
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11) + F.lit(0.5)) / float(1 << 53)
    return -F.log(-F.log(u))


def bound(judged: list[tuple[float, bool]], unseen: int = 0) -> float:
    """The weight from which on documents count as good, from (weight, good) of labelled ones.

    It lies midway between the two neighbours where the fewest errors are made, a good
    document below counting as GOOD_OVER_BAD bad ones above. Any bound is taken to lose
    `unseen` good documents more than are seen below it.
    """
    if len({good for _, good in judged}) < 2:
        return -math.inf
    judged = sorted(judged)
    weights, good = np.array([w for w, _ in judged]), np.array([g for _, g in judged])
    errors = GOOD_OVER_BAD * np.concatenate([[0], np.cumsum(good)]) + np.concatenate([np.cumsum(~good[::-1])[::-1], [0]])
    errors[1:] += GOOD_OVER_BAD * unseen
    cuts = np.concatenate([[-np.inf], (weights[1:] + weights[:-1]) / 2, [np.inf]])
    allowed = np.concatenate([[True], weights[1:] > weights[:-1], [True]])
    return float(cuts[allowed][errors[allowed].argmin()])


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest value of a column without nulls, by counting in ever finer ranges."""
    above, rest = 0, rows.select(F.col(column).alias("x"))
    while True:
        low, high, n = rest.agg(F.min("x"), F.max("x"), F.count(F.lit(1))).first()
        if low == high:
            return low
        if n <= few:
            return sorted((r["x"] for r in rest.collect()), reverse=True)[k - above - 1]
        width = (high - low) / bins
        at = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1))
        counts = {r["b"]: r["n"] for r in rest.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b] >= k:
                break
            above += counts[b]
        rest = rest.where(at == b)


def weights(models: tuple[np.ndarray, np.ndarray]) -> list[Column]:
    """log_weight and word_weight of a text."""
    return [log_weight(models[0], "text").alias("log_weight"), log_weight(models[1], "text", word_features, MOST).alias("word_weight")]


def lowered(floor: float, least_words: float) -> Column:
    """The weight that documents are drawn by: `log_weight`, or below `floor` as far as `word_weight` is below its bound."""
    missed = F.col("word_weight") - F.lit(least_words)
    return F.when(missed < 0, F.least("log_weight", F.lit(floor) + missed)).otherwise(F.col("log_weight"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], Column, DataFrame, float]:
    """Log ratios; the weight to draw by; doc_id, log_weight, gumbel_key of every document; the least key that is drawn."""
    sample = materialize(labelled_sample(labels), "labelled-sample")
    models = learn(docs, sample)
    scores = materialize(docs.select("doc_id", *weights(models), gumbel().alias("g")), "importance-weights")
    known = scores.join(F.broadcast(sample.where("fold = 1")), "doc_id")
    # One row for each doc_id, so no more than LABELLED; of several texts under one id the least weights.
    judged = known.groupBy("doc_id", "good").agg(F.min("log_weight").alias("log_weight"), F.min("word_weight").alias("word_weight")).collect()
    least = bound([(r["log_weight"], r["good"]) for r in judged])
    least_words = bound([(r["word_weight"], r["good"]) for r in judged], UNSEEN)
    if not math.isfinite(least_words):
        least_words = -math.inf  # words that tell nothing reject nothing
    k = scores.where((F.col("log_weight") >= least) & (F.col("word_weight") >= least_words)).count()
    floor = least if math.isfinite(least) else scores.agg(F.min("log_weight")).first()[0] or 0.0
    weight = lowered(floor, least_words)
    scores = scores.select("doc_id", "log_weight", (weight + F.col("g")).alias("gumbel_key"))
    return models, weight, scores, kth_largest(scores, "gumbel_key", k) if k else math.inf


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept for each row of `docs`."""
    *_, scores, cut = fit(docs, labels)
    return scores.withColumn("kept", F.col("gumbel_key") >= cut)


@carries_columns
def keep_resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are drawn, all columns."""
    models, weight, _, cut = fit(docs, labels)
    weighed = docs.select("*", *weights(models))
    return weighed.where(weight + gumbel() >= cut).select(*docs.columns)
