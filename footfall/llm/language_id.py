"""Language identification by interpolated Kneser-Ney character models.

For each language a model of ORDER characters is learned from all given texts. Text is
lower-cased, and each run of characters that are no letters is one space. A gram is
packed exactly into 64 bits (16 for a character). Models are one table: for a language
and a gram or context of each order, what it adds to the log-probability of a character.
A text gets the language under which its characters have the lowest mean cross-entropy.

Every language, every gram and every labelled text counts. Models that are small go to the
tasks whole. Of larger ones only the scores of the most frequent grams do; the other grams of
the documents are joined with the table, once for each block of documents they occur in.
Log-probabilities are whole numbers, so either way gives the same sums, in any order.

The score is the language's share when the models' likelihoods, raised to a calibrated
power, are set against each other. A prediction is `rejected` when its cross-entropy is
higher, or its score lower, than the texts learned from have in that language but for a
small share. Texts that are null or have no letter get `und` and score 0, and so does every
text when there was nothing to learn from. Equal texts get equal results.
"""

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from footfall.conf import materialize

ORDER = 4
#: Models of at most as many table rows go to every task whole.
MAX_GRAMS = 1_200_000
#: Most scores (grams times languages) of frequent grams that go to every task, and most that
#: a block of documents asks the table for (one slice of texts may ask for more).
MAX_SCORES = 4_000_000
REJECT_SHARE = 0.005
#: Limits of rejection are multiples of 1 / FINE_BITS and 1 / FINE_SCORE.
FINE_BITS, FINE_SCORE = 1 << 12, 1 << 16
POWERS = (0.25, 0.5, 1, 2, 4, 8, 16, 32)
#: Log-probabilities are whole multiples of 1 / ONE bits; FLOOR is that of an unknown character.
ONE, FLOOR = 1 << 20, -16
SLICE_CHARS = 1 << 20
UNKNOWN = "und"
U = np.uint64

_LETTER = np.zeros(1 << 16, bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def normalized(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts (letters, one space for others, a space at both ends) and where each begins."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum([0] + [len(t) + 1 for t in lowered])
    chars = np.minimum(points, 0xFFFF).astype(np.uint16)  # characters beyond 16 bits count as one letter
    letter = _LETTER[chars] | (points > 0xFFFF)
    chars = np.where(letter, chars, np.uint16(32))
    keep = letter | np.roll(letter, 1)
    keep[ends] = True  # the end of each text stays as its own space
    position = np.cumsum(keep) - 1
    return chars[keep], position[ends]


def grams(chars: np.ndarray, order: int) -> np.ndarray:
    """For each character the packed gram that ends with it."""
    out = np.zeros(len(chars), U)
    for j in range(order):
        shifted = np.full(len(chars), U(32), U)
        shifted[j:] = chars[: len(chars) - j] if j else chars
        out |= shifted << U(16 * j)
    return out


def gram_slices(texts: list[str | None], order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, grams, first) for runs of texts; grams reach over no text's beginning but for spaces."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= SLICE_CHARS):
            size += len(texts[hi] or "")
            hi += 1
        chars, first = normalized([t or "" for t in texts[lo:hi]])
        yield lo, hi, _without_other_texts(grams(chars, order), first, order), first
        lo = hi


def _without_other_texts(packed: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """Grams near the beginning of a text, with spaces for what belongs to the text before."""
    for j in range(1, order):  # the j-th character of a text
        at = first[:-1] + j
        at = at[at < np.append(first[1:], 0)[: len(at)] + 1] if len(at) else at
        mask = (U(1) << U(16 * j)) - U(1)
        blank = sum(32 << (16 * i) for i in range(j, order))
        packed[at] = (packed[at] & mask) | U(blank)
    return packed


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n: grams of all texts of each language, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pd.Series]] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for lang in set(langs):
                for _, _, packed, first in gram_slices(list(texts[langs == lang]), order):
                    packed = np.delete(packed, first[:1])  # the space before the first text
                    codes, values = pd.factorize(packed)
                    parts = held.setdefault(lang, [])
                    parts.append(pd.Series(np.bincount(codes, minlength=len(values)), values))
                    if len(parts) >= 16:
                        held[lang] = [pd.concat(parts).groupby(level=0).sum()]
        for lang, parts in held.items():
            total = pd.concat(parts).groupby(level=0).sum()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(total), pa.string()), pa.array(total.index.to_numpy(U).view(np.int64)),
                    pa.array(total.to_numpy(np.int64)),
                ],
                ["lang", "gram", "n"],
            )

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """What goes to tasks: scores of the most frequent grams, and all table rows if these are few."""

    def __init__(self, langs: list[str], order: int):
        self.langs, self.order, self.whole, self.table = langs, order, True, None
        self.base = np.zeros(len(langs), np.int64)  # of a character of which nothing is known
        # by language: (kind, keys, values); a kind is as in `_key`
        self.rows: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in langs]
        self.keys, self.scores = np.zeros(0, U), np.zeros((0, len(langs)), np.int32)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "table": None}

    def _all(self, packed: np.ndarray) -> np.ndarray:
        """Scores of any grams, from all table rows."""
        out = np.zeros((len(packed), len(self.langs)), np.int32)
        for i, kinds in enumerate(self.rows):
            out[:, i] = self.base[i]
            for kind, keys, values in kinds:
                own = packed & _mask(abs(kind))
                out[:, i] += _values(keys, values, own if kind > 0 else own >> U(16), 0)
        return out

    def slices(self, texts: list[str | None]) -> Iterator[tuple]:
        """(lo, hi, sums, sizes, missed) for runs of texts.

        Sums of log-probabilities for each text and language, and the texts' characters. Missed are the
        grams that the sums lack: (text, gram, count), each once for a text.
        """
        for lo, hi, packed, first in gram_slices(texts, self.order):
            codes, values = pd.factorize(packed)
            at = np.minimum(np.searchsorted(self.keys, values), max(0, len(self.keys) - 1))
            known = self.keys[at] == values if len(self.keys) else np.zeros(len(values), bool)
            scores = np.zeros((len(values), len(self.langs)), np.int32)
            scores[known] = self.scores[at[known]]
            missed = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            if self.whole:
                scores[~known] = self._all(values[~known])
            elif not known.all():
                where = np.flatnonzero(~known[codes])
                where = where[(where > first[0]) & (where <= first[-1])]
                text = np.searchsorted(first, where - 1, "right") - 1
                pairs, counts = np.unique(text * len(values) + codes[where], return_counts=True)
                missed = (pairs // len(values), values[pairs % len(values)].view(np.int64), counts)
            sums = np.zeros((hi - lo, len(self.langs)), np.int64)
            for i in range(len(self.langs)):
                total = np.concatenate([[0], np.cumsum(scores[codes, i], dtype=np.int64)])
                sums[:, i] = total[first[1:] + 1] - total[first[:-1] + 1]
            yield lo, hi, sums, np.diff(first), missed

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean cross-entropy (bits) of each text under each language, and its characters."""
        if not self.whole:
            raise ValueError("the models are larger than MAX_GRAMS: texts need `score`")
        parts = [(sums, sizes) for _, _, sums, sizes, _ in self.slices(texts)]
        sums = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, len(self.langs)), np.int64)
        sizes = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        return _entropies(sums, sizes), sizes


def _entropies(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return -(sums / ONE) / np.maximum(sizes, 1)[:, None]


def _mask(order: int) -> np.uint64:
    return U((1 << (16 * order)) - 1) if order < 4 else U(2**64 - 1)


def _key(kind: int, gram: str = "gram") -> str:
    """SQL of the key that a gram looks up: its last `kind` characters, or the context of its last -kind ones."""
    own = f"{gram} & {(1 << (16 * abs(kind))) - 1 if abs(kind) < 4 else -1}L"
    return own if kind > 0 else f"shiftrightunsigned({own}, 16)"


def _values(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise) -> np.ndarray:
    """The value of each wanted key, by binary search in a sorted array."""
    if not len(keys):
        return np.broadcast_to(otherwise, wanted.shape).copy()
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


def _counts_by_order(top: DataFrame, order: int) -> list[DataFrame]:
    """From order 1: lang, gram, n, total, types. Below the highest order n counts different left neighbours."""
    levels = [top]
    for o in range(order - 1, 0, -1):
        mask = (1 << (16 * o)) - 1
        shorter = levels[0].withColumn("gram", F.expr(f"gram & {mask}L"))
        levels.insert(0, shorter.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")))
    out = []
    for level in levels:
        context = level.groupBy("lang", F.expr("shiftrightunsigned(gram, 16)").alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")
        )
        named = level.withColumn("context", F.expr("shiftrightunsigned(gram, 16)"))
        out.append(named.join(context, ["lang", "context"]).select("lang", "gram", "n", "total", "types"))
    return out


def _smoothed(level: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """lang, gram, p, weight, value: interpolated probability of each gram of one order, log-weight of the order
    below after its context, and what the gram adds to that weight and the log-probability of the shorter gram."""
    off = level.groupBy("lang").agg(F.expr("count_if(n = 1)").alias("once"), F.expr("count_if(n = 2)").alias("twice"))
    off = off.selectExpr("lang", "if(once = 0, 0.5D, least(0.95D, greatest(0.1D, once / (once + 2 * twice)))) as off")
    rows = level.join(off, "lang")
    if lower is None:
        rows = rows.withColumn("below", F.lit(2.0**FLOOR))
    else:
        shorter = lower.selectExpr("lang", "gram as suffix", "p as below")
        rows = rows.withColumn("suffix", F.expr(_key(order - 1))).join(shorter, ["lang", "suffix"])
    bits = "cast(round({} * log2({})) as int)"
    return rows.selectExpr(
        "lang", "gram", "(greatest(n - off, 0D) + off * types * below) / total as p",
        bits.format(ONE, "off * types / total") + " as weight", bits.format(ONE, "below") + " as lower",
    ).selectExpr("lang", "gram", "p", "weight", bits.format(ONE, "p") + " - weight - lower as value")


def _table(top: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """kind, key, lang, value of all grams and contexts, and lang, value of the empty context.

    The log-probability of a character under a language is FLOOR, the empty context's value, and the
    values of all keys of its gram that the language has.
    """
    lower, rows = None, []
    for o, level in enumerate(_counts_by_order(top, order), 1):
        lower = materialize(_smoothed(level, lower, o), f"language-order-{o}")
        rows.append(lower.selectExpr(f"{o} as kind", "gram as key", "lang", "value"))
        contexts = lower.selectExpr(f"{-o} as kind", f"{_key(-o)} as key", "lang", "weight as value").distinct()
        rows.append(contexts)
    empty = rows.pop(1).select("lang", "value")
    return functools.reduce(DataFrame.union, rows), empty


def _frequent(top: DataFrame, most: int) -> DataFrame:
    """At most `most` grams of those seen most often: all grams of like counts, from the top."""
    every = top.groupBy("gram").agg(F.expr("floor(8 * log2(sum(n)))").alias("size"))
    least, sizes = None, every.groupBy("size").count().orderBy(F.desc("size")).collect()
    for r in sizes:
        most -= r["count"]
        if most < 0:
            break
        least = r["size"]
    return every.where(F.col("size") >= F.lit(least)).select("gram")


def _scores(table: DataFrame, grams: DataFrame, order: int, base: np.ndarray) -> DataFrame:
    """gram, scores: log-probabilities of different grams under all languages, out of the table."""
    kinds = [k for o in range(1, order + 1) for k in (o, -o) if k != -1]
    wanted = F.explode(F.array(*[F.expr(f"struct({k} as kind, {_key(k)} as key)") for k in kinds]))
    lists = table.groupBy("kind", "key").agg(F.collect_list(F.struct("lang", "value")).alias("found"))

    @F.arrow_udf("array<int>")
    def summed(found: pa.Array) -> pa.Array:
        out = np.tile(base, (len(found), 1))
        rows, pairs = _flat(found)
        np.add.at(out, (rows, _numpy(pc.struct_field(pairs, "lang"))), _numpy(pc.struct_field(pairs, "value")))
        return _lists(out, pa.int32())

    rows = grams.select("gram", wanted.alias("w")).select("gram", "w.kind", "w.key").join(lists, ["kind", "key"], "left")
    return rows.groupBy("gram").agg(F.flatten(F.collect_list("found")).alias("found")).select("gram", summed("found").alias("scores"))


def _numpy(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each element of a list column, and the elements."""
    return np.repeat(np.arange(len(lists)), _numpy(pc.list_value_length(lists))), lists.flatten()


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of the rows of a matrix."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel(), kind))


def _matrix(lists: pa.Array, columns: int) -> np.ndarray:
    return _numpy(lists.flatten()).reshape(len(lists), columns)


def learn(docs: DataFrame, order: int = ORDER) -> Model:
    """Models of every language of `docs` (text, lang) with a non-null lang, from all texts.

    To the driver come the names of the languages, all table rows if they are at most MAX_GRAMS,
    and at most MAX_SCORES scores.
    """
    if not 2 <= order <= 4:
        raise ValueError("grams of 2 to 4 characters fit 64 bits")
    top = materialize(count_grams(docs.where("lang is not null and text is not null"), order), "language-grams")
    langs = sorted(r["lang"] for r in top.select("lang").distinct().collect())
    model = Model(langs, order)
    if not langs:
        return model
    numbers = docs.sparkSession.createDataFrame(list(enumerate(langs)), "number int, lang string")
    top = top.join(numbers, "lang").select(F.col("number").alias("lang"), "gram", "n")
    model.table, empty = _table(top, order)
    for r in empty.collect():
        model.base[r["lang"]] = FLOOR * ONE + r["value"]
    frequent = _frequent(top, MAX_SCORES // len(langs))
    model.whole = model.table.count() <= MAX_GRAMS
    if model.whole:
        rows = model.table.toArrow().to_pandas().sort_values(["lang", "kind", "key"])
        for (lang, kind), own in rows.groupby(["lang", "kind"]):
            keys, values = own["key"].to_numpy(np.int64).view(U), own["value"].to_numpy(np.int32)
            at = np.argsort(keys)
            model.rows[lang].append((int(kind), keys[at], values[at]))
        model.keys = np.sort(_numpy(frequent.toArrow()["gram"].combine_chunks()).astype(np.int64).view(U))
        model.scores = model._all(model.keys)
    else:
        found = _scores(model.table, frequent, order, model.base).toArrow().combine_chunks()
        keys = _numpy(found["gram"].combine_chunks()).astype(np.int64).view(U)
        at = np.argsort(keys)
        model.keys, model.scores = keys[at], _matrix(found["scores"].combine_chunks(), len(langs))[at].astype(np.int32)
    return model


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The `keep` columns of each row of `docs` (text, lang), with own, sizes, letters and sums.

    own is the number of the row's lang (-1: none), sizes the characters of the text, letters
    whether it has any, and sums has its log-probability under each language, in 1 / ONE bits.
    """
    shared, n_langs = docs.sparkSession.sparkContext.broadcast(model), len(model.langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        numbers = {lang: i for i, lang in enumerate(own.langs)}
        block, asked, rows = TaskContext.get().partitionId() << 32, np.zeros(0, np.int64), 0
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lo, hi, sums, sizes, (text, grams, counts) in own.slices(texts):
                more = np.union1d(asked, grams)
                if rows and (len(more) + rows + hi - lo) * n_langs > MAX_SCORES:
                    block, more, rows = block + 1, np.unique(grams), 0
                asked, rows = more, rows + hi - lo
                ends = pa.array(np.searchsorted(text, np.arange(hi - lo + 1)), pa.int32())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in keep], pa.array([numbers.get(x, -1) for x in langs[lo:hi]], pa.int32()),
                        pa.array(sizes, pa.int64()), pa.array([_has_letter(t) for t in texts[lo:hi]], pa.bool_()),
                        _lists(sums, pa.int64()), pa.array([block] * (hi - lo), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(grams, pa.int64())),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    ],
                    names,
                )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    schema = ", ".join([*kept, "own int", "sizes bigint", "letters boolean", "sums array<bigint>"])
    missing = ", block bigint, grams array<bigint>, counts array<bigint>"
    names = [*keep, "own", "sizes", "letters", "sums", "block", "grams", "counts"]
    columns = list(dict.fromkeys([*keep, "text", "lang"]))
    scored = materialize(docs.select(*columns).mapInArrow(run, schema + missing), "language-scores")
    if model.whole:
        return scored.drop("block", "grams", "counts")

    def add(held: pa.Table, found: pa.Table) -> pa.Table:
        held, found = held.combine_chunks(), found.combine_chunks()
        sums = _matrix(_column(held, "sums"), n_langs).copy()
        if len(found):
            keys, values = _numpy(_column(found, "gram")), _matrix(_column(found, "scores"), n_langs)
            order = np.argsort(keys)
            rows, grams = _flat(_column(held, "grams"))
            counts = _numpy(_column(held, "counts").flatten())
            at = order[np.searchsorted(keys[order], _numpy(grams))]
            for i in range(n_langs):  # whole numbers below 2 ** 53
                sums[:, i] += np.bincount(rows, counts * values[at, i], len(sums)).astype(np.int64)
        place = held.schema.get_field_index("sums")
        return held.set_column(place, "sums", _lists(sums, pa.int64())).select(names[:-3])

    asked = scored.select(F.col("block").alias("asking"), F.explode("grams").alias("gram")).distinct()
    found = asked.join(_scores(model.table, asked.select("gram").distinct(), model.order, model.base), "gram")
    added = scored.groupBy("block").cogroup(found.groupBy("asking")).applyInArrow(add, schema)
    return materialize(added, "language-sums")


def _column(rows: pa.Table, name: str) -> pa.Array:
    """A column of a table as one array."""
    chunks = rows[name].combine_chunks()
    return chunks if isinstance(chunks, pa.Array) else pa.concat_arrays(chunks.chunks)


def calibrate(model: Model, docs: DataFrame) -> tuple[float, dict[str, tuple[float, float]]]:
    """The power of the likelihoods, and for each language (highest cross-entropy, lowest score) that passes.

    All texts of `docs` (text, lang) with a non-null lang count.
    """
    return _limits(model, score(docs.where("lang is not null and text is not null"), model, []))


def _limits(model: Model, scored: DataFrame) -> tuple[float, dict[str, tuple[float, float]]]:
    """As `calibrate`, from scored rows."""
    n_langs = len(model.langs)
    scored = scored.where("own >= 0 and letters")

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(POWERS), np.int64)
        for batch in batches:
            entropy, own = _read(batch.column("sums"), batch.column("sizes"), n_langs), _numpy(batch.column("own"))
            for i, power in enumerate(POWERS):
                share = np.maximum(1e-9, _shares(entropy, power)[np.arange(len(own)), own])
                total[i] += np.rint(-ONE * np.log(share)).astype(np.int64).sum()
        yield pa.RecordBatch.from_arrays([pa.array(POWERS, pa.float64()), pa.array(total, pa.int64())], ["power", "loss"])

    if not n_langs or scored.isEmpty():
        return 1.0, {}
    sums = scored.select("own", "sizes", "sums").mapInArrow(losses, "power double, loss bigint")
    power = min((r["loss"], r["power"]) for r in sums.groupBy("power").agg(F.sum("loss").alias("loss")).collect())[1]
    judge = F.arrow_udf(_judge(model.langs, power, {}), VERDICT)
    right = scored.select("own", judge("sums", "sizes", "letters").alias("p")).where("own = p.number")
    fine = f"explode(array(struct(0 as what, ceil({FINE_BITS} * p.entropy) as at), struct(1 as what, -floor({FINE_SCORE} * p.score) as at))) as x"
    counts = right.selectExpr("own", fine).groupBy("own", "x.what", "x.at").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("own", "what")
    counts = counts.withColumn("upto", F.sum("n").over(group.orderBy("at"))).withColumn("all", F.sum("n").over(group))
    passing = counts.where(F.col("upto") >= (1 - REJECT_SHARE) * F.col("all")).groupBy("own", "what").agg(F.min("at").alias("at"))
    at = {(r["own"], r["what"]): r["at"] for r in passing.collect()}
    return power, {lang: (at[i, 0] / FINE_BITS, -at[i, 1] / FINE_SCORE) for i, lang in enumerate(model.langs) if (i, 0) in at}


def _read(sums: pa.Array, sizes: pa.Array, n_langs: int) -> np.ndarray:
    """Cross-entropies of scored rows."""
    return _entropies(_matrix(sums, n_langs), _numpy(sizes))


def _shares(entropy: np.ndarray, power: float) -> np.ndarray:
    """How the languages share a text, from their cross-entropies."""
    odds = np.exp2(-power * (entropy - entropy.min(axis=1, keepdims=True)))
    return odds / odds.sum(axis=1, keepdims=True)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


VERDICT = "number int, lang string, score double, entropy double, rejected boolean"


def _judge(langs: list[str], power: float, limits: dict[str, tuple[float, float]]):
    """A function from sums, sizes and letters of scored rows to VERDICT."""

    def of(sums: pa.Array, sizes: pa.Array, letters: pa.Array) -> pa.Array:
        entropy, rows = _read(sums, sizes, len(langs)), []
        shares = _shares(entropy, power) if langs else entropy
        for i, some in enumerate(letters.to_pylist()):
            if not langs or not some:
                rows.append({"number": -1, "lang": UNKNOWN, "score": 0.0, "entropy": None, "rejected": True})
                continue
            k = int(entropy[i].argmin())
            most, least = limits.get(langs[k], (math.inf, 0.0))
            e, s = float(entropy[i, k]), float(shares[i, k])
            rows.append({"number": k, "lang": langs[k], "score": s, "entropy": e, "rejected": e > most or s < least})
        kinds = [
            ("number", pa.int32()), ("lang", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()),
            ("rejected", pa.bool_()),
        ]
        return pa.array(rows, pa.struct(kinds))

    return of


def predict(spark: SparkSession, model: Model, power: float, limits: dict, text: str | Column) -> Column:
    """VERDICT on a text column, for models that are whole; others need `score`."""
    if not model.whole:
        raise ValueError("the models are larger than MAX_GRAMS: texts need `score`")
    shared, judge = spark.sparkContext.broadcast(model), _judge(model.langs, power, limits)

    @F.arrow_udf(VERDICT)
    def of(texts: pa.Array) -> pa.Array:
        own, given = shared.value, texts.to_pylist()
        parts = [(sums, sizes) for _, _, sums, sizes, _ in own.slices(given)]
        if not parts:
            return judge(_lists(np.zeros((0, len(own.langs)), np.int64), pa.int64()), pa.array([], pa.int64()), pa.array([], pa.bool_()))
        sums, sizes = (np.concatenate(x) for x in zip(*parts))
        return judge(_lists(sums, pa.int64()), pa.array(sizes), pa.array([_has_letter(t) for t in given], pa.bool_()))

    return of(text)


HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected for each row of `docs`.

    Learns from text and lang of the documents that are not held out; a null doc_id is
    not held out.
    """
    held = docs.select("doc_id", "text", "lang", F.expr(f"coalesce({HELD_OUT}, false) as held_out"))
    model = learn(held.where("not held_out").select("text", "lang"))
    scored = score(held, model, ["doc_id", "held_out"])
    power, limits = _limits(model, scored.where("not held_out"))
    judge = F.arrow_udf(_judge(model.langs, power, limits), VERDICT)
    return scored.select("doc_id", "held_out", judge("sums", "sizes", "letters").alias("p")).selectExpr(
        "doc_id", "held_out", "p.lang as lang_pred", "p.score as score", "p.entropy as cross_entropy", "p.rejected as rejected"
    )
