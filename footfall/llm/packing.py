"""Packing of tokenized documents into sequences by cutting-stock column generation.

A document's tokens (an end token closes it) are cut into full pieces of SIZE tokens, each
a sequence of its own, and one shorter rest. The rests are what has to be packed. Their
histogram, at most SIZE - 1 counts, is all the driver sees. Lengths are put into classes
(single lengths where they are short or few), and a linear program says how often each
pattern of classes is used:

- a pattern costs the padding of its sequence, which is none if it fills SIZE or, with
  single lengths only, a power of two;
- a rest may go to the stream instead, where rests follow each other and are cut at every
  SIZE tokens. That costs no padding but CUT_COST tokens for each cut.

New patterns are priced by dynamic programming over a knapsack of SIZE tokens, with the
dual prices of the classes as values, until no pattern lowers the cost by GAP tokens a
sequence (or for ROUNDS rounds; first-fit decreasing gives the first patterns). Uses are rounded down, then up where enough rests are left; what remains goes
to the stream. Rests are ranked by length within their class, and a rank says the pattern,
the copy of it and so the sequence a rest goes to. The end of the stream is cut into
powers of two, so it needs no padding either.

Null text is empty text and has the end token only. A text is split at white space, where
the tokenizer splits as well, so a very long one is encoded piece by piece; only a word
without white space is encoded whole. Equal rows are packed each for itself. Other columns
are not read, whatever their names. An empty table gives no rows.
"""

import functools
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from footfall.conf import materialize
from footfall.llm.hashing import BASE, INVERSE, SPACES, U, mix, powers

SIZE = 2048
END_ID = 1
#: What a cut of a document and a sequence of less than SIZE tokens are held to cost, in tokens.
CUT_COST = 16
#: The program has at most about so many classes of lengths.
CLASSES = 512
#: Tokens of a sequence that a further pattern may still save when the program is left.
GAP = 1.0
#: Rounds of pricing at most: beyond them the program only gets nearer to its optimum.
ROUNDS = 50
#: New patterns a round at most, and how far prices stay with those of the round before.
NEW, SMOOTH = 200, 0.5
#: Parts of texts whose ids a worker remembers.
REMEMBERED = 1 << 20
#: Rests of one length that are numbered together, at least.
GROUP_ROWS = 2_000
#: Rests cut from the stream whose keys may be broadcast.
FEW = 100_000

_SPACE = re.compile(rb"\s")
_SLICE = 1 << 21


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _classes_of_bytes() -> np.ndarray:
    """0: white space. 1: letters, 2: digits and signs, which are always different tokens. 3: all else, which is not cut."""
    kinds = np.full(256, 3, np.uint8)
    kinds[0x21:0x7F] = 2
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kinds[[*SPACES]] = 0
    kinds[[ord("'"), ord("<")]] = 3  # endings such as 's, and special tokens
    return kinds


_KIND = _classes_of_bytes()


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    The tokenizer cuts at white space and between letters and signs, so texts are cut
    there first and each different part is encoded once while it is remembered. Parts
    are found by 64-bit hashes (of longer parts, cryptographic ones).
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.coding = Tokenizer.from_file(vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.begin, self.flat, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 14, "<u4"), 0

    def _learn(self, keys: list[int], parts: list[str]) -> None:
        for lo in range(0, len(parts), 1000):
            coded = [x.ids for x in self.coding.encode_batch_fast(parts[lo : lo + 1000], add_special_tokens=False)]
            sizes = np.cumsum([len(x) for x in coded])
            while self.used + sizes[-1] > len(self.flat):
                self.flat = np.append(self.flat, np.zeros_like(self.flat))
            while len(self.slots) + len(coded) + 1 > len(self.begin):
                self.begin = np.append(self.begin, np.zeros_like(self.begin))
            self.flat[self.used : self.used + sizes[-1]] = np.fromiter((i for x in coded for i in x), "<u4", sizes[-1])
            n = len(self.slots)
            self.begin[n + 1 : n + 1 + len(coded)] = self.used + sizes
            self.slots.update(zip(keys[lo : lo + 1000], range(n, n + len(coded))))
            self.used += int(sizes[-1])

    def _slice(self, texts: list[bytes]) -> list[bytes]:
        if len(self.slots) > REMEMBERED:
            self._forget()
        raw = b" ".join(texts) + b" "
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        begins = np.flatnonzero((kind > 0) & (np.append(0, kind[:-1]) == 0))
        if not len(begins):
            return [b""] * len(texts)
        odd = np.flatnonzero(np.maximum.reduceat(kind, begins) == 3)  # chunks that are not cut
        if len(odd):
            ends = np.flatnonzero((kind == 0) & (np.append(0, kind[:-1]) > 0))
            depth = np.zeros(len(raw) + 1, np.int8)
            depth[begins[odd]] = 1
            depth[ends[odd]] = -1
            kind[np.cumsum(depth[:-1], dtype=np.int8) > 0] = 3
        edges = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(raw)]])
        inside = kind[edges[:-1]] > 0
        starts, ends = edges[:-1][inside], edges[1:][inside]
        sums = np.zeros(len(raw) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(raw)), out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * powers(INVERSE, len(raw))[starts])
        for i in np.flatnonzero(ends - starts > 256):
            hashes[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest())
        keys, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = keys.tolist()
        fresh = [i for i, k in enumerate(keys) if k not in self.slots]
        self._learn([keys[i] for i in fresh], [raw[starts[j] : ends[j]].decode() for j in one[fresh].tolist()] if fresh else [])
        slots = np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))[inverse]
        first, size = self.begin[slots], self.begin[slots + 1] - self.begin[slots]
        upto = np.append(0, np.cumsum(size))
        ids = self.flat[np.repeat(first - upto[:-1], size) + np.arange(upto[-1])]
        texts_end = np.cumsum([len(t) + 1 for t in texts])
        cuts = upto[np.searchsorted(starts, texts_end)].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *cuts], cuts)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids; about _SLICE bytes are looked at together."""
        out: list[list[bytes]] = [[] for _ in texts]
        some: list[tuple[int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            raw, lo = (text or "").encode(), 0
            while lo < len(raw):
                hi = lo + _SLICE
                if hi < len(raw):  # up to the next white space
                    space = _SPACE.search(raw, hi)
                    hi = space.start() if space else len(raw)
                some.append((i, raw[lo:hi]))
                held += len(some[-1][1])
                lo = hi
                if held >= _SLICE:
                    self._put(some, out)
                    some, held = [], 0
        self._put(some, out)
        return [b"".join(x) for x in out]

    def _put(self, some: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        for (i, _), ids in zip(some, self._slice([raw for _, raw in some])):
            out[i].append(ids)


@functools.cache
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


@dataclass
class Plan:
    """What becomes of the rests: for each length, places in patterns by rank, and the stream."""

    #: (length, from_rank, to_rank, first_sequence, copies, shift); copy (rank + shift) % copies.
    places: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    #: (length, from_rank, position): rests from that rank on follow each other in the stream.
    stream: list[tuple[int, int, int]] = field(default_factory=list)
    sequences: int = 0
    stream_tokens: int = 0
    stream_rests: int = 0
    rounds: int = 0


def _classes(counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Lengths in use, class by class."""
    used = np.flatnonzero(counts)
    if len(used) <= CLASSES:
        return [used[i : i + 1] for i in range(len(used))]
    single = size * CLASSES // (4 * 1024) if size >= CLASSES else size
    width = -(-(size - single) // (CLASSES // 2))
    power = (used & (used - 1)) == 0
    kind = np.where((used <= single) | power, -used, (used - single) // width)
    cuts = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    return np.split(used, cuts)


def _knapsack(longest: np.ndarray, worth: np.ndarray, size: int, full: bool) -> tuple[np.ndarray, np.ndarray]:
    """The best worth of classes that take at most (full: exactly) w tokens, and the class taken last (-1: none), for each w."""
    best, last = np.full(size + 1, -np.inf if full else 0.0), np.full(size + 1, -1)
    best[0] = 0
    order = np.argsort(longest, kind="stable")
    longest, worth = longest[order], worth[order]
    upto = np.searchsorted(longest, np.arange(size + 1), "right")
    for w in range(1, size + 1):
        k = upto[w]
        if not full:
            best[w], last[w] = best[w - 1], -2  # one token stays free
        if k:
            values = best[w - longest[:k]] + worth[:k]
            i = int(values.argmax())
            if values[i] > best[w]:
                best[w], last[w] = values[i], order[i]
    return best, last


def _pattern(longest: np.ndarray, last: np.ndarray, w: int) -> np.ndarray:
    pattern = np.zeros(len(longest), np.int64)
    while w > 0 and last[w] != -1:
        if last[w] == -2:
            w -= 1
            continue
        pattern[last[w]] += 1
        w -= longest[last[w]]
    return pattern


class _Program:
    """minimise cost @ x with columns @ x = counts and x >= 0, by the revised simplex method."""

    def __init__(self, counts: np.ndarray, cost: np.ndarray):
        m = len(counts)
        self.counts, self.columns, self.cost = counts.astype(float), np.eye(m), cost.astype(float)
        self.basis, self.inverse = np.arange(m), np.eye(m)

    def add(self, columns: np.ndarray, cost: np.ndarray) -> None:
        self.columns, self.cost = np.hstack([self.columns, columns]), np.append(self.cost, cost)

    def solve(self) -> np.ndarray:
        """Pivots until no column lowers the cost; the dual prices."""
        for step in range(20 * len(self.counts) + 1000):
            if step % 100 == 0:
                self.inverse = np.linalg.inv(self.columns[:, self.basis])
                self.level = np.maximum(self.inverse @ self.counts, 0)
            prices = self.cost[self.basis] @ self.inverse
            reduced = self.cost - prices @ self.columns
            enter = int(reduced.argmin())
            if reduced[enter] > -1e-7:
                break
            ways = self.inverse @ self.columns[:, enter]
            down = np.flatnonzero(ways > 1e-9)
            if not len(down):
                break
            ratio = self.level[down] / ways[down]
            out = down[int(ratio.argmin())]
            self.level -= ratio.min() * ways
            self.level[out] = ratio.min()
            np.maximum(self.level, 0, out=self.level)
            row = self.inverse[out] / ways[out]
            self.inverse -= np.outer(ways, row)
            self.inverse[out] = row
            self.basis[out] = enter
        return self.cost[self.basis] @ self.inverse

    def forget(self) -> None:
        """Drop columns out of the basis that are far from entering."""
        prices = self.cost[self.basis] @ self.inverse
        keep = (self.cost - prices @ self.columns) < CUT_COST
        keep[self.basis] = True
        keep[: len(self.counts)] = True
        self.basis = (np.cumsum(keep) - 1)[self.basis]
        self.columns, self.cost = self.columns[:, keep], self.cost[keep]


def _priced(prices: np.ndarray, mean: np.ndarray, longest: np.ndarray, exact: np.ndarray, size: int) -> list[tuple[float, np.ndarray]]:
    """Cost and pattern of the NEW best different patterns: one with each class, and one for each power of two."""
    worth = mean + prices
    best, last = _knapsack(longest, worth, size, full=False)
    some = [(size - worth[c] - best[size - n], c, 0) for c, n in enumerate(longest)]
    if exact.any():
        top, end = _knapsack(longest[exact], prices[exact], size // 2, full=True)
        some += [(CUT_COST - top[1 << k], -1, 1 << k) for k in range((size // 2).bit_length())]
    found = {}
    for lower, c, fill in sorted(some):
        if lower > 0 or len(found) >= NEW:
            break
        pattern = np.zeros(len(longest), np.int64)
        if fill:
            pattern[exact] = _pattern(longest[exact], end, fill)
        else:
            pattern += _pattern(longest, last, size - longest[c])
            pattern[c] += 1
        found[fill > 0, pattern.tobytes()] = (CUT_COST if fill else size - pattern @ mean, pattern)
    return list(found.values())


def _decreasing(total: np.ndarray, longest: np.ndarray, size: int) -> list[np.ndarray]:
    """Patterns of first-fit decreasing on the histogram, to begin with: each one uses up a class."""
    left, patterns = total.astype(float), []
    while left.any():
        pattern, room = np.zeros(len(total), np.int64), size
        for c in np.flatnonzero(left)[::-1]:
            if longest[c] <= room:
                pattern[c] = min(room // longest[c], max(1, left[c]))
                room -= pattern[c] * longest[c]
        has = pattern > 0
        shares = left[has] / pattern[has]
        left[has] -= shares.min() * pattern[has]
        left[np.flatnonzero(has)[shares.argmin()]] = 0
        patterns.append(pattern)
    return patterns


def plan_patterns(counts: np.ndarray, size: int = SIZE) -> Plan:
    """Where counts[n] rests of n tokens each go (n from 1 to size - 1)."""
    plan = Plan()
    if not counts.any():
        return plan
    classes = _classes(counts, size)
    total = np.array([counts[c].sum() for c in classes])
    mean = np.array([(counts[c] * c).sum() for c in classes]) / total
    longest = np.array([c[-1] for c in classes])
    exact = np.array([len(c) == 1 for c in classes])
    program = _Program(total, mean * (CUT_COST / size))
    first = _decreasing(total, longest, size)
    program.add(np.array(first, float).T, np.array([size - p @ mean for p in first]))
    prices = centre = program.solve()
    while plan.rounds < ROUNDS:
        plan.rounds += 1
        # Prices that move half the way swing less; where they find nothing, the full way decides.
        for used in (SMOOTH * centre + (1 - SMOOTH) * prices, prices):
            found = _priced(used, mean, longest, exact, size)
            better = [(c, p) for c, p in found if c - prices @ p < -GAP]
            if better:
                break
        if not better:
            break
        centre = used
        if program.columns.shape[1] > 4 * len(classes) + 500:
            program.forget()
        program.add(np.array([p for _, p in better], float).T, np.array([c for c, _ in better]))
        prices = program.solve()
    # Whole numbers of uses.
    left, uses = total.copy(), []
    order = np.argsort(-(program.level % 1), kind="stable")
    basic = [(int(program.basis[i]), float(program.level[i])) for i in order if program.basis[i] >= len(classes)]
    patterns = {j: program.columns[:, j].astype(np.int64) for j, _ in basic}
    times = dict.fromkeys(patterns, 0)
    for up in (False, True):
        for j, level in basic:
            has = patterns[j] > 0
            room = int((left[has] // patterns[j][has]).min())
            n = min(room, 1 if up and level % 1 > 0.01 else 0 if up else int(level + 1e-6))
            times[j] += n
            left -= n * patterns[j]
    uses = [(patterns[j], n) for j, n in times.items() if n]
    # Ranks of each class, longest first, to the copies of its patterns.
    taken: list[list[tuple[int, int, int, int]]] = [[] for _ in classes]
    upto = np.zeros(len(classes), np.int64)
    for pattern, n in uses:
        for c in np.flatnonzero(pattern):
            taken[c].append((int(upto[c]), int(upto[c] + n * pattern[c]), plan.sequences, n))
            upto[c] += n * pattern[c]
        plan.sequences += n
    for c, lengths in enumerate(classes):
        ahead = 0
        for length in lengths[::-1].tolist():
            have = int(counts[length])
            for a, b, sequence, n in taken[c]:
                lo, hi = max(a, ahead), min(b, ahead + have)
                if lo < hi:
                    plan.places.append((length, lo - ahead, hi - ahead, sequence, n, ahead - a))
            used = min(max(int(upto[c]) - ahead, 0), have)
            if used < have:
                plan.stream.append((length, used, plan.stream_tokens))
                plan.stream_tokens += (have - used) * length
                plan.stream_rests += have - used
            ahead += have
    return plan


def _encode(docs: DataFrame, id_column: str, text_column: str, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """key, id, doc_tokens, checksums of full pieces, and length, checksum and ids of the rest of each document."""
    kind = docs.schema[id_column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for ids in encoder.ids(batch.column(2).to_pylist()):
                ids += end
                n, step = len(ids) // 4, 4 * size
                whole = n // size * step
                rest = ids[whole:]
                values = (n, [zlib.crc32(ids[i : i + step]) for i in range(0, whole, step)], n % size, zlib.crc32(rest), rest)
                for to, value in zip(out, values):
                    to.append(value)
            long = pa.int64()
            types = (long, pa.list_(long), long, long, pa.binary())
            arrays = [batch.column(0), batch.column(1), *(pa.array(x, t) for x, t in zip(out, types))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "id", "doc_tokens", "full", "length", "crc", "ids"])

    return docs.select(F.monotonically_increasing_id().alias("key"), docs[id_column].alias("id"), docs[text_column].alias("text")).mapInArrow(
        task, f"key bigint, id {kind}, doc_tokens bigint, full array<bigint>, length bigint, crc bigint, ids binary"
    )


def _ranked(pieces: DataFrame, counts: list[tuple[int, int]]) -> DataFrame:
    """Add rank, from 0 among pieces of the same length.

    Pieces of one length are numbered in groups by a hash of their key; a group and the
    number of groups both grow with the root of the count.
    """
    spark = pieces.sparkSession
    groups = [(n, max(1, c // max(GROUP_ROWS, int(4 * c**0.5)))) for n, c in counts]
    groups = spark.createDataFrame(groups, "length bigint, groups bigint")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn("part", F.expr("pmod(xxhash64(key, start), groups)"))
    sizes = dealt.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("key", "start"))
    return dealt.withColumn("own", own).join(sizes, ["length", "part"]).withColumn("rank", F.expr("before + own - 1"))


def pack(
    docs: DataFrame, vocabulary: str | None = None, size: int = SIZE, end_id: int = END_ID,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    start counts the ids of the document before the piece, offset those of the sequence.
    Sequences are numbered from 0: those of patterns, then full pieces, then the stream.
    """
    spark = docs.sparkSession
    coded = _encode(docs, id_column, text_column, vocabulary or default_vocabulary(), end_id, size)
    coded = materialize(coded, "packing-ids")
    rests = coded.where("length > 0").selectExpr("key", "id", "doc_tokens", "doc_tokens - length as start", "length", "crc")
    full = coded.selectExpr("key", "id", "doc_tokens", "posexplode(full) as (nth, crc)")
    full = full.selectExpr("key", "id", "doc_tokens", f"nth * {size}L as start", f"{size}L as length", "crc")
    pieces = rests.union(full)
    counts = [(r.length, r["count"]) for r in pieces.groupBy("length").count().collect()]  # at most `size` rows
    histogram = np.zeros(size, np.int64)
    for n, c in counts:
        if n < size:
            histogram[n] = c
    plan = plan_patterns(histogram, size)
    n_full = dict(counts).get(size, 0)
    places = [*plan.places, *([(size, 0, n_full, plan.sequences, n_full, 0)] if n_full else [])]
    rows = [(n, a, b, s, c, h, None) for n, a, b, s, c, h in places]
    rows += [(n, a, int(histogram[n]), None, None, None, at) for n, a, at in plan.stream]
    where = "n bigint, lo bigint, hi bigint, first bigint, copies bigint, shift bigint, at bigint"
    where = F.broadcast(spark.createDataFrame(rows, where))  # bounded by lengths and classes
    placed = _ranked(pieces, counts).join(where, F.expr("length = n and rank >= lo and rank < hi"))
    placed = placed.selectExpr(
        "key", "id", "start", "length", "crc", "doc_tokens", "first + pmod(rank + shift, copies) as sequence_id",
        "at + (rank - lo) * length as at",
    )
    placed = materialize(placed, "packing-places")
    columns = ["id", "start", "length", "crc as ids_crc32", "doc_tokens", "sequence_id"]
    done = placed.where("sequence_id is not null")
    within = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "key").rowsBetween(Window.unboundedPreceding, -1)
    packed = done.where(F.col("length") < size).withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    packed = packed.selectExpr(*columns, "offset").union(done.where(F.col("length") == size).selectExpr(*columns, "0L as offset"))
    if plan.stream_rests:
        keys = placed.where("at is not null").selectExpr("key", "at", "start")
        keys = F.broadcast(keys) if plan.stream_rests <= FEW else keys
        cut = coded.select("key", "id", "doc_tokens", "ids").join(keys, "key")
        packed = packed.union(_cut(cut, plan, plan.sequences + n_full, size))
    return packed.withColumnRenamed("id", id_column)


def _cut(rests: DataFrame, plan: Plan, first: int, size: int) -> DataFrame:
    """The rests of the stream, cut at every `size` tokens and at powers of two of what is left at its end."""
    kind = rests.schema["id"].dataType.simpleString()
    whole = plan.stream_tokens // size * size
    ends, at = [], whole
    for k in reversed(range(size.bit_length())):
        if (plan.stream_tokens - whole) >> k & 1:
            at += 1 << k
            ends.append(at)

    def piece(at: int) -> tuple[int, int, int]:
        """Sequence, begin and end of what covers a position."""
        if at < whole:
            return at // size, at // size * size, at // size * size + size
        i = next(i for i, end in enumerate(ends) if at < end)
        return whole // size + i, ([whole, *ends])[i], ends[i]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, tokens, ids, at, start in zip(*(batch.column(i).to_pylist() for i in range(5))):
                done, n = 0, len(ids) // 4
                while done < n:
                    sequence, lo, hi = piece(at + done)
                    length = min(n - done, hi - at - done)
                    crc = zlib.crc32(ids[4 * done : 4 * (done + length)])
                    for to, value in zip(out, (doc, start + done, length, crc, tokens, first + sequence, at + done - lo)):
                        to.append(value)
                    done += length
            types = (batch.schema.field(0).type, *(pa.int64(),) * 6)
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=names)

    return rests.select("id", "doc_tokens", "ids", "at", "start").mapInArrow(
        task, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
