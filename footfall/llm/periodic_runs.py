"""Periodic run detection on a grammar of each text's words.

A run is a stretch of consecutive words with a smallest period of q words and a length of
at least max(MIN_LENGTH, MIN_EXPONENT * q) that can't be extended to either side.

The words of a text are compressed by Re-Pair: pairs of neighbouring symbols that occur
more than once become nonterminals, the most frequent ones first, until no pair repeats.
What is left is halved again and again, so every boundary between two words lies in the
middle of exactly one node (a nonterminal, or a part of the rest). A run is found in the
lowest node that holds all of it, where it crosses the node's boundary and has two
periods before or two periods behind it. So each nonterminal is searched once, however
often it occurs; what it yields is then moved to all places at which it was put in, and
intervals of one period that overlap by a period are merged to maximal ones.

Pairs are replaced in rounds: a place is taken if its pair is more frequent than those
of the places that overlap it. All texts of a slice take part in a round together, but
no pair spans two texts, so a text's result depends on the text alone.

Words are separated by white space and compared by 64-bit hashes. Null and empty text, or
text of white space only, has no words and no runs; its collapsed text is empty. A very
long text is one slice of its own. Equal rows get equal results, each row its own.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.hashing import U, mix, slices, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Pairs of boundary and period that are looked at in one step.
STEP = 1 << 21

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_LEFT, _RIGHT, _DOC = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)


@dataclass
class Nodes:
    """Boundaries m inside [lo, hi), and all places (of lo) at which each node stands."""

    lo: list[np.ndarray] = field(default_factory=list)
    m: list[np.ndarray] = field(default_factory=list)
    hi: list[np.ndarray] = field(default_factory=list)
    count: list[np.ndarray] = field(default_factory=list)
    places: list[np.ndarray] = field(default_factory=list)

    def add(self, lo: np.ndarray, m: np.ndarray, hi: np.ndarray, count: np.ndarray, places: np.ndarray) -> None:
        for to, values in ((self.lo, lo), (self.m, m), (self.hi, hi), (self.count, count), (self.places, places)):
            to.append(values)


def _repeated(key: np.ndarray, able: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `able` whose key another such place has too, sorted by key, and where each key begins."""
    at = np.flatnonzero(able)
    bits = max(10, int(len(at)).bit_length() + 2)
    slot = (key[at] >> U(64 - bits)).astype(np.int64)
    at = at[np.bincount(slot, minlength=1 << bits)[slot] > 1]
    at = at[np.argsort(key[at], kind="stable")]
    own = key[at]
    begins = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(at) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(at)))
    at = at[np.repeat(sizes > 1, sizes)]
    sizes = sizes[sizes > 1]
    return at, np.cumsum(sizes) - sizes


def re_pair(names: np.ndarray, first: np.ndarray) -> Nodes:
    """Compress the words of texts first[i]..first[i+1]-1 and list the nodes of their grammars."""
    nodes = Nodes()
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place, size = np.arange(len(names)), np.ones(len(names), np.int64)
    while len(names) > 1:
        inside = text[1:] == text[:-1]
        same = inside & (names[1:] == names[:-1])
        key = mix(names[:-1] * _LEFT + names[1:] * _RIGHT + text[1:].astype(U) * _DOC)
        # Of a block of equal symbols only every other pair counts, as they overlap.
        steps = np.arange(len(same))
        block = np.maximum.accumulate(np.where(same, -1, steps))
        able = inside & ~(same & ((steps - block) % 2 == 0))
        at, begins = _repeated(key, able)
        if not len(at):
            break
        sizes = np.diff(np.append(begins, len(at)))
        weight = np.zeros(len(key) + 2, U)
        weight[at + 1] = (np.repeat(sizes, sizes).astype(U) << U(40)) | (key[at] >> U(24))
        own = weight[at + 1]
        won = (own > weight[at]) & (own >= weight[at + 2])
        wins = np.add.reduceat(won.astype(np.int64), begins)
        won &= np.repeat(wins > 1, sizes)
        wins, at = wins[wins > 1], at[won]
        lead = at[np.cumsum(wins) - wins]  # places of a key are ascending
        nodes.add(place[lead], place[lead + 1], place[lead + 1] + size[lead + 1], wins, place[at])
        names, size = names.copy(), size.copy()
        names[at] = key[at]
        size[at] += size[at + 1]
        stays = np.ones(len(names), bool)
        stays[at + 1] = False
        live = np.zeros(len(first) - 1, bool)
        live[text[at]] = True
        names, place, size, text = names[stays], place[stays], size[stays], text[stays]
        over = ~live[text]  # no pair of these texts repeats any more
        _halve(nodes, place[over], size[over], text[over])
        names, place, size, text = names[~over], place[~over], size[~over], text[~over]
    _halve(nodes, place, size, text)
    return nodes


def _halve(nodes: Nodes, place: np.ndarray, size: np.ndarray, text: np.ndarray) -> None:
    """Nodes over symbols that are left: the boundary before the j-th has 2**k symbols on each side, k being its trailing zeros."""
    if not len(place):
        return
    begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    counts = np.diff(np.append(begins, len(place)))
    base, total = np.repeat(begins, counts), np.repeat(counts, counts)
    j = np.arange(len(place)) - base
    reach = j & -j
    to = base + np.minimum(j + reach, total) - 1
    mid = np.flatnonzero(j > 0)
    lo = place[mid - reach[mid]]
    nodes.add(lo, place[mid], place[to[mid]] + size[to[mid]], np.ones(len(mid), np.int64), lo)


def _candidates(names: np.ndarray, m: np.ndarray, most: np.ndarray, sign: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, period) where single words allow two periods on one side of the boundary (sign 1: behind, -1: before)."""
    nodes, periods = [], []
    edge = m if sign > 0 else m - 1
    sums, lo = np.cumsum(most), 0
    while lo < len(m):
        hi = max(int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + STEP, "right")), lo + 1)
        node = np.repeat(np.arange(lo, hi), most[lo:hi])
        q = np.arange(len(node)) - np.repeat(np.cumsum(most[lo:hi]) - most[lo:hi], most[lo:hi]) + 1
        for part in (None, 1, 2, 3):  # the first word of a period, the last one, and two between
            offset = 0 if part is None else (q - 1) // part
            begin = edge[node] + sign * offset
            fits = names[begin] == names[begin + sign * q]
            node, q = node[fits], q[fits]
        nodes.append(node)
        periods.append(q)
        lo = hi
    return (np.concatenate(nodes), np.concatenate(periods)) if nodes else (np.zeros(0, np.int64),) * 2


def _end(names: np.ndarray, at: int, q: int, hi: int) -> int:
    """The first place from `at` on that differs from the one a period before, or hi."""
    step = 64
    while at < hi:
        to = min(hi, at + step)
        wrong = names[at:to] != names[at - q : to - q]
        if wrong.any():
            return at + int(wrong.argmax())
        at, step = to, step * 4
    return hi


def _start(names: np.ndarray, at: int, q: int, lo: int) -> int:
    """The least place from which on all places before `at` equal the one a period behind."""
    step = 64
    while at > lo:
        to = max(lo, at - step)
        wrong = (names[to:at] != names[to + q : at + q])[::-1]
        if wrong.any():
            return at - int(wrong.argmax())
        at, step = to, step * 4
    return lo


def _crossing(names: np.ndarray, lo: np.ndarray, m: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(node, start, end, period) of the runs over each node's boundary, cut at the node's ends."""
    found = set()
    for sign, side in ((1, hi - m), (-1, m - lo)):
        most = np.where(hi - lo >= MIN_LENGTH, np.minimum(side // 2, (hi - lo) // MIN_EXPONENT), 0)
        nodes, periods = _candidates(names, m, most, sign)
        edges = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else []
        for a, b in zip(edges, [*edges[1:], len(nodes)]):
            i = int(nodes[a])
            low, mid, high = int(lo[i]), int(m[i]), int(hi[i])
            left = periods[a:b]
            while len(left):
                q = int(left[0])
                left = left[1:]
                if sign > 0:
                    end = _end(names, mid + q, q, high)
                    if end < mid + 2 * q:
                        continue
                    start, reach = _start(names, mid, q, low), end - mid
                else:
                    start = _start(names, mid - q, q, low)
                    if start > mid - 2 * q:
                        continue
                    end, reach = _end(names, mid, q, high), mid - start
                if start < mid < end and end - start >= max(MIN_LENGTH, MIN_EXPONENT * q):
                    found.add((i, start, end, q))
                left = left[(left % q != 0) | (2 * left > reach)]  # the others have the period q too
    return sorted(found)


def find_runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the texts first[i]..first[i+1]-1, by start and period."""
    empty = (np.zeros(0, np.int64),) * 3
    nodes = re_pair(names, first)
    if not nodes.lo:
        return empty
    lo, m, hi, count, places = (np.concatenate(x) for x in (nodes.lo, nodes.m, nodes.hi, nodes.count, nodes.places))
    found = _crossing(names, lo, m, hi)
    if not found:
        return empty
    node, start, end, period = np.array(found, np.int64).T
    # To all places of the node.
    times, begin = count[node], (np.cumsum(count) - count)[node]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    shift = places[np.repeat(begin, times) + nth] - np.repeat(lo[node], times)
    start, end, period = np.repeat(start, times) + shift, np.repeat(end, times) + shift, np.repeat(period, times)
    # Merge intervals of one period that share a period or more.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    kind = np.cumsum(np.append(0, period[1:] != period[:-1]))
    room = len(names) + 1
    reach = np.maximum.accumulate(end + kind * room) - kind * room
    new = np.append(True, (kind[1:] != kind[:-1]) | (start[1:] > reach[:-1] - period[1:]))
    begins = np.flatnonzero(new)
    start, end, period = start[begins], np.maximum.reduceat(end, begins), period[begins]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _rows(texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs (start, length, period) and collapsed text of each text."""
    for w, (lo, _, offsets, data) in zip(words(texts), slices(texts)):
        start, end, period = find_runs(w.hashes, w.first)
        cuts = np.searchsorted(start, w.first)
        raw = data.tobytes()
        for i in range(w.hi - lo):
            own = raw[offsets[i] : offsets[i + 1]].split()
            n_words, a, b, base = len(own), cuts[i], cuts[i + 1], int(w.first[i])
            runs = [(int(s) - base, int(e - s), int(q)) for s, e, q in zip(start[a:b], end[a:b], period[a:b])]
            if runs:
                gone = bytearray(len(own))
                for s, n, q in runs:
                    gone[s + q : s + n] = b"\1" * (n - q)
                own = [x for x, g in zip(own, gone) if not g]
            yield n_words, runs, b" ".join(own)


def detect_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period) and collapsed_text of every row.

    In the collapsed text a run keeps its first period only, and words are joined by one
    space. Other columns are not read, whatever their names.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            found = list(_rows(batch.column(1)))
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for _, r, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array(runs, struct),
                 pa.array([t for _, _, t in found], pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed_text"],
            )

    out = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).mapInArrow(
        task, f"id {kind}, n_words bigint, runs {RUNS}, collapsed_text string"
    )
    return out.withColumnRenamed("id", id_column)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text, where some texts repeat words up to their end.

    With h = crc32 of the decimal doc_id and g = h div 10, a text of n > 0 words is changed
    if 10 divides h: each word i >= a becomes word a + (i - a) % p, with a = g % n and
    p = 1 + (n - a) div (3 + g % 8). A null doc_id changes nothing.
    """
    g = "crc32(cast(doc_id as string)) div 10"
    word = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    parts = docs.selectExpr(
        "doc_id", "text", f"{g} as g", f"case when crc32(cast(doc_id as string)) % 10 = 0 then {word} end as w"
    ).selectExpr("doc_id", "text", "g", "w", "case when size(w) > 0 then g % size(w) end as a")
    parts = parts.selectExpr("*", "1 + (size(w) - a) div (3 + g % 8) as p")
    return parts.selectExpr(
        "doc_id",
        """case when a is null then text else concat_ws(' ', transform(w, (x, i) ->
            if(i < a, x, element_at(w, cast(a + (i - a) % p + 1 as int))))) end as text""",
    )


def runs_report(docs: DataFrame) -> DataFrame:
    """One row for each document: its number of runs, the run of greatest exponent, digests of runs and collapsed text.

    The documents are those of `with_repeated_tails`. Of runs of equal exponent the first
    one counts, then the one of smaller period.
    """
    found = detect_runs(with_repeated_tails(docs))
    best = "if(r.length * b.period > b.length * r.period, r, b)"
    listed = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))"
    return found.selectExpr(
        "doc_id", "cast(size(runs) as bigint) as n_runs",
        f"case when size(runs) > 0 then aggregate(runs, runs[0], (b, r) -> {best}) end as top",
        f"sha2({listed}, 256) as runs_sha256", "sha2(collapsed_text, 256) as collapsed_sha256",
    ).selectExpr(
        "doc_id", "n_runs", "top.start as start", "top.length as length", "top.period as period",
        "1000 * top.length div top.period as exponent_milli", "runs_sha256", "collapsed_sha256",
    )
