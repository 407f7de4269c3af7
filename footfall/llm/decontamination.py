"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: each of its rows holds the postings of all words of some
documents (of about BLOCK_WORDS words together, or of one longer document) as two
arrays: the distinct word hashes, ascending, and the word positions in the block in
order of (word, position). It is written once; building it moves no text.

A test item is cut into windows of n consecutive words; an item of fewer words, but not
none, is one window. A window is looked up by intersecting the position lists of its
words, each moved back by the word's place in the window, beginning with the rarest
word of the block. For proximity the rarest word is that of the whole index, as it is
part of what matches. Words are compared by 64-bit hashes.

Words are runs of ASCII letters (A-Z lower-cased), digits and all characters beyond
ASCII. Null and empty texts have none. Repeated rows are searched like any others.
Items without words match nothing; items with equal ids count as one item, and so do all
items with a null id, which is counted but not listed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.conf import materialize
from footfall.llm.hashing import byte_classes, words
from footfall.llm.session import carries_columns

NGRAM = 10
BLOCK_WORDS = 500_000
#: Windows that are looked up in one pass over the index.
QUERY_WINDOWS = 200_000
WORDS = byte_classes([[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]], lower=True)

INDEX = "block bigint, doc_ids array<string>, first array<int>, terms binary, starts binary, positions binary"
MATCHES = "block bigint, nth int, doc_id string, item_id string, start int, length int"


def _block(number: int, ids: list, counts: list[int], hashes: list[np.ndarray]) -> dict:
    """One row of INDEX."""
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    heads = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0) if len(ranked) else np.zeros(0, np.int64)
    return {
        "block": (TaskContext.get().partitionId() << 32) + number,
        "doc_ids": ids,
        "first": first.astype(np.int32),
        "terms": ranked[heads].tobytes(),
        "starts": np.append(heads, len(ranked)).astype(np.int32).tobytes(),
        "positions": order.astype(np.int32).tobytes(),
    }


def _index_rows(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.string())), ("first", pa.list_(pa.int32())), ("terms", pa.binary()),
        ("starts", pa.binary()), ("positions", pa.binary()),
    ])
    number, ids, counts, hashes, held = 0, [], [], [], 0
    for batch in batches:
        own_ids = batch.column("doc_id").to_pylist()
        for w in words(batch.column("text"), WORDS):
            ids += own_ids[w.lo : w.hi]
            counts += np.diff(w.first).tolist()
            hashes.append(w.hashes)
            held += len(w.hashes)
            if held >= block_words:
                yield pa.RecordBatch.from_pylist([_block(number, ids, counts, hashes)], schema)
                number, ids, counts, hashes, held = number + 1, [], [], [], 0
    if ids:
        yield pa.RecordBatch.from_pylist([_block(number, ids, counts, hashes)], schema)


def build_index(docs: DataFrame, id_column: str = "doc_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The index of `docs`, stored in the shared folder. Ids are kept as text."""
    named = docs.select(F.col(id_column).cast("string").alias("doc_id"), "text")
    return materialize(named.mapInArrow(lambda x: _index_rows(x, block_words), INDEX), "positional-index")


class Block:
    """The postings of one index row."""

    def __init__(self, row: dict):
        self.ids, self.first = row["doc_ids"], np.array(row["first"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.int32)
        self.positions = np.frombuffer(row["positions"], np.int32)

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in `terms`, -1 for those the block does not have."""
        at = np.minimum(np.searchsorted(self.terms, hashes), max(0, len(self.terms) - 1))
        return np.where(self.terms[at] == hashes, at, -1) if len(self.terms) else np.full(hashes.shape, -1)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term + 1]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions at which the words stand next to each other within one document."""
        order = self._rarest_first(terms)
        begin = self.postings(terms[order[0]]) - int(order[0])
        begin = begin[begin >= 0]
        for place in order[1:]:
            if not len(begin):
                return begin
            begin = begin[_found(self.postings(terms[place]), begin + int(place))]
        return begin[self.document(begin) == self.document(begin + len(terms) - 1)]

    def proximity(self, terms: np.ndarray, order: np.ndarray, slack: int) -> np.ndarray:
        """Positions of the first word of `order` about which each other word of the same document
        stands within `slack` words of its place."""
        anchor = self.postings(terms[order[0]])
        for place in order[1:]:
            doc, have = self.document(anchor), self.postings(terms[place])
            at = anchor + int(place - order[0])
            low = np.maximum(at - slack, self.first[doc])
            high = np.minimum(at + slack, self.first[doc + 1] - 1)
            anchor = anchor[np.searchsorted(have, high, "right") > np.searchsorted(have, low)]
        return anchor

    def _rarest_first(self, terms: np.ndarray) -> np.ndarray:
        return np.argsort(self.starts[terms + 1] - self.starts[terms], kind="stable")


def _found(have: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
    return have[at] == wanted


def _windows(items: list[tuple[str, str]], n: int) -> list[tuple[list[str], np.ndarray]]:
    """Different windows, each with the items it occurs in."""
    found: dict[bytes, tuple[dict, np.ndarray]] = {}
    for w in words(pa.array([t for _, t in items], pa.large_string()), WORDS):
        for i in range(w.lo, w.hi):
            own = w.hashes[w.first[i - w.lo] : w.first[i - w.lo + 1]]
            for j in range(max(1, len(own) - n + 1) if len(own) else 0):
                window = own[j : j + n]
                found.setdefault(window.tobytes(), ({}, window))[0][items[i][0]] = True
    return [(list(ids), window) for ids, window in found.values()]


def _index_counts(index: DataFrame, items: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of some test items, ascending, and how often each stands in the whole index."""
    texts = pa.array([t for _, t in items], pa.large_string())
    wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *(w.hashes for w in words(texts, WORDS))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                at = block.look_up(wanted)
                have = at >= 0
                counts[have] += block.starts[at[have] + 1] - block.starts[at[have]]
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["place", "n"])

    sums = index.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # words of one pass
    counts = np.zeros(len(wanted), np.int64)
    counts[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return wanted, counts


def _search(index: DataFrame, items: list[tuple[str, str]], n: int, slack: int) -> DataFrame:
    """MATCHES of some test items, as many as fit one pass."""
    wanted, counts = _index_counts(index, items) if slack else (None, None)
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(items, n)
        by_length: dict[int, tuple[list, np.ndarray]] = {}
        for length in {len(w) for _, w in windows}:
            own = [(ids, w) for ids, w in windows if len(w) == length]
            by_length[length] = ([ids for ids, _ in own], np.stack([w for _, w in own]))
        for batch in batches:
            for row in batch.to_pylist():
                block, out = Block(row), []
                for length, (ids, hashes) in by_length.items():
                    terms = block.look_up(hashes)
                    for i in np.flatnonzero((terms >= 0).all(axis=1)):
                        if slack:
                            order = np.argsort(counts[np.searchsorted(wanted, hashes[i])], kind="stable")
                            begin = block.proximity(terms[i], order, slack)
                        else:
                            begin = block.phrase(terms[i])
                        for at, doc in zip(begin.tolist(), block.document(begin).tolist()):
                            start = at - int(block.first[doc])
                            out += [(row["block"], doc, block.ids[doc], item, start, length) for item in ids[i]]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), types)],
                        ["block", "nth", "doc_id", "item_id", "start", "length"],
                    )

    return index.mapInArrow(run, MATCHES)


def _item_batches(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """Test items in lists of at most QUERY_WINDOWS words, streamed part by part."""
    items, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null")
    for row in rows.toLocalIterator():
        items.append((row[0], row[1]))
        size += len(row[1]) // 2 + 1
        if size >= QUERY_WINDOWS:
            yield items
            items, size = [], 0
    yield items


def find_matches(index: DataFrame, benchmark: DataFrame, n: int = NGRAM, slack: int = 0) -> DataFrame:
    """MATCHES: where windows of test items occur in the indexed documents.

    A row names the index block, the document's place in it and its id, the item (as
    text), and the first word and number of words matched. With `slack` each word may
    stand that many words from its place about the window's word that is rarest in the
    whole index (of equally rare ones the first), whose place `start` then is (proximity
    instead of phrase). Items are taken in lists of bounded size, one pass over the stored index each.
    """
    found = [_search(index, items, n, slack) for items in _item_batches(benchmark)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of `docs`."""
    index = build_index(docs)
    hits = find_matches(index, benchmark, n)
    per_doc = hits.sparkSession.sql(
        """
        select block, nth, array_sort(items) as items, size(items) + unnamed as n_items, aggregate(array_sort(spans), named_struct('upto', 0, 'hit', 0L),
          (a, x) -> named_struct('upto', greatest(a.upto, x.start + x.length),
            'hit', a.hit + greatest(0, x.start + x.length - greatest(a.upto, x.start))), a -> a.hit) as n_hit
        from (
          select block, nth, collect_set(item_id) as items, max(cast(item_id is null as int)) as unnamed, collect_set(struct(start, length)) as spans
          from {hits} group by block, nth)""",
        hits=hits,
    )
    return docs.sparkSession.sql(
        """
        select cast(d.doc_id as bigint) as doc_id, d.n_words, coalesce(h.n_hit, 0L) as n_hit,
          cast(coalesce(h.n_items, 0) as bigint) as n_items,
          sha2(coalesce(array_join(h.items, ','), ''), 256) as items_sha256, coalesce(h.n_hit, 0L) > 0 as contaminated
        from (
          select block, pos as nth, id as doc_id, cast(first[pos + 1] - first[pos] as bigint) as n_words
          from (select block, first, posexplode(doc_ids) as (pos, id) from {index})) d
        left join {per_doc} h on d.block = h.block and d.nth = h.nth""",
        index=index,
        per_doc=per_doc,
    )


@carries_columns
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """The rows of `docs`, all columns, in whose text no window of a test item occurs.

    Texts are indexed by their hash, as equal texts are contaminated alike.
    """
    hashed = docs.select("text").withColumn("_hash", F.md5("text"))
    hits = find_matches(build_index(hashed.where("text is not null"), "_hash"), benchmark, n)
    ids = materialize(hits.select(F.col("doc_id").alias("_hash")).distinct(), "contaminated-texts")
    return docs.withColumn("_hash", F.md5("text")).join(ids, "_hash", "left_anti").select(*docs.columns)
