"""Groups of spelling variants by a frontier of states over a relational trie.

Words are near if one differs from the other by exactly one inserted, deleted or replaced
character. The trie of all words is a table of nodes: a node is a prefix of words and has
the characters that lead on from it. States (word, node, rest of the word, edits) are
joined with that table level by level: an equal character moves on without an edit; the
one edit allowed skips a character of the word, takes one of the node, or takes one for
another. A state at the end of its word, with one edit, at a node that is a word has
found a neighbour.

Near the root a node has very many words below it and many ways on, so no state starts
there: an edit in the second half of a word is looked for in the trie of the words, from
the node of their first half; an edit in the first half in the trie of the reversed
words, from the node of their reversed second half. Both lie in one table, under a mark
in front. A node is one row with at most as many ways on as there are characters, so a
state becomes a bounded number of states, most of which end in the next level. Each
level is written to the shared folder.

A trie needs as many levels as its longest word has characters, so words of MAX_LENGTH
characters or more take another exact way among themselves: near words agree in what is
left without one character of the longer one (of both, at the same place, if they are
equally long). They are joined on hashes of that and then compared.

Null words and texts are no words. Equal rows count each. Extra columns are not read,
whatever their names. A very long text is counted like others, its words being emitted
once for a batch of texts. An empty table gives no rows.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.conf import materialize
from footfall.llm.hashing import BASE, INVERSE, U, mix, powers

MIN_LENGTH = 5
MIN_COUNT = 3
MAX_LENGTH = 48
#: A form has at least so many times the occurrences of its word.
RATIO = 2
#: Different words of a task that are counted before they are sent on.
HELD = 1 << 17

_LETTER = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Latin-1 bytes: A-Z lower-cased, other letters kept, anything else a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in set(_LETTER) else 0x20 for b in range(256))


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: runs of Latin letters, A-Z lower-cased, of which some lose a character.

    With h = crc32 of `<doc_id>:<run>` (a null doc_id is empty there), a run of m characters
    loses its character h % m, from 0, if 97 divides h. Words are summed within tasks
    first, so a frequent word is no large group.
    """

    def table(total: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = Counter((text.as_py() or "").encode("latin-1", "replace").translate(_FOLD).split())
                begin = zlib.crc32(f"{doc_id or ''}:".encode())
                for run, n in runs.items():
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
                    if h % 97 == 0:
                        i = h % len(run)
                        run = run[:i] + run[i + 1 :]
                    if len(run) >= min_length:
                        total[run] += n
            if len(total) > HELD:
                yield table(total)
                total = Counter()
        if total:
            yield table(total)

    # "replace" turns what Latin-1 lacks into a question mark, which is no letter.
    own = docs.where("text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    words = own.mapInArrow(task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= min_count)


#: What one edit makes of a state (node, rest): the next character w of the word is `left(rest, 1)`. A character of the
#: trie is put in only where the word has another one, and the last one of equal characters is skipped: the other
#: places give the same neighbours. A state stays only if its node has the way on that its rest needs next.
_EDITED = """
    concat(
      transform(filter(ways, x -> x.c <> left(rest, 1) and array_contains(x.next, left(rest, 1))),
        x -> struct(concat(node, x.c) as node, rest as rest)),
      transform(filter(ways, x -> rest <> '' and x.c <> left(rest, 1) and array_contains(x.next, substr(rest, 2, 1))),
        x -> struct(concat(node, x.c) as node, substr(rest, 2) as rest)),
      if(rest <> '' and substr(rest, 2, 1) <> left(rest, 1) and (length(rest) = 1 or exists(ways, x -> x.c = substr(rest, 2, 1))),
        array(struct(node as node, substr(rest, 2) as rest)), array()))
"""
#: The way that a state without edits left goes.
_ON = "exists(ways, x -> x.c = left(rest, 1) and array_contains(x.next, substr(rest, 2, 1)))"


def _trie(paths: DataFrame) -> DataFrame:
    """node, ways (c, next): the characters that lead on from a node, and those that lead on from there ('' at a word's end).

    A path gives its nodes from the middle of a word that is one character shorter on.
    """
    steps = paths.selectExpr("path", "explode(sequence((length(path) - 2) div 2 + 2, length(path))) as i")
    nodes = steps.selectExpr("left(path, i) as child", "substr(path, i + 1, 1) as way").groupBy("child").agg(F.collect_set("way").alias("next"))
    ways = nodes.selectExpr("left(child, length(child) - 1) as node", "struct(right(child, 1) as c, next) as way")
    return ways.groupBy("node").agg(F.collect_list("way").alias("ways"))


def _trie_pairs(words: DataFrame) -> DataFrame:
    """word, near (both directions, some repeated): walks of all words through the trie."""
    paths = words.select("word", F.expr("explode(array(concat('>', word), concat('<', reverse(word))))").alias("path"))
    trie = materialize(_trie(paths), "spelling-trie")
    deepest = words.agg(F.max(F.length("word"))).first()[0] or 0
    ends, edited = [], None
    for level in range(deepest - deepest // 2 + 1):
        at = f"(length(path) - 1) div 2 + 1 + {level}"
        exact = paths.where(f"{at} <= length(path)").selectExpr("word", f"left(path, {at}) as node", f"substr(path, {at} + 1) as rest")
        # At the end of a word whose node has no ways on, no edit is left to make.
        exact = exact.join(trie, "node")
        states = exact.select("word", F.explode(F.expr(_EDITED)).alias("to")).select("word", "to.*")
        if edited is not None:
            on = edited.where("rest <> ''").join(trie, "node").where(_ON)
            states = states.union(on.selectExpr("word", "concat(node, left(rest, 1)) as node", "substr(rest, 2) as rest"))
        edited = materialize(states, f"spelling-level-{level}")
        ends.append(edited.where("rest = ''").select("word", "node"))
    found = ends[0]
    for more in ends[1:]:
        found = found.union(more)
    return found.selectExpr("word", "if(left(node, 1) = '>', substr(node, 2), reverse(substr(node, 2))) as near")


def _one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)  # the longest common beginning
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return a[lo + (len(a) == len(b)) :] == b[lo + 1 :]


def _long_pairs(words: DataFrame) -> DataFrame:
    """word, near (both directions) among long words: joined by hashes of what is left without one character, then compared."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                codes = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(U) + U(1))
                m = len(codes)
                sums = np.zeros(m + 1, U)
                np.cumsum(codes * powers(BASE, m), out=sums[1:])
                left = np.append(sums[:-1] + (sums[-1] - sums[1:]) * U(INVERSE), sums[-1]).view(np.int64)
                places = np.append(np.arange(m), -1)  # -1: the whole word
                names = [None] * m + [word]
                for lo in range(0, m + 1, 4096):
                    part = slice(lo, lo + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[part], pa.string()), pa.array(np.full(len(places[part]), left[-1])), pa.array(places[part]), pa.array(left[part])],
                        names=["word", "whole", "place", "left"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [_one_edit(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(near, pa.bool_()))

    made = words.select("word").mapInArrow(keys, "word string, whole bigint, place bigint, left bigint")
    made = materialize(made, "spelling-long")
    names, a, b = made.where("place = -1").select("word", "whole"), made.alias("a"), made.alias("b")
    same = a.join(b, F.expr("a.left = b.left and a.place = b.place and a.place >= 0 and a.whole <> b.whole"))
    less = a.join(b, F.expr("a.left = b.left and a.place >= 0 and b.place = -1"))
    pairs = same.selectExpr("a.whole as x", "b.whole as y").union(less.selectExpr("a.whole as x", "b.whole as y"))
    pairs = pairs.union(less.selectExpr("b.whole as x", "a.whole as y")).distinct()
    pairs = pairs.join(names.toDF("word", "x"), "x").join(names.toDF("near", "y"), "y").select("word", "near")
    return pairs.mapInArrow(compare, "word string, near string")


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: for each of the different words all words at one edit, with their n."""
    pairs = _trie_pairs(words.where(F.length("word") <= MAX_LENGTH))
    long = words.where(F.length("word") >= MAX_LENGTH)
    if not long.isEmpty():
        pairs = pairs.union(_long_pairs(long))
    return pairs.distinct().join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: follow forms to the last, twice as far in each round. A form has more occurrences, so none leads back."""
    now, open_ = materialize(forms.selectExpr("word", "form as root"), "spelling-roots"), None
    while open_ != 0:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(on, "root", "left").selectExpr("word", "coalesce(further, root) as root", "further is not null as moved"), "spelling-roots")
        open_ = now.where("moved").count()
        now = now.select("word", "root")
    return now


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table (word, n).

    The form is the near word of largest n (then the first in code-point order) if it
    has at least RATIO times the word's n; the root is found by following forms.
    """
    words = words.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words, "spelling-words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    out = words.join(near, "word", "left").selectExpr("word", "n", "coalesce(n_near, 0L) as n_near", f"case when -best.less >= {RATIO} * n then best end as best")
    out = materialize(out.selectExpr("word", "n", "n_near", "best.form as form", "-best.less as form_n"), "spelling-forms")
    roots = _roots(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").selectExpr("word", "form", "coalesce(root, word) as root", "n", "n_near", "form_n")
