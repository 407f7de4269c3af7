"""Substring dedup by sliding spans of sentences.

Every run of SPAN consecutive sentences with at least MIN_BYTES bytes (UTF-8, as a character
of some scripts says as much as a short word) is hashed, and the hashes of all documents are
joined. The first occurrence of a span, in order of
doc_id (null last), text hash and place, stays; sentences that any other occurrence
covers are removed, be it in the same document or in another.

A sentence ends after a run of line breaks or of `.`, `!`, `?` or their like in other scripts.
One of more than MAX_WORDS words is cut where its words say so, so that a passage is cut alike
wherever it stands: after each word whose hash is less than those of the REACH words before it and
no more than those of the REACH words after it. A word of more than LONG_WORD characters, as in
scripts without spaces, counts as that many words of one character, with LONG_REACH. Where no
word is such a least one, as in "w w w", a cut follows after every MOST_WORDS-th.

Sentences are compared without white space at their ends, by 128-bit hashes. Null text
has no sentences and stays null; a text of which nothing is left is empty. Rows equal in
doc_id and text are one document and keep the same sentences. Very long texts are worked on
whole; one long sentence at a time is cut into words, at some 200 bytes a word. A text of
fewer than SPAN sentences has no span, so nothing of it is removed.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.conf import materialize

SPAN = 3
MIN_BYTES = 60
MAX_WORDS = 16
MOST_WORDS = 64
REACH = 2
LONG_WORD = 32
LONG_REACH = 12

#: Line break, full stops, exclamation and question marks of Latin, Arabic, Indic and East Asian scripts.
ENDS = ".!?\n\u0589\u061f\u06d4\u0964\u0965\u1362\u203c\u3002\uff01\uff0e\uff1f\uff61"
#: Pieces whose concatenation is the text: a sentence with what ends it, and a word with the spaces around it.
SENTENCE = re.compile(f"[^{ENDS}]+(?:[{ENDS}][\t-\r {ENDS}]*)?|[{ENDS}][\t-\r {ENDS}]*")
WORD = re.compile("[\t-\r ]*[^\t-\r ]+[\t-\r ]*")
#: White space in SQL.
SPACE = r"\t\n\u000b\u000c\r "
#: Hashes of words that a task holds, so that a frequent word is hashed once.
KNOWN_WORDS = 100_000


def sentences(text: str, known: dict[str, bytes]) -> list[str]:
    """The sentences of a text, long ones cut. `known` holds hashes of words between calls."""
    out = []
    for sentence in SENTENCE.findall(text):
        # One of MAX_WORDS short words at most needs no cut, nor one too short to have more words.
        words = WORD.findall(sentence) if len(sentence) > min(2 * MAX_WORDS, LONG_WORD) else []
        reach: list[int] = []
        if words and len(sentence) > LONG_WORD and max(map(len, words)) > LONG_WORD:
            parts = [list(w) if len(w) > LONG_WORD else [w] for w in words]
            reach = [LONG_REACH if len(w) > LONG_WORD else REACH for w, p in zip(words, parts) for _ in p]
            words = [w for p in parts for w in p]
        if len(words) <= MAX_WORDS:
            out.append(sentence)
        else:
            out.extend(_cut(words, reach or [REACH] * len(words), known))
    return out


def _cut(words: list[str], reach: list[int], known: dict[str, bytes]) -> list[str]:
    """The words of a long sentence put together between its cuts."""
    keys = []
    for w in words:
        key = known.get(w)
        if key is None:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            key = known[w] = hashlib.md5(w.strip("\t\n\x0b\f\r ").encode()).digest()[:4]
        keys.append(key)
    last = len(words) - 1
    cuts = [
        i
        for i, (before, key, after) in enumerate(zip([b"", *keys], keys, keys[1:]))
        if (i == 0 or before > key) and after >= key
        and (i < 2 or min(keys[max(0, i - reach[i]) : i]) > key) and min(keys[i + 1 : i + 1 + reach[i]]) >= key
    ]
    out, lo = [], 0
    for hi in [*cuts, last]:
        out.extend("".join(words[a : min(a + MOST_WORDS, hi + 1)]) for a in range(lo, hi + 1, MOST_WORDS))
        lo = hi + 1
    return out


def _pieces(texts: pa.Array) -> pa.Array:
    known: dict[str, bytes] = {}
    return pa.array([None if t is None else sentences(t, known) for t in texts.to_pylist()], pa.list_(pa.string()))


def cut(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, missing, pieces: the sentences of each row (stored, as several steps read them)."""
    pieces = F.arrow_udf(_pieces, "array<string>")
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.isnull("text").alias("missing"), pieces("text").alias("pieces"))
    return materialize(named, "sentence-pieces")


def spans(pieces: DataFrame, span: int = SPAN, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, text_hash, place, h1, h2: every span of each document of `cut`, by its first sentence."""
    return pieces.sparkSession.sql(
        f"""
        select doc_id, text_hash, s.place, s.h1, s.h2
        from (
          select doc_id, text_hash, explode(filter(transform(
              if(size(h1) >= {span}, sequence(0, size(h1) - {span}), cast(array() as array<int>)),
              i -> struct(i as place, xxhash64({", ".join(f"h1[i + {j}]" for j in range(span))}) as h1,
                xxhash64({", ".join(f"h2[i + {j}]" for j in range(span))}) as h2,
                {" + ".join(f"n[i + {j}]" for j in range(span))} as n)), x -> x.n >= {min_bytes})) as s
          from (
            select doc_id, text_hash, transform(t, x -> xxhash64(x)) as h1, transform(t, x -> xxhash64(1L, x)) as h2,
              transform(t, x -> octet_length(x)) as n
            from (
              select doc_id, text_hash, transform(pieces, x -> trim(both '{SPACE}' from x)) as t
              from {{cut}} where not missing)))""",
        cut=pieces,
    )


def repeated_spans(pieces: DataFrame, span: int = SPAN, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, text_hash, place, h1, h2, first: the spans of `cut` that occur more than once (stored).

    Spans are counted by one half of the hash first, with partial sums, so only what may
    repeat is moved whole; both halves decide then. `first` tells the occurrence that stays.
    The joins are null-safe, which gives the counts a shuffle of their own, so that adaptive
    execution can cut the rows of a hot span into several tasks.
    """
    every = spans(pieces, span, min_bytes)
    often = every.groupBy(F.col("h1").alias("often")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    maybe = materialize(every.join(often, F.col("h1").eqNullSafe(F.col("often")), "left_semi"), "sentence-spans")
    place = "struct(doc_id is null as unnamed, doc_id, text_hash, place)"
    firsts = maybe.groupBy(F.struct("h1", "h2").alias("span")).agg(F.expr(f"min({place})").alias("kept"), F.count(F.lit(1)).alias("n"))
    joined = maybe.join(firsts.where("n > 1"), F.struct("h1", "h2").eqNullSafe(F.col("span")))
    return joined.withColumn("first", F.expr(f"{place} <=> kept")).drop("span", "kept", "n")


def remove_repeats(docs: DataFrame, span: int = SPAN, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, n_sentences, n_removed, text for each row of `docs`; text is what stays."""
    pieces = cut(docs)
    repeats = repeated_spans(pieces, span, min_bytes).where("not first")
    covered = repeats.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))  # of one document
    return docs.sparkSession.sql(
        f"""
        select doc_id, cast(coalesce(size(pieces), 0) as bigint) as n_sentences,
          cast(coalesce(size(pieces) - size(stays), 0) as bigint) as n_removed,
          if(missing, null, array_join(stays, '')) as text
        from (
          select *, if(gone is null, pieces, transform(array_except(sequence(0, size(pieces) - 1), gone), i -> pieces[i])) as stays
          from (
            select d.doc_id, d.missing, if(d.missing, array(), d.pieces) as pieces,
              array_distinct(flatten(transform(c.places, p -> sequence(p, p + {span - 1})))) as gone
            from {{cut}} d left join {{covered}} c on d.doc_id <=> c.doc_id and d.text_hash = c.text_hash))""",
        cut=pieces,
        covered=covered,
    )
