"""Phrase collocations of 2 to 4 words by top-order marginalisation.

Every word of a piece leads one window: itself and the next three words, padded
with '' past the end of the piece. Only these longest windows are counted; a
Spark ROLLUP over (lang, w1, w2, w3, w4) then sums the ever shorter prefixes:
a phrase occurs as often as windows begin with it, and the windows of a language
are its words. No n-gram of a lower order is ever exploded.

Most windows can be of no use: a phrase seen 30 times is made of pairs and
triples seen 30 times. So words and pairs, then triples of pairs that passed,
are first counted by hash, in saturating one-byte counters of a table sized by
the corpus (a bucket counts at least what falls into it); a window is cut
(padded) where its next pair or triple stays below the support, and its first
word is '' where that word does. No phrase with the support loses an occurrence,
and the words of a language still add up. The filter is two bits a bucket, at
most ``2**MOST_BITS`` buckets; beyond that it only cuts less.

Tokens are cut out of whole texts by byte masks over an Arrow column; a very
long text is one block of its own. Phrases travel as dictionary words. Counts
are compared and scored as decimals.

Defined results: a null text is empty, a null lang is 'und'; repeated rows count
again; an empty table gives no rows. Words keep their bytes but for A-Z, so
other white space belongs to words. Ties in rank go by count, then by phrase in
UTF-8 byte order. Only text and lang are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import staged, table

ORDER = 4                   # words of the longest window
SUPPORT = 30
SCORE = 2_000_000
COVER_OF, COVER = 100, 80   # dropped if 100 f(longer) >= 80 f(phrase)
TOP = 2_000
BLOCK = 8 << 20             # bytes of text looked at together
BUCKETS_A_BYTE = 0.25       # hash counters by size of the corpus
LEAST_BITS, MOST_BITS = 16, 30
SLICE_BITS = 16             # counters that travel together
SALTS = 64
WORDS = tuple(f"w{i + 1}" for i in range(ORDER))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: ends a piece; ends a word; in lower case."""
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A"):ord("Z") + 1] += 32
    cut = np.zeros(256, bool)
    cut[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
    gap = cut.copy()
    gap[[0x20, 0x09]] = True
    return cut, gap, lower


class Tokens:
    """The words of some texts: ``vocabulary`` (Arrow strings), ``code`` per word
    occurrence, ``last`` (the word ends its piece) and ``doc`` (row it is in)."""

    def __init__(self, column: pa.Array):
        cut, gap, lower = _tables()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = lower[np.frombuffer(column.buffers()[2] or b"", np.uint8)[starts[0]:starts[-1]]]
        starts = starts - starts[0]
        word = ~gap[data]
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a text border inside a run of word bytes parts it
        inner = starts[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(data))])
        inner = inner[word[inner] & word[inner - 1]] if len(inner) else inner
        if len(inner):
            first, end = np.sort(np.concatenate((first, inner))), np.sort(np.concatenate((end, inner)))
        size = end - first
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
        strings = pa.LargeStringArray.from_buffers(
            len(size), pa.py_buffer(offsets), pa.py_buffer(data[word].tobytes()))
        coded = strings.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.doc = np.searchsorted(starts, first, side="right") - 1
        marks = np.flatnonzero(cut[data])
        piece = np.searchsorted(marks, first)       # cuts before the word
        self.last = np.ones(len(first), bool)
        self.last[:-1] = (piece[1:] != piece[:-1]) | (self.doc[1:] != self.doc[:-1])


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(lang, text) of a batch in runs of rows of about ``BLOCK`` bytes."""
    lang, text = batch.column(0), batch.column(1)
    size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)) // BLOCK
    at = np.concatenate((np.flatnonzero(np.diff(size, prepend=-1)), [len(size)])) if len(size) else []
    for lo, hi in zip(at[:-1], at[1:]):
        yield lang[lo:hi], text[lo:hi]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Hashed:
    """Hash buckets of the words, pairs and triples of pieces, each within its
    language. ``pair[i]`` and ``triple[i]`` start at word ``pairs[i]``, ``triples[i]``."""

    def __init__(self, tokens: Tokens, lang: pa.Array, bits: int):
        from xxhash import xxh3_64_intdigest
        own = np.array([xxh3_64_intdigest(w) for w in tokens.vocabulary.cast(pa.large_binary()).to_pylist()],
                       dtype=np.uint64)[tokens.code]
        langs = lang.dictionary_encode()
        by_lang = np.array([xxh3_64_intdigest(w.encode()) for w in langs.dictionary.to_pylist()], np.uint64)
        where = langs.indices.to_numpy(zero_copy_only=False)[tokens.doc]
        shift = np.uint64(64 - bits)
        follows = ~tokens.last
        with np.errstate(over="ignore"):
            word = mixed(own + by_lang[where])
            self.pairs = np.flatnonzero(follows)
            pair = mixed(mixed(word[self.pairs] + np.uint64(0x5851F42D4C957F2D)) + own[self.pairs + 1])
            inner = follows[self.pairs + 1]
            self.triples = self.pairs[inner]
            triple = mixed(mixed(pair[inner] + np.uint64(0x14057B7EF767814F)) + own[self.triples + 2])
        self.word, self.pair, self.triple = ((h >> shift).astype(np.int64) for h in (word, pair, triple))


class Filter:
    """Which words, pairs and triples may have the support: one bit a bucket.
    ``triples`` is None as long as they are not counted."""

    def __init__(self, bits: int, short: np.ndarray, triples: np.ndarray | None = None):
        self.bits, self.short, self.triples = bits, short, triples

    def links(self, t: Tokens, h: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word: may it, the pair and the triple it starts have the support?"""
        size = len(t.code)
        word = _bit(self.short, h.word)
        pair, triple = np.zeros(size, bool), np.zeros(size, bool)
        pair[h.pairs] = _bit(self.short, h.pair)
        at = pair[h.triples] & pair[h.triples + 1]
        if self.triples is not None:
            at[at] = _bit(self.triples, h.triple[at])
        triple[h.triples[at]] = True
        return word, pair, triple


def _bit(table_: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (table_[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1


def _named(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).alias("text"))


def _bits(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(np.clip(np.ceil(np.log2(max(size, 1) * BUCKETS_A_BYTE)), LEAST_BITS, MOST_BITS))


def frequent_buckets(docs: DataFrame, support: int, bits: int,
                     items: Callable[[Tokens, pa.Array], np.ndarray]) -> np.ndarray:
    """One bit per hash bucket: may what falls into it reach ``support``?

    ``items`` gives the buckets that some texts fill. Counters saturate at the
    support (at most 255), so adding them up in any order gives the same bits."""
    width, full = 1 << SLICE_BITS, min(support, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in blocks(batch):
                bucket, n = np.unique(items(Tokens(text), lang), return_counts=True)
                n = np.minimum(n, full).astype(np.uint8)
                part, at = np.unique(bucket >> SLICE_BITS, return_index=True)
                at = np.append(at, len(bucket))
                low = (bucket & (width - 1)).astype(np.uint16)
                for lo in range(0, len(part), 4_096):
                    some = range(lo, min(lo + 4_096, len(part)))
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(part[lo:lo + 4_096], pa.int32()),
                        "low": pa.array([low[at[i]:at[i + 1]].tobytes() for i in some], pa.binary()),
                        "n": pa.array([n[at[i]:at[i + 1]].tobytes() for i in some], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, low, n in zip(*(c.to_pylist() for c in batch.columns)):
                mine = counters.setdefault(part, np.zeros(width, np.uint8))
                low, n = np.frombuffer(low, np.uint16), np.frombuffer(n, np.uint8)
                mine[low] = np.minimum(mine[low].astype(np.uint16) + n, full).astype(np.uint8)
        for part, mine in counters.items():
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()),
                "bits": pa.array([np.packbits(mine >= full).tobytes()], pa.binary())})

    parts = (docs.mapInArrow(count, "part int, low binary, n binary").repartition("part")
             .mapInArrow(merge, "part int, bits binary").toArrow().to_pylist())
    out = np.zeros((1 << bits) // 8, np.uint8)
    for p in parts:
        at = p["part"] * (width // 8)
        out[at:at + width // 8] = np.frombuffer(p["bits"], np.uint8)
    return out


def support_filter(docs: DataFrame, support: int) -> Callable[[], Filter]:
    """The filter of words, pairs and triples, as something a task can load."""
    context, bits = docs.sparkSession.sparkContext, _bits(docs)

    def short(t: Tokens, lang: pa.Array) -> np.ndarray:
        h = Hashed(t, lang, bits)
        return np.concatenate((h.word, h.pair))
    first = context.broadcast(frequent_buckets(docs, support, bits, short).tobytes())

    # only triples of two pairs that passed are counted
    def long(t: Tokens, lang: pa.Array) -> np.ndarray:
        h = Hashed(t, lang, bits)
        at = Filter(bits, np.frombuffer(first.value, np.uint8)).links(t, h)[2]
        return h.triple[at[h.triples]]
    second = context.broadcast(frequent_buckets(docs, support, bits, long).tobytes())
    return lambda: Filter(bits, np.frombuffer(first.value, np.uint8), np.frombuffer(second.value, np.uint8))


def window_counts(lang: pa.Array, text: pa.Array, known: Filter | None) -> pa.RecordBatch | None:
    """(lang, w1..w4, n): the padded longest windows of some texts, counted."""
    t = Tokens(text)
    size = len(t.code)
    if not size:
        return None
    none = len(t.vocabulary)                       # code of the padding
    langs = lang.dictionary_encode()
    where = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[t.doc]
    if known is not None:
        word, pair, triple = known.links(t, Hashed(t, lang, known.bits))
    else:
        word, pair = np.ones(size, bool), ~t.last
        triple = pair & np.append(pair[1:], False)
    lead = np.where(word, t.code, none)
    # lead columns: the word so many places on, while every link up to it holds
    opens = [word & pair, word & triple, word & triple & np.append(triple[1:], False)]
    columns = [lead]
    for step, open_ in enumerate(opens, 1):
        ahead = np.full(size, none, np.int64)
        ahead[:max(size - step, 0)] = t.code[step:]
        columns.append(np.where(open_, ahead, none))
    # windows are told apart by two joined numbers, made dense in turn
    base = none + 1
    key = where * base + columns[0]
    for column in columns[1:]:
        if key.max() >= 2 ** 62 // base:
            key = np.unique(key, return_inverse=True)[1]
        key = key * base + column
    _u, first, n = np.unique(key, return_index=True, return_counts=True)
    words = pa.concat_arrays([t.vocabulary, pa.array([""], t.vocabulary.type)]).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(where[first])).cast(pa.string())]
        + [words.take(pa.array(c[first])) for c in columns] + [pa.array(n, pa.int64())],
        ["lang", *WORDS, "n"])


def windows(docs: DataFrame, support: int = SUPPORT, filtered: bool = True) -> DataFrame:
    """Padded longest windows and how often each occurs; (lang, w1..w4, n)."""
    load = support_filter(docs, support) if filtered else lambda: None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        for batch in batches:
            for lang, text in blocks(batch):
                out = window_counts(lang, text, known)
                if out is not None:
                    yield out
    schema = ", ".join(["lang string", *(f"{w} string" for w in WORDS), "n long"])
    return docs.mapInArrow(run, schema).groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, support: int = SUPPORT, text: str = "text", lang: str = "lang",
                  filtered: bool = True) -> DataFrame:
    """(lang, words array, f) of every phrase of up to 4 words with the support,
    and, with an empty array, the number of words of each language."""
    counted = windows(_named(docs, text, lang), support, filtered)
    rolled = (counted.rollup("lang", *WORDS)
              .agg(F.sum("n").alias("f"), F.grouping_id().alias("g")))
    # grouping_id: its low bits tell how many of the last columns are summed over
    length = F.lit(ORDER)
    for k in range(ORDER):
        length = F.when(F.col("g") == 2 ** (ORDER - k) - 1, F.lit(k)).otherwise(length)
    rolled = rolled.where(F.col("g") < 2 ** ORDER).withColumn("k", length)
    whole = F.col("k") == 0
    for k in range(1, ORDER + 1):
        whole |= (F.col("k") == k) & (F.col(WORDS[k - 1]) != "")
    return (rolled.where(whole & ((F.col("f") >= support) | (F.col("k") == 0)))
            .select("lang", F.slice(F.array(*WORDS), 1, F.col("k")).alias("words"), "f"))


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest_f): for words inside longer candidates, the most
    that one of those occurs."""
    inside = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1),
                              lambda i: F.array_join(F.slice("words", i, m), " "))))
    return (phrases.where(F.size("words") > 2)
            .select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longest_f")))


def collocations(docs: DataFrame, top: int = TOP, support: int = SUPPORT, text: str = "text",
                 lang: str = "lang", filtered: bool = True) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    counts = staged(phrase_counts(docs, support, text, lang, filtered), "collocations")
    known = counts.where(F.size("words") > 0).select(
        "lang", "words", F.array_join("words", " ").alias("phrase"), "f")
    candidates = known.where(F.size("words") > 1)
    cuts = (candidates.select("lang", "phrase", "words", F.col("f").alias("a"),
                              F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
            .withColumn("head", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
            .withColumn("tail", F.array_join(F.expr("slice(words, k + 1, size(words))"), " "))
            .drop("words"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # every part of a phrase with the support has it too, so both joins find all
    scored = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
              .withColumn("score", F.expr(
                  f"({SCORE} * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)").cast("long")))
    lowest = (scored.groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
              .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"))
    kept = (lowest.join(covered(candidates), ["lang", "phrase"], "left")
            .where(F.col("longest_f").isNull()
                   | (COVER_OF * _exact("longest_f") < COVER * _exact("a"))).drop("longest_f"))
    # ranked in salted groups first: no language passes whole through one task
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))
    totals = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return (best.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
led AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM listed WHERE len(w) > 0),
grams AS (
  SELECT lang, w[i:i + k - 1] AS words, count(*) AS f
  FROM led, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
known AS (
  SELECT lang, words, array_to_string(words, ' ') AS phrase, f FROM grams WHERE f >= 30),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE len(words) = 1 GROUP BY lang),
cuts AS (
  SELECT lang, phrase, words, f AS a, unnest(generate_series(1, len(words) - 1)) AS k
  FROM known WHERE len(words) > 1),
scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, c.k, h.f AS l, t.f AS r,
         ((2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f))::BIGINT AS score
  FROM cuts c JOIN known h ON h.lang = c.lang AND h.words = c.words[1:c.k]
  JOIN known t ON t.lang = c.lang AND t.words = c.words[c.k + 1:len(c.words)]),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT k.lang, array_to_string(k.words[s.i:s.i + s.m - 1], ' ') AS phrase, max(k.f) AS longest
  FROM known k, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) AS s(i, m)
  WHERE s.m < len(k.words) AND s.i + s.m - 1 <= len(k.words) GROUP BY ALL),
kept AS (
  SELECT x.* FROM lowest x LEFT JOIN inside i ON i.lang = x.lang AND i.phrase = x.phrase
  WHERE i.longest IS NULL OR 100::HUGEINT * i.longest < 80::HUGEINT * x.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT kept.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000
"""
