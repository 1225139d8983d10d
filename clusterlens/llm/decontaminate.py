"""Benchmark decontamination with a generalised suffix automaton over words.

A-Z is lower-cased; words are runs of ASCII letters and digits and of all
characters beyond ASCII. A window is ``window`` consecutive words of a test
item; an item of fewer words, but not none, is one window as a whole. The
automaton holds every word sequence of the items; a document's words are
streamed through it, which gives at each word the longest match that ends
there. Every document word inside an occurrence of a window is hit.

The items are collected to build the automaton, in parts of at most about
``max_words`` words: their sizes are summed by Spark first, and a larger
benchmark is split by item into as many automata as needed, each one pass
over the documents. So what is broadcast is bounded, and nothing is left out.

Defined results: null or empty texts have no words and no hits; an item
without words never matches; an item without an id still marks words, under
the id ''; repeated items count once by id; repeated documents are answered
row by row; an empty benchmark hits nothing. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import Shared, hand_back, map_batches, staged, table, texts

WINDOW = 10
MAX_AUTOMATON_WORDS = 100_000
MAX_COVERAGE = 0.5

_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower()
              else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def words_of(text: str) -> list[bytes]:
    """The text's words in UTF-8: separators become spaces byte by byte."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences, ready for matching.

    ``window_state[s]``: the state of the last ``window`` words of a match in
    state s; ``owners``: items by that state; ``short[s]``: (length, items) of
    whole short items that end wherever s ends.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.words = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                ids = [self.words.setdefault(w, len(self.words)) for w in words]
                coded.append((item, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.least = min([window, *(len(ids) for _, ids in coded)])
        self._mark(coded)

    def _add(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(nxt)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """State for the strings of q that end here but are not longer than p's plus c."""
        clone = self._add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:                       # known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        cur = self._add(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return cur

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        n, w = len(self.length), self.window
        order = sorted(range(1, n), key=self.length.__getitem__)
        self.window_state, own = [-1] * n, {}
        for s in order:
            if self.length[s] >= w:
                up = self.link[s]
                self.window_state[s] = s if self.length[up] < w else self.window_state[up]
        owners: dict[int, set[str]] = {}
        for item, ids in coded:
            s = 0
            for i, c in enumerate(ids, 1):
                s = self.next[s][c]
                if i >= w:
                    owners.setdefault(self.window_state[s], set()).add(item)
            if len(ids) < w:
                own.setdefault((s, len(ids)), set()).add(item)
        self.owners = {s: frozenset(v) for s, v in owners.items()}
        at: dict[int, list] = {}
        for (s, m), names in own.items():
            at.setdefault(s, []).append((m, frozenset(names)))
        self.short: dict[int, list] = {}
        for s in order:                          # own ones, then those of all suffixes
            found = at.get(s, []) + self.short.get(self.link[s], [])
            if found:
                self.short[s] = found

    def match(self, words: list[bytes]) -> tuple[bytearray | None, set[str]]:
        """A mark per word (None: no hit) and the items that occur."""
        if not self.words or len(words) < self.least:
            return None, set()
        get, least = self.words.get, self.least
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        # only runs of known words, long enough for the shortest window, can match
        known = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0])).astype(np.int8)))
        marks, items = None, set()
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
            if b - a >= least:
                marks = self._run(ids[a:b].tolist(), a, len(words), marks, items)
        return marks, items

    def _run(self, ids, start, n, marks, items):
        nxt, link, length = self.next, self.link, self.length
        s = matched = 0
        for p, c in enumerate(ids, start):
            t = nxt[s].get(c)
            while t is None and s:
                s = link[s]
                matched = length[s]
                t = nxt[s].get(c)
            if t is None:
                continue
            s, matched = t, matched + 1
            covered = 0
            if matched >= self.window:
                covered = self.window
                items |= self.owners[self.window_state[s]]
            for m, names in self.short.get(s, ()):
                if m <= matched:
                    covered = max(covered, m)
                    items |= names
            if covered:
                if marks is None:
                    marks = bytearray(n)
                marks[p + 1 - covered:p + 1] = b"\x01" * covered
        return marks


def automata(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
             window: int = WINDOW, max_words: int = MAX_AUTOMATON_WORDS):
    """Yield one automaton per bounded part of the benchmark."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a word takes a character and a separator at least
    total = items.agg(F.sum(F.length("text") / 2 + 1).alias("n")).first()["n"] or 0
    parts = int(total // max_words) + 1
    for part in range(parts):
        mine = items if parts == 1 else items.where(
            F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        rows = mine.distinct().orderBy("item", "text").collect()
        yield Automaton([(r["item"], words_of(r["text"])) for r in rows], window)


def _found(auto: Shared, text_col: str):
    def make():
        automaton = auto.load()

        def run(batch: pa.RecordBatch) -> dict:
            out = {f: batch.column(f) for f in ("__row", "doc_id") if f in batch.schema.names}
            n_words, hits, found = [], [], []
            for t in texts(batch.column(text_col)):
                w = words_of(t)
                marks, items = automaton.match(w)
                n_words.append(len(w))
                hits.append(bytes(marks) if marks else None)
                found.append(sorted(items))
            return out | {"n_words": n_words, "marks": hits, "items": found}
        return run
    return make


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         window: int = WINDOW, max_words: int = MAX_AUTOMATON_WORDS) -> DataFrame:
    """doc_id, n_words, marks (a byte per word, 1: hit; null: none), items
    (their ids, sorted) for every document row."""
    spark = docs.sparkSession
    schema = "doc_id string, n_words long, marks binary, items array<string>"
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = schema.replace("doc_id string", f"doc_id {kind}")
    parts = list(automata(benchmark, window=window, max_words=max_words))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if len(parts) == 1:
        return map_batches(base, _found(Shared(spark, parts[0]), "text"),
                           schema)
    # several automata: number the rows once, run each part, merge the rows that have hits
    base = staged(base.withColumn("__row", F.monotonically_increasing_id()), "decontaminate-rows")
    total = None
    for a in parts:
        one = map_batches(base, _found(Shared(spark, a), "text"),
                          "__row long, " + schema)
        total = one if total is None else total.unionByName(one)

    def either(rows):
        for frame in rows:
            out = {k: frame[k].iloc[0] for k in ("__row", "doc_id", "n_words")}
            marks = [np.frombuffer(m, np.uint8) for m in frame["marks"] if m is not None]
            out["marks"] = np.bitwise_or.reduce(marks).tobytes() if marks else None
            out["items"] = sorted({i for x in frame["items"] for i in x})
            yield out

    def merge(key, frame):
        import pandas as pd
        return pd.DataFrame(list(either([frame])))

    hit = total.where(F.col("marks").isNotNull())     # a few rows per hit document at most
    merged = hit.groupBy("__row").applyInPandas(merge, "__row long, " + schema)
    clean = base.select("__row", F.col("doc_id").alias("d")).join(
        merged.select("__row", "marks", "items"), "__row", "left")
    sizes = map_batches(base, _found(Shared(spark, Automaton([], window)),
                                     "text"), "__row long, " + schema).select("__row", "n_words")
    return clean.join(sizes, "__row").select(
        F.col("d").alias("doc_id"), "n_words", "marks",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def cut(text: str, automata_: list[Automaton], max_coverage: float) -> str | None:
    """``text`` without its hit words and what stands between two of them;
    None when more than ``max_coverage`` of the words are hit.

    Repeated until nothing is hit, as the cut joins what stood apart.
    """
    first = True
    while True:
        spans = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
        words = words_of(text)
        marks = np.zeros(len(words), bool)
        for a in automata_:
            m, _ = a.match(words)
            if m:
                marks |= np.frombuffer(m, np.uint8).astype(bool)
        if not marks.any():
            return text
        if first and marks.mean() > max_coverage:
            return None
        first = False
        edges = np.flatnonzero(np.diff(np.concatenate(([0], marks, [0])).astype(np.int8)))
        kept, at = [], 0
        for a, b in zip(edges[::2], edges[1::2]):
            kept.append(text[at:spans[a][0]])
            at = spans[b - 1][1]
        text = "\n".join(kept + [text[at:]])


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                    window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                    max_words: int = MAX_AUTOMATON_WORDS) -> DataFrame:
    """The documents without their hit spans; documents of which more than
    ``max_coverage`` is hit go. ``n_chars`` follows where a text changed."""
    spark = docs.sparkSession
    parts = [Shared(spark, a)
             for a in automata(benchmark, window=window, max_words=max_words)]
    schema = docs.schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    at, chars = arrow.get_field_index(text), arrow.get_field_index("n_chars")

    def run(batches):
        loaded = [p.load() for p in parts]
        for batch in batches:
            new, changed, keep = [], {}, []
            for i, value in enumerate(batch.column(at)):
                old = value.as_py()
                t = old if not old else cut(old, loaded, max_coverage)
                keep.append(t is not None or old is None)
                new.append(t)
                if t != old and t is not None:
                    changed[i] = len(t)
            cols = list(batch.columns)
            if changed or not all(keep):
                cols[at] = pa.array(new, type=arrow.field(at).type)
                if changed and chars >= 0 and pa.types.is_integer(arrow.field(chars).type):
                    n = cols[chars].to_pylist()
                    for i, v in changed.items():
                        n[i] = v
                    cols[chars] = pa.array(n, type=arrow.field(chars).type)
                batch = pa.RecordBatch.from_arrays(cols, schema=arrow).filter(pa.array(keep))
            yield batch
        loaded.clear()
        hand_back()

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.when(F.col("marks").isNull(), 0).otherwise(
        F.length(F.regexp_replace(F.hex("marks"), "00|0(?=1)", "")))
    return found.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        F.col("marks").isNotNull().alias("contaminated"))


# the same result in DuckDB
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM (
    SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)
), hit AS (
  SELECT rid, i, dw.m, item_id FROM dw JOIN win ON dw.win = win.win AND dw.m = win.m
), pos AS (
  SELECT rid, count(*) AS n_hit FROM (
    SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM hit))
  GROUP BY rid
), its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.rid = pos.rid LEFT JOIN its ON d.rid = its.rid
"""
