"""Near-duplicate classes by Order MinHash and banded alignment.

Words are the lower-cased ASCII letter-and-digit runs with all characters
beyond ASCII (texts without any: the pieces between white space). For each of
``functions`` hash functions, the ``picks`` least occurrence-labelled k-mers
of ``K`` words are kept in text order: two texts agree on such an ordered
sketch when they share the k-mers and their order, as texts at a small edit
distance do. Texts that agree on a sketch are candidates; a candidate pair is
linked if 1 - (edits of words) / (words of the longer text) is ``similarity``
or more, found by alignment within the band that this allows. A class is a
connected component of links; its id is the least doc_id in it.

Equal word sequences count as one text, and every text is compared with the
least text of each bucket (a star), so texts are not read once for every pair
of a group. Edits of words are a metric, which settles most other pairs exactly: a
text at distance d from the centre cannot be similar to one at distance e of
it if d - e exceeds what similarity allows. So a text that is not similar to
the centre meets two linked texts and, if still apart from them, those linked
texts that this leaves open; and it meets all other texts of the bucket that
are not. Lengths and word counters rule most of these pairs out, exactly,
before any text is read. Where more than ``PAIRWISE`` such texts share a bucket
(a passage that many different texts have), they are dealt into blocks and
every two blocks are compared by arrays (``_tiled``); the pairs that stay open are
aligned group by group, so a text makes a row per block or group, not per pair.
There is no cap: every pair that agrees on a sketch is linked, in one class
already, ruled out exactly or aligned. Links, components and sketches stay
distributed; each round is written to the shared folder.

Defined results: rows of one doc_id are one document and share a class; texts
with no words are grouped only if equal (null counts as empty); a row without
a doc_id has the class of its text's other rows, or none; an empty table gives
an empty result. Only doc_id (an integer) and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.common import map_batches, staged, table, texts
from clusterlens.llm.decontaminate import words_of

K = 5
SIMILARITY = 0.8
FUNCTIONS = 48
PICKS = 2
FIRST = 4           # functions whose buckets are compared first
COUNTERS = 128      # word counters of a text, to rule pairs out before reading texts
PAIRWISE = 32       # more texts of a bucket that are not similar to its centre are tiled
TILE = 1024         # texts of a block, about
FINE = 16           # finer counters for each counter, for texts of large buckets
PAIRS = 4096        # open pairs that are aligned in one group, about
MAX_WORD_CACHE = 150_000
MAX_WORDS_HELD = 500_000    # words of texts that an aligning task keeps split

_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, on arrays of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tokens(text: str) -> list[bytes]:
    return words_of(text) or text.lower().encode("utf-8", "surrogatepass").split()


class Sketcher:
    def __init__(self, functions: int = FUNCTIONS, picks: int = PICKS, k: int = K):
        self.functions, self.picks, self.k = functions, picks, k
        seeds = _mix(np.arange(1, 2 * functions + 1, dtype=np.uint64)
                     * np.uint64(0x9E3779B97F4A7C15))
        self.add, self.times = seeds[:functions, None], seeds[functions:, None] | np.uint64(1)
        self.powers = _mix(np.arange(101, 101 + k, dtype=np.uint64)) | np.uint64(1)
        self.known: dict[bytes, int] = {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest
        known = self.known
        if len(known) > MAX_WORD_CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def counters(self, words: list[bytes]) -> np.ndarray:
        """Words per counter: two texts share at most the sum of the lesser
        counts, and every word beyond that is an edit."""
        at = (self.word_hashes(words) >> np.uint64(20)) % np.uint64(COUNTERS)
        return np.bincount(at.astype(np.int64), minlength=COUNTERS).astype(np.int32)

    def fine_counters(self, words: list[bytes]) -> tuple[bytes, int]:
        """``FINE`` * ``COUNTERS`` counters of a byte, and the words beyond 255
        that these cannot count."""
        n = FINE * COUNTERS
        at = (self.word_hashes(words) >> np.uint64(20)) % np.uint64(n)
        count = np.bincount(at.astype(np.int64), minlength=n)
        held = np.minimum(count, 255)
        return held.astype(np.uint8).tobytes(), int((count - held).sum())

    def kmers(self, words: list[bytes]) -> np.ndarray:
        """Hash of every k-mer with its occurrence number; a shorter text is one."""
        h = self.word_hashes(words)
        k = min(self.k, len(h))
        n = len(h) - k + 1
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += h[j:j + n] * self.powers[j]
        order = np.argsort(total, kind="stable")
        ranked = total[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        if not new.all():
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            occurrence = np.empty(n, np.uint64)
            occurrence[order] = np.arange(n) - first
            total += occurrence * np.uint64(0xD6E8FEB86659FD93)
        return _mix(total)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """One number per function: its ordered picks, hashed."""
        base = self.kmers(words)
        n, out = len(base), np.empty(self.functions, np.uint64)
        step = max(1, (1 << 20) // n)           # functions at a time
        for a in range(0, self.functions, step):
            b = min(a + step, self.functions)
            h = (base[None, :] ^ self.add[a:b]) * self.times[a:b]
            h ^= h >> np.uint64(32)
            rows, at = np.arange(b - a), []
            for _ in range(min(self.picks, n)):
                best = h.argmin(axis=1)
                at.append(best)
                h[rows, best] = np.uint64(_MASK)
            key = np.arange(a, b, dtype=np.uint64) + np.uint64(7)
            for p in np.sort(np.column_stack(at), axis=1).T:
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + base[p])
            out[a:b] = key
        return out.view(np.int64)


def edits_within(a: list, b: list, limit: int) -> int | None:
    """Edit distance of two sequences if it is at most ``limit``, else None.

    Bit-parallel alignment within a band: bit i of the window stands for row
    column + i - band; the vertical steps move down a row with every column.
    The band doubles until the distance fits into it.
    """
    if len(a) < len(b):
        a, b = b, a
    skew = len(a) - len(b)
    if skew > limit:
        return None
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    m = 0
    while m < len(b) - n and a[-1 - m] == b[-1 - m]:
        m += 1
    a, b = a[n:len(a) - m], b[n:len(b) - m]
    if not b:
        return len(a)
    # words that the other side lacks need an edit each
    count: dict = {}
    for x in a:
        count[x] = count.get(x, 0) + 1
    shared = 0
    for x in b:
        if count.get(x, 0) > 0:
            count[x] -= 1
            shared += 1
    if len(a) - shared > limit:
        return None
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    band = max(skew, 16)
    while True:
        band = min(max(band, skew), max(limit, 1))
        found = _banded(places, b, skew, band)
        if found <= band:
            return found if found <= limit else None
        if band >= limit:
            return None
        band *= 2


def _banded(places: dict, b: list, skew: int, band: int) -> int:
    width = 2 * band + 1
    mask, top, at = (1 << width) - 1, 1 << (width - 1), band + skew
    plus, minus = mask ^ ((1 << (band + 1)) - 1), 0      # rows from 1 on rise by one
    score = skew
    for j, x in enumerate(b):
        plus, minus = (plus >> 1) | top, minus >> 1
        p = places.get(x, 0)
        if p:
            p = (p >> (j - band) if j >= band else p << (band - j)) & mask
        same = ((((p & plus) + plus) ^ plus) | p | minus) & mask
        rise = minus | (mask ^ ((same | plus) & mask))
        fall = same & plus
        score += not (same >> at) & 1
        rise = ((rise << 1) | 1) & mask
        plus = ((fall << 1) & mask) | (mask ^ (same | rise))
        minus = rise & same
    return score


def distance(a: list[bytes], b: list[bytes], similarity: float = SIMILARITY,
             reach: int = 1) -> tuple[int, bool]:
    """Edits between two texts (beyond ``reach`` times the allowed number, a
    lower bound) and whether they are similar."""
    allowed = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    edits = edits_within(a, b, reach * allowed)
    return (reach * allowed + 1, False) if edits is None else (edits, edits <= allowed)


def similar(a: list[bytes], b: list[bytes], similarity: float = SIMILARITY) -> bool:
    return distance(a, b, similarity)[1]


def _sketches(docs: DataFrame, functions: int, picks: int, k: int) -> DataFrame:
    def make():
        sketch = Sketcher(functions, picks, k)      # a task's own: its hashed words go with it

        def run(batch: pa.RecordBatch) -> dict:
            content, n, values, counts = [], [], [], []
            for t in texts(batch.column(1)):
                w = tokens(t)
                content.append(content_of(w, t))
                n.append(len(w))
                values.append(sketch(w) if w else None)
                counts.append(sketch.counters(w) if w else None)
            return {"doc_id": batch.column(0), "content": content, "n_words": n,
                    "sketch": values, "counts": counts}
        return run

    return map_batches(docs, make,
                       "doc_id long, content string, n_words int, sketch array<long>, "
                       "counts array<int>")


def content_of(words: list[bytes], text: str) -> str:
    """What tells two texts apart: their words, or a wordless text itself."""
    from xxhash import xxh3_128_hexdigest
    return xxh3_128_hexdigest(b" ".join(words) if words else text.encode())


def _packed(docs: DataFrame, with_content: bool = False) -> DataFrame:
    """node (the doc_id) and its compressed text: a third of the bytes to shuffle."""
    def make():
        import zstandard
        press = zstandard.ZstdCompressor(level=3).compress

        def run(batch: pa.RecordBatch) -> dict:
            out = {"node": batch.column(0), "text": [
                press(t.encode("utf-8", "surrogatepass")) for t in texts(batch.column(1))]}
            if with_content:
                out["content"] = [content_of(tokens(t), t) for t in texts(batch.column(1))]
            return out
        return run
    return map_batches(docs, make, "node long, text binary" + (", content string" if with_content else ""))


def _judged(pairs: DataFrame, words: DataFrame, similarity: float, reach: int = 1) -> DataFrame:
    """Pairs (a, b) with their distance and whether they are similar."""
    a = words.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = words.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def make():
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress

        def words_in(packed: bytes) -> list[bytes]:
            return tokens(unpack(packed).decode("utf-8", "surrogatepass"))

        def run(batch: pa.RecordBatch) -> dict:
            last = wa = None
            out = {"a": batch.column(0), "b": batch.column(1), "d": [], "linked": []}
            for ta, tb in zip(batch.column(2), batch.column(3)):
                ta = ta.as_py()
                if wa is None or ta != last:
                    last, wa = ta, words_in(ta)
                d, linked = distance(wa, words_in(tb.as_py()), similarity, reach)
                out["d"].append(d)
                out["linked"].append(linked)
            return out
        return run

    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    return staged(map_batches(joined, make, "a long, b long, d int, linked boolean"),
                  "near-dedup-judged")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) by alternating stars (Kiveris et al.,
    "Connected Components in MapReduce and Beyond", 2014)."""
    both = lambda e: e.select("a", "b").unionByName(
        e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    while True:
        # every node's larger neighbours move to its least neighbour
        near = both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # every node and its smaller neighbours move to the least of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.where("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct(), "near-dedup-stars")
        # done when every node hangs on one node that hangs on none
        if (edges.groupBy("a").count().where("count > 1").isEmpty()
                and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _buckets(members: DataFrame) -> DataFrame:
    """members (key, node, n_words) of keys with two texts or more, with the
    key's size, its centre (the least node) and the centre's length."""
    sizes = (members.groupBy("key")
             .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n_words")).alias("least"))
             .where("size > 1")
             .select("key", "size", F.col("least.node").alias("centre"), F.col("least.n_words").alias("m_words")))
    return members.join(sizes, "key")


def _placed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows by node, with the node's component so far."""
    return rows.join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _named(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("node").alias("b"), F.col("component").alias("other"))


def _tiled(rest: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b, linked) among a bucket's texts (key, node, n_words, component,
    size, d, met) that lengths, components, the centre and fine word counters
    leave open. Every pair of blocks is one group, so every pair of texts meets in
    one; a pair that shares several buckets is compared in the first of them. The
    open pairs of a group are dealt into smaller groups, and a text goes once into
    each of those, not once per pair."""
    def make():
        import zstandard
        unpack, sketch = zstandard.ZstdDecompressor().decompress, Sketcher()

        def fine(batch: pa.RecordBatch) -> dict:
            found = [sketch.fine_counters(tokens(unpack(t.as_py()).decode("utf-8", "surrogatepass")))
                     for t in batch.column(1)]
            return {"node": batch.column(0), "counts": [c for c, _ in found],
                    "over": [o for _, o in found]}
        return fine

    keys = rest.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    words = staged(words.select("node", "text").join(keys.select("node"), "node", "left_semi")
                   .dropDuplicates(["node"]), "near-dedup-open-texts")
    fine = map_batches(words, make, "node long, counts binary, over long")
    rest = rest.join(staged(fine.join(keys, "node"), "near-dedup-counters"), "node")
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    tiles = (rest.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "t").alias("i"), F.greatest("block", "t").alias("j"),
                     "block", "node", "n_words", "component", "d", "met", "counts", "over", "keys"))
    dealt, tasks = PAIRS, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def open_pairs(rows: pa.Table) -> pa.Table:
        n = rows["n_words"].to_numpy()
        order = np.argsort(n, kind="stable")
        n, node, block, component, over, d, met = (rows[c].to_numpy()[order] for c in (
            "n_words", "node", "block", "component", "over", "d", "met"))
        fine = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8).reshape(len(n), -1)[order]
        coarse = fine.reshape(len(n), FINE, COUNTERS).sum(axis=1, dtype=np.int32)
        key, i, j = (rows[c][0].as_py() for c in ("key", "i", "j"))
        held = rows["keys"].combine_chunks().take(pa.array(order))
        before = [{k for k in own if k < key} for own in held.to_pylist()]
        longest = np.searchsorted(n, (n + 1e-6) / similarity, "right")
        a, b = [], []
        for p in range(len(n)):
            q = np.arange(p + 1, longest[p])
            q = q[(component[q] != component[p]) & ((i == j) | (block[q] != block[p])) & ~(met[q] & met[p])]
            # edits are a metric: what is far from the centre is far from its links
            far = np.where(met[q], d[p] - d[q], np.where(met[p], d[q] - d[p], 0))
            q = q[far <= n[q] * (1 - similarity) + 1e-6]
            # texts share at most the sum of the lesser counts
            for counts in (coarse, fine):
                shared = np.minimum(counts[q], counts[p]).sum(axis=1, dtype=np.int64)
                q = q[shared + np.minimum(over[q], over[p]) >= n[q] * similarity - 1e-6]
            q = [x for x in q.tolist() if before[p].isdisjoint(before[x])]
            a += [p] * len(q)
            b += q
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        # open pairs in square groups of texts, each text with its partners there
        parts = max(1, int(np.ceil(np.sqrt(len(a) / dealt))))
        part = np.arange(len(n)) % parts
        out = {"key": [], "group": [], "node": [], "others": []}
        group = part[a] * parts + part[b]
        for g in np.unique(group).tolist():
            pa_, pb = a[group == g], b[group == g]
            for x in np.unique(np.concatenate((pa_, pb))).tolist():
                out["node"].append(int(node[x]))
                out["others"].append(node[pb[pa_ == x]])
                out["group"].append(g)
        out["key"] = [f"{key} {i} {j}"] * len(out["node"])
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (
            pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())))})

    def align(rows: pa.Table) -> pa.Table:
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        packed = dict(zip(rows["node"].to_pylist(), rows["text"].to_pylist()))
        known: dict[int, list[bytes]] = {}
        words_held = 0

        def words_in(x: int) -> list[bytes]:
            nonlocal words_held
            if x not in known:
                if words_held > MAX_WORDS_HELD:
                    known.clear()
                    words_held = 0
                known[x] = tokens(unpack(packed[x]).decode("utf-8", "surrogatepass"))
                words_held += len(known[x])
            return known[x]

        root = {x: x for x in packed}

        def root_of(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        a, b = [], []
        for x, others in zip(rows["node"].to_pylist(), rows["others"].to_pylist()):
            wx = words_in(x) if others else None
            for y in others:
                # links join whole classes: a pair in one already adds nothing
                if root_of(x) != root_of(y) and similar(wx, words_in(y), similarity):
                    root[root_of(x)] = root_of(y)
                    a.append(min(x, y))
                    b.append(max(x, y))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                         "linked": pa.array([True] * len(a), pa.bool_())})

    # few bytes and much work: a given number of tasks is not merged into fewer
    found = staged(tiles.repartition(tasks, "key", "i", "j").groupBy("key", "i", "j").applyInArrow(
        open_pairs, "key string, group long, node long, others array<long>"), "near-dedup-pairs")
    return staged(found.join(words, "node").repartition(tasks, "key", "group").groupBy("key", "group")
                  .applyInArrow(align, "a long, b long, linked boolean"), "near-dedup-tiled")


def links(nodes: DataFrame, words: DataFrame, buckets: DataFrame,
          similarity: float = SIMILARITY) -> DataFrame:
    """node, component for all nodes that have a link."""
    allowed = 1 - similarity
    near = F.least("n_words", "m_words") >= F.greatest("n_words", "m_words") * similarity - 1e-6
    classes = None

    def link(judged: DataFrame) -> None:
        """Add links; the components so far stand for all links before."""
        nonlocal classes
        new = judged.where("linked").select("a", "b")
        if classes is not None:
            if new.isEmpty():
                return
            new = new.unionByName(classes.select(F.col("node").alias("a"), F.col("component").alias("b")))
        classes = components(new)

    # a few functions unite most groups; buckets within one component are done
    star = buckets.where((F.col("fn") < FIRST) & (F.col("node") != F.col("centre")))
    link(_judged(star.where(near).select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), words, similarity))
    apart = (_placed(buckets, classes).groupBy("key")
             .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("key"))
    buckets = staged(buckets.join(apart, "key", "left_semi"), "near-dedup-buckets")

    star = buckets.where("node <> centre")
    judged = _judged(star.where(near).select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), words, similarity, reach=2)
    link(judged)
    star = star.join(judged.withColumnsRenamed({"a": "centre", "b": "node"}),
                     ["centre", "node"], "left")
    # texts of other lengths were not compared: the difference is a lower bound
    star = star.select(
        "key", "fn", "node", "n_words",
        F.coalesce("d", F.abs(F.col("n_words") - F.col("m_words"))).alias("d"),
        F.coalesce("linked", F.lit(False)).alias("linked"))
    star = staged(star, "near-dedup-star")
    yes = star.where("linked").select(
        "key", F.col("node").alias("b"), F.col("n_words").alias("m_words"), F.col("d").alias("e"))
    reach = yes.groupBy("key").agg(
        F.max("e").alias("e_max"), F.max("m_words").alias("m_max"),
        F.max_by("b", "e").alias("far"), F.min_by("b", F.xxhash64("b")).alias("any"))
    open_ = staged(
        star.where("not linked").join(reach, "key")
        .where(F.col("d") <= F.col("e_max") + F.greatest("m_max", "n_words") * allowed + 1e-6),
        "near-dedup-open")
    # two linked texts of the bucket first: they settle nearly all of these
    two = _placed(open_, classes).select("node", "component", F.explode(F.array("far", "any")).alias("b"))
    two = two.join(_named(classes), "b", "left").where(
        F.coalesce("other", "b") != F.col("component"))
    link(_judged(two.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
                 .distinct(), words, similarity))
    # left are the texts that are not linked to the centre, among each other, and the
    # open ones with the linked ones, which are of the centre's component
    placed = staged(_placed(star.join(open_.select("key", "node", F.lit(True).alias("open")),
                                      ["key", "node"], "left"), classes), "near-dedup-placed")
    part = {"no": ~F.col("linked"), "yes": F.col("linked"), "open": F.col("open")}
    facts = placed.groupBy("key").agg(
        *(f(F.when(part[c], F.col("component"))).alias(f"{c}_{n}")
          for c in part for f, n in ((F.min, "lo"), (F.max, "hi"))),
        F.min(F.when(part["open"], F.col("d"))).alias("d_least"),
        F.max(F.when(part["open"], F.col("n_words"))).alias("n_most"))
    facts = facts.select(
        "key", "d_least", "n_most", "yes_lo", (F.col("no_lo") < F.col("no_hi")).alias("among"),
        F.coalesce((F.col("open_lo") != F.col("yes_lo")) | (F.col("open_hi") != F.col("yes_lo")),
                   F.lit(False)).alias("across")).where("among or across")
    rest = placed.join(facts, "key").where(F.when(
        F.col("linked"), F.col("across") & (
            F.col("d") + F.greatest("n_words", "n_most") * allowed + 1e-6 >= F.col("d_least")))
        .otherwise(F.col("among") | (F.coalesce("open", F.lit(False)) & (F.col("component") != F.col("yes_lo")))))
    rest = staged(rest.select("key", "node", "n_words", "component", "d", F.col("linked").alias("met")),
                  "near-dedup-rest")
    sizes = rest.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rest = staged(rest.join(sizes, "key"), "near-dedup-sized")
    few = rest.where(F.col("size") <= PAIRWISE).join(nodes.select("node", "counts"), "node")
    other = few.select("key", F.col("node").alias("b"), F.col("n_words").alias("m_words"),
                       F.col("component").alias("other"), F.col("counts").alias("m_counts"),
                       F.col("d").alias("e"), F.col("met").alias("m_met"))
    shared = F.aggregate(F.zip_with("counts", "m_counts", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
    longer = F.greatest("n_words", "m_words")
    far = F.when(F.col("m_met"), F.col("d") - F.col("e")).when(F.col("met"), F.col("e") - F.col("d")).otherwise(0)
    among = (few.join(other, "key")
             .where((F.col("node") < F.col("b")) & (F.col("component") != F.col("other")) & near
                    & ~(F.col("met") & F.col("m_met")) & (far <= longer * allowed + 1e-6)
                    & (shared >= longer * similarity - 1e-6))
             .select(F.col("node").alias("a"), "b"))
    tiled = _tiled(rest.where(F.col("size") > PAIRWISE), words, similarity)
    link(_judged(among.distinct(), words, similarity).select("a", "b", "linked").unionByName(tiled))
    return classes


    return classes


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            similarity: float = SIMILARITY, functions: int = FUNCTIONS,
            picks: int = PICKS, k: int = K) -> DataFrame:
    """doc_id and class_id, a row per document row."""
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = staged(_sketches(base, functions, picks, k), "near-dedup-sketches")
    # one node per word sequence, named by the least doc_id that has it
    owner = staged(sketched.where("doc_id is not null").groupBy("content")
                   .agg(F.min("doc_id").alias("first")).withColumn("node", F.col("first")),
                   "near-dedup-owners")
    # a doc_id that comes first for several texts names the least of them; the
    # others are named by their hash
    several = owner.groupBy("first").agg(
        F.min("content").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("first", "least")
    several = staged(several, "near-dedup-several")
    apart = not several.isEmpty()
    if apart:
        own = F.col("least").isNull() | (F.col("content") == F.col("least"))
        owner = staged(owner.drop("node").join(several, "first", "left").select(
            "content", "first", F.when(own, F.col("first")).otherwise(
                -1 - F.pmod(F.xxhash64("content"), F.lit(1 << 62))).alias("node")), "near-dedup-owners")
    nodes = staged(sketched.where("sketch is not null")
                   .join(owner, "content").where("doc_id = first")
                   .select("node", "n_words", "sketch", "counts").dropDuplicates(["node"]),
                   "near-dedup-nodes")
    members = nodes.select("node", "n_words", F.posexplode("sketch").alias("fn", "key"))
    buckets = staged(_buckets(members), "near-dedup-buckets")
    packed = _packed(base)
    if apart:
        ids = several.select(F.col("first").alias("doc_id"))
        packed = _packed(base.join(ids, "doc_id", "left_anti")).unionByName(
            _packed(base.join(ids, "doc_id", "left_semi"), True)
            .join(owner.select("content", F.col("node").alias("named")), "content")
            .select(F.col("named").alias("node"), "text"))
    words = staged(packed.join(
        buckets.select("node").distinct(), "node", "left_semi"), "near-dedup-texts")
    # rows of one doc_id belong together whatever their texts
    linked = links(nodes, words, buckets, similarity)
    versions = (sketched.select("doc_id", "content").where("doc_id is not null").distinct()
                .join(owner, "content").groupBy("doc_id")
                .agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi"))
    if not versions.isEmpty():
        joined = (sketched.select("doc_id", "content").join(versions.select("doc_id", "lo"), "doc_id")
                  .join(owner, "content").where("node <> lo")
                  .select(F.col("lo").alias("a"), F.col("node").alias("b"))
                  .unionByName(linked.select(F.col("component").alias("a"), F.col("node").alias("b"))))
        linked = components(joined.where("a <> b").distinct())
    found = owner.join(linked, "node", "left").select(
        "content", "first", F.coalesce("component", "node").alias("class_id"))
    if apart:
        least = found.groupBy("class_id").agg(F.min("first").alias("id"))
        found = found.join(least, "class_id").select("content", F.col("id").alias("class_id"))
    return sketched.select("doc_id", "content").join(
        found.select("content", "class_id"), "content", "left").select("doc_id", "class_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class, that of the least doc_id, with all its columns;
    rows without a doc_id stay."""
    found = staged(classes(docs, doc_id, text, **options), "near-dedup-classes")
    gone = (found.where("doc_id <> class_id").select(F.col("doc_id").alias("__gone")).distinct())
    kept = docs.join(gone, docs[doc_id].cast("long") == F.col("__gone"), "left_anti")
    repeated = found.where("doc_id = class_id").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    ids = repeated.select(F.col("doc_id").alias("__again"))
    match = kept[doc_id].cast("long") == F.col("__again")
    return kept.join(ids, match, "left_anti").unionByName(
        kept.join(ids, match, "left_semi").dropDuplicates([doc_id]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
