"""Quality rules with host verdicts, in DataFrame functions only.

Per document: words are runs of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. The base rules fail a text of
fewer than ``min_words`` words or with more than ``max_repeat_pct`` per cent
of its words inside three-word windows that occur twice or more in the text.

Per host: the failures are counted per host (partial aggregation, so a hot
host costs no more than any other), the failure rates are shrunk with a beta
prior fitted to all hosts by moments, and the documents of a host whose
shrunk rate exceeds ``max_host_rate`` are rejected as well.

Defined results: a null or empty text has no words and fails the base rules;
a document without a host gets no host verdict; repeated rows are judged (and
counted) one by one; an empty table gives an empty result. Only the named
columns are read, so other columns and their names do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterlens.llm.common import staged

WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_HOST_RATE = 0.5
MAX_BROADCAST_HOSTS = 10_000    # more rejected hosts are joined by shuffle
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _length(c: Column) -> Column:
    return F.length(c).cast("long")


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def with_metrics(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the five metrics (named with ``prefix``) to every row, shuffle-free.

    Each step is a column of its own, referenced several times by the next,
    so that Catalyst keeps it as a value instead of repeating its expression.
    """
    n = {m: prefix + m for m in METRICS}
    t = {k: f"__qr_{k}" for k in ("text", "words", "dense", "lines", "bits", "windows", "clash", "exact", "starts")}
    c = {k: F.col(f"`{v}`") for k, v in t.items()}
    df = df.withColumn(t["text"], F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        t["words"]: F.array_remove(F.split(c["text"], "[ \\x09-\\x0D]+"), ""),
        t["dense"]: _without(c["text"], WHITE_SPACE),
        t["lines"]: F.filter(F.split(c["text"], "\n"),
                             lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != ""),
    })
    size = F.size(c["words"]).cast("long")
    df = df.withColumns({
        n["n_words"]: size,
        n["word_chars"]: _length(c["dense"]),
        n["n_symbols"]: _length(c["dense"]) - _length(_without(c["dense"], SYMBOLS)),
        n["n_dup_lines"]: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long"),
        t["bits"]: F.length(F.bin(size)),
    })
    # One long per three-word window: the hash above, the position below. The
    # position needs as many bits as the word count, the hash has all others
    # (49 of them for a text of 20,000 words), so sorting brings equal windows
    # together in position order. Arrays of longs sort as primitives.
    at = F.when(size >= 3, F.sequence(F.lit(0).cast("long"), size - 3)).otherwise(
        F.array().cast("array<bigint>"))
    words, bits = c["words"], c["bits"]

    def packed(i: Column) -> Column:
        j = i.cast("int")
        h = F.xxhash64(F.get(words, j), F.get(words, j + 1), F.get(words, j + 2))
        return F.call_function("shiftleft", h, bits).bitwiseOR(i)

    df = df.withColumn(t["windows"], F.sort_array(F.transform(at, packed)))
    windows = c["windows"]
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def place(k: Column) -> Column:
        return F.get(windows, k).bitwiseAND(mask).cast("int")

    def unlike(k: Column) -> Column:
        """Neighbours of equal hash whose words differ."""
        a, b = place(k - 1), place(k)
        return (F.call_function("shiftright", F.get(windows, k - 1), bits)
                == F.call_function("shiftright", F.get(windows, k), bits)) & (
            (F.get(words, a) != F.get(words, b)) | (F.get(words, a + 1) != F.get(words, b + 1))
            | (F.get(words, a + 2) != F.get(words, b + 2)))

    clash = F.exists(F.when(F.size(windows) > 1, F.sequence(F.lit(1), F.size(windows) - 1)).otherwise(
        F.array().cast("array<int>")), unlike)
    df = df.withColumn(t["clash"], clash)

    def repeated(x: Column, i: Column) -> Column:
        def same(k: Column) -> Column:
            return F.coalesce(F.call_function("shiftright", F.get(windows, k), bits)
                              == F.call_function("shiftright", x, bits), F.lit(False))
        return same(i - 1) | same(i + 1)

    # a text in which a hash stands for two windows has them sorted by their words
    triple = F.transform(at, lambda i: F.struct(
        *(F.get(words, i.cast("int") + d).alias(f"w{d}") for d in range(3)), i.alias("i")))
    df = df.withColumn(t["exact"], F.when(c["clash"], F.sort_array(triple)))
    exact = c["exact"]

    def equal(x: Column, k: Column) -> Column:
        y = F.get(exact, k)
        return F.coalesce((x["w0"] == y["w0"]) & (x["w1"] == y["w1"]) & (x["w2"] == y["w2"]), F.lit(False))
    verified = F.transform(F.filter(exact, lambda x, i: equal(x, i - 1) | equal(x, i + 1)), lambda x: x["i"])
    hashed = F.transform(F.filter(windows, repeated), lambda x: x.bitwiseAND(mask))
    df = df.withColumn(t["starts"], F.sort_array(F.when(c["clash"], verified).otherwise(hashed)))
    starts = c["starts"]
    # a window covers three words; one starting d words after the last adds min(d, 3)
    added = F.transform(starts, lambda x, i: F.least(
        F.lit(3).cast("long"), x - F.coalesce(F.get(starts, i - 1), F.lit(-3).cast("long"))))
    df = df.withColumn(n["n_repeat_words"],
                       F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x))
    return df.drop(*t.values())


def base_failed(prefix: str = "", min_words: int = MIN_WORDS,
                max_repeat_pct: int = MAX_REPEAT_PCT) -> Column:
    words, rep = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < min_words) | (rep * 100 > words * max_repeat_pct)


@dataclass(frozen=True)
class BetaPrior:
    """Prior of a host's failure rate: ``alpha`` failures, ``beta`` passes."""
    alpha: float
    beta: float

    def shrunk(self, failed: Column, n: Column) -> Column:
        return (failed + F.lit(self.alpha)) / (n + F.lit(self.alpha + self.beta))


def host_counts(judged: DataFrame, host: str, failed: str) -> DataFrame:
    return (judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("__host"))
            .agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(failed).cast("long")).alias("__f")))


def fit_prior(counts: DataFrame) -> BetaPrior:
    """Method of moments over all hosts; one row of sums reaches the driver.

    The spread of the rates beyond what counting noise explains sets the
    strength, kept between 2 and 1,000 pseudo-documents.
    """
    n, f = F.col("__n").cast("double"), F.col("__f").cast("double")
    s = counts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(f * f / n).alias("ff"),
                   F.count(F.lit(1)).alias("k")).first()
    if not s["n"]:
        return BetaPrior(1.0, 1.0)
    mean = min(max(s["f"] / s["n"], 1e-6), 1 - 1e-6)
    spread = s["ff"] - s["n"] * mean * mean          # sum of n (rate - mean)^2
    noise = mean * (1 - mean)
    between = (spread - (s["k"] - 1) * noise) / s["n"]
    strength = noise / between - 1 if between > 0 else 1000.0
    strength = min(max(strength, 2.0), 1000.0)
    return BetaPrior(mean * strength, (1 - mean) * strength)


def rejected_hosts(judged: DataFrame, host: str, failed: str,
                   max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    counts = host_counts(judged, host, failed)
    prior = fit_prior(counts)
    return (counts.where(prior.shrunk(F.col("__f"), F.col("__n")) > max_host_rate)
            .select("__host", F.lit(True).alias("__rejected")))


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple = ("doc_id",),
          min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``keep`` columns, the metrics, ``base_failed`` and ``kept`` per document.

    All added columns carry a ``qr_`` prefix. The judged rows are written once
    (texts only if ``keep`` names them) and read twice: for the host counts
    and for the join of the host verdicts.
    """
    hidden = "__qr_host"
    # names of their own while the rules run: 'keep' may hold any column name
    wanted = docs.select(*[F.col(f"`{k}`") for k in keep], F.col(host).alias(hidden),
                         F.col(text).alias("__qr_in"))
    base = (with_metrics(wanted, "__qr_in", "qr_").drop("__qr_in")
            .withColumn("qr_base_failed", base_failed("qr_", min_words, max_repeat_pct)))
    base = staged(base, "quality-rules")
    bad = staged(rejected_hosts(base, hidden, "qr_base_failed", max_host_rate), "quality-hosts")
    n = bad.count()
    if not n:
        return base.withColumn("qr_kept", ~F.col("qr_base_failed")).drop(hidden)
    if n <= MAX_BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    return (base.join(bad, base[hidden] == bad["__host"], "left")
            .withColumn("qr_kept", ~F.col("qr_base_failed") & F.col("__rejected").isNull())
            .drop(hidden, "__host", "__rejected"))


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The kept documents with all their columns."""
    return judge(docs, keep=tuple(docs.columns), **options).where("qr_kept").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    from clusterlens.llm.common import table
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[F.col("qr_" + m).alias(m) for m in METRICS],
                      F.col("qr_base_failed").alias("base_failed"), F.col("qr_kept").alias("kept"))


# the same result in DuckDB
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, source, text,
         list_filter(regexp_split_to_array(text, '[ \x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT rid, count(*) AS n FROM (
    SELECT DISTINCT rid, i + k AS p FROM rep, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[ \x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.rid = cov.rid
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END)::DOUBLE AS f
  FROM b WHERE source IS NOT NULL GROUP BY source
), s AS (
  SELECT sum(n) AS n, sum(f * f / n) AS ff, count(*) AS k,
         least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) AS mean FROM h
), p AS (
  SELECT mean, (ff - n * mean * mean - (k - 1) * mean * (1 - mean)) / n AS between_hosts FROM s
), q AS (
  SELECT mean, least(greatest(CASE WHEN between_hosts > 0
    THEN mean * (1 - mean) / between_hosts - 1 ELSE 1000.0 END, 2.0), 1000.0) AS strength FROM p
), bad AS (
  SELECT source FROM h, q WHERE (f + mean * strength) / (n + strength) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND coalesce(b.source NOT IN (SELECT source FROM bad), true)) AS kept
FROM b
"""
