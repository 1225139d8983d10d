"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, each turn as

    <|turn|>role<|text|>text<|end|>

and encoded once. The template's control strings are added tokens, so no token
spans two parts. The spans of the texts to learn (role ``assistant``) and the
spans of the tokens are both sorted: binary search finds the tokens of each.

Control strings inside roles and texts (the template's and those of common
chat formats) are escaped by one backslash after their first character; a
string that already has n backslashes there gets n + 1. So rendering is
reversible, and no text can pose as a control string.

Rows are hash-partitioned by conversation, sorted, and streamed: a task holds
one conversation at a time.

Defined results: null texts and roles are empty; turns go by (turn, role,
text), nulls first, repeated rows are turns of their own; rows without a
conv_id make up one conversation; empty assistant texts put no token under
the mask; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterlens.llm.bpe import TOKENIZER, vocabulary
from clusterlens.llm.common import map_batches, per_worker, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"
# what may follow the first character ("<" or "[") of a control string
_REST = r"\||/s>|s>|<SYS>>|</SYS>>|INST\]|/INST\]"
_ESCAPE = re.compile(rf"([<\[])(?=\\*(?:{_REST}))")
_UNESCAPE = re.compile(rf"([<\[])\\(?=\\*(?:{_REST}))")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Rendered:
    text: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)      # texts to learn


def render(turns: list[tuple[str, str]], learned: str = LEARNED_ROLE) -> Rendered:
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        at += len(head)
        if role == learned and body:
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
        parts += [head, body, END]
    return Rendered("".join(parts), spans)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for turn in formatted.split(TURN)[1:]:
        role, _, text = turn.removesuffix(END).partition(TEXT)
        out.append((unescape(role), unescape(text)))
    return out


def mask_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for every token that overlaps a span; all three are sorted."""
    mask = np.zeros(len(starts), np.int8)
    if spans:
        s = np.array(spans)
        first = np.searchsorted(ends, s[:, 0], "right")
        last = np.searchsorted(starts, s[:, 1], "left")
        for a, b in zip(first, last):
            mask[a:b] = 1
    return mask


class Formatter:
    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True)
                                           for c in (TURN, TEXT, END)])

    def __call__(self, turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
        r = render(turns)
        e = self.tokenizer.encode(r.text, add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        return r.text, np.array(e.ids, np.int32), mask_of(offsets[:, 0], offsets[:, 1], r.spans)


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """conv_id, formatted, ids, loss_mask (a 0/1 per id) per conversation."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, formatted string, ids array<int>, loss_mask array<tinyint>"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    ordered = (rows.repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        fmt = per_worker(("chat", tokenizer), lambda: Formatter(tokenizer))
        now, held, any_rows = None, [], False

        def done():
            text, ids, mask = fmt(held)
            return pa.RecordBatch.from_pydict(
                {"conv_id": [now], "formatted": [text], "ids": [ids], "loss_mask": [mask]},
                schema=arrow)

        for batch in batches:
            for conv, role, text in zip(batch.column(0), batch.column(2), batch.column(3)):
                conv = conv.as_py()
                if any_rows and conv != now:
                    yield done()
                    held = []
                now, any_rows = conv, True
                held.append((role.as_py(), text.as_py()))
        if any_rows:
            yield done()

    return ordered.mapInArrow(run, schema)


def learned_texts(ids: np.ndarray, mask: np.ndarray, vocab) -> list[str]:
    """The texts under the mask, unescaped: one per run of masked ids."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])).astype(np.int8)))
    return [unescape(vocab.decode(ids[a:b])) for a, b in zip(edges[::2], edges[1::2])]


def digest(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What a reader finds in the output: turns, learned text, sizes."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def make():
        vocab = vocabulary(tokenizer)

        def run(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                   "formatted_chars", "n_tokens", "n_loss_tokens")}
            for text, ids, mask in zip(batch.column(1), batch.column(2), batch.column(3)):
                text = text.as_py()
                ids = np.asarray(ids.values, np.int64)
                mask = np.asarray(mask.values, np.int8)
                turns = parse(text)
                learned = "".join(learned_texts(ids, mask, vocab))
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256(
                    "".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                out["loss_chars"].append(len(learned))
                out["loss_sha256"].append(hashlib.sha256(learned.encode()).hexdigest())
                out["formatted_chars"].append(len(text))
                out["n_tokens"].append(len(ids))
                out["n_loss_tokens"].append(int(mask.sum()))
            return out | {"conv_id": batch.column(0)}
        return run

    return map_batches(formatted.select("conv_id", "formatted", "ids", "loss_mask"), make,
                       f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                       "loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long")


PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  turns.schema)
    return digest(format_conversations(turns.unionByName(probe))).drop("n_tokens", "n_loss_tokens")


KEY = "conv_id"
# the same result in DuckDB
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||/s>|s>|<SYS>>|</SYS>>|INST\]|/INST\])', '\1\\\2\3', 'g'))
          + length(regexp_replace(role, '([<\[])(\\*)(\||/s>|s>|<SYS>>|</SYS>>|INST\]|/INST\])', '\1\\\2\3', 'g'))
          + 23 AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
