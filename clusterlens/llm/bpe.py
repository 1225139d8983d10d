"""Byte-level BPE encoding and decoding.

Encoding of one pretoken: an Aho-Corasick automaton over the vocabulary lists
all tokens in it in one pass; starting from the longest token at each place,
a token is taken if it is compatible with the one before it, else the next
shorter one that starts there, else the last token is taken back. Two tokens
are compatible when merging their joined bytes gives these two again, and
every sequence of pairwise compatible tokens is the encoding that the merges
give, so the result is exact. Pair answers are kept in a table, and places
that lead nowhere are never tried twice, which keeps the work linear.

Texts are split at spaces first and the pieces looked up in a cache; where
white space meets a space the split would not be safe and the whole text goes
through the pretoken pattern. Strings of added tokens are matched first, as
the tokenizers library does.

Decoding gathers the tokens' bytes from one byte table through its offsets.

Defined results: null and empty texts have no ids and decode to ''; repeated
rows are encoded row by row; lone surrogates cannot occur in Spark strings;
an unknown id raises. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clusterlens.llm.common import map_batches, per_worker, table, texts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# a cache that would hold more than either is emptied first; an entry of so many
# characters is not kept
CACHE_ENTRIES = 400_000
CACHE_BYTES = 96 << 20
LONG_PIECE = 128
_ENTRY = 200                # bytes of an entry besides its characters and ids

# a space beside other white space: the pieces between spaces are not independent
# (the pattern begins with the space itself, which the search can skip to)
_UNSAFE = re.compile(r" (?<=\s )(?=\s|\Z)")

# characters that end a word without being letters, digits or white space
_STOPS = ".,;:!?"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, merge ranks and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or spec.get("normalizer")
                or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError(f"{path}: only plain byte-level BPE files are supported")
        of = byte_alphabet()
        raw = {t: bytes(of[c] for c in t) for t in model["vocab"]}
        self.id_of = {raw[t]: i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw[a], raw[b]): r for r, (a, b) in enumerate(merges)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*self.id_of.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for t, i in self.id_of.items():
            self.bytes_of[i] = t
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        known = [b or b"" for b in self.bytes_of]
        self.known = np.array([b is not None for b in self.bytes_of])
        self.sizes = np.array([len(b) for b in known], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum([len(b) for b in known])))
        self.table = np.frombuffer(b"".join(known), np.uint8)

    def merged(self, data: bytes) -> tuple[bytes, ...]:
        """The merges applied one by one, least rank first, leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(parts)

    def formed_by(self) -> dict[bytes, tuple[bytes, bytes]]:
        """Each token's last merge."""
        out: dict[bytes, tuple[bytes, bytes]] = {}
        several = set()
        for pair in self.rank:
            t = pair[0] + pair[1]
            if t in out:
                several.add(t)
            out.setdefault(t, pair)
        for t in several:              # the pair that merging its bytes ends with
            for k in range(1, len(t)):
                if (t[:k], t[k:]) in self.rank and self.merged(t[:k]) == (t[:k],) \
                        and self.merged(t[k:]) == (t[k:],):
                    out[t] = min((t[:k], t[k:]), out[t], key=self.rank.__getitem__)
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        if ids.max() >= len(self.known) or not self.known[ids].all():
            raise ValueError("unknown token id")
        start, lengths = self.offsets[ids], self.sizes[ids]
        ends = np.cumsum(lengths)
        where = np.repeat(start - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.table[where].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Pieces(dict):
    """Ids by piece, made when first asked for; ``front`` stands before every key
    of it. Whatever is asked for, the bounds above hold after every entry."""

    def __init__(self, make, front: str = ""):
        super().__init__()
        self.make, self.front, self.held = make, front, 0

    def __missing__(self, piece: str) -> bytes:
        return self.keep(piece, self.make(self.front + piece))

    def keep(self, piece: str, ids: bytes) -> bytes:
        if len(piece) < LONG_PIECE:
            size = _ENTRY + 4 * len(piece) + len(ids)
            if len(self) >= CACHE_ENTRIES or self.held + size > CACHE_BYTES:
                self.clear()
                self.held = 0
            self[piece] = ids
            self.held += size
        return ids


class PieceEncoder:
    """Splits texts into pretokens and keeps the ids of pieces and pretokens.

    Ids travel as little-endian unsigned 32-bit bytes, which join quickly.
    Subclasses give ``encode_word`` (one pretoken).
    """

    def __init__(self, added: dict[str, int]):
        import regex
        self.added_ids = added
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.pieces = Pieces(self._piece)       # pretokens too: they are pieces
        self.spaced = Pieces(self._piece, " ")  # those that begin with a space, without it
        self.added = (re.compile("(" + "|".join(
            map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None)

    def encode_word(self, word: str) -> bytes:
        raise NotImplementedError

    def _word(self, word: str) -> bytes:
        held, key = (self.spaced, word[1:]) if word[0] == " " else (self.pieces, word)
        ids = held.get(key)
        return held.keep(key, self.encode_word(word)) if ids is None else ids

    def _piece(self, piece: str) -> bytes:
        # most pieces are a word, or a word and stops: letters are one pretoken
        body = piece.rstrip(_STOPS)
        if body[1:].isalpha() and (body[0] == " " or body[0].isalpha()):
            if len(body) == len(piece):
                return self.encode_word(piece)
            return self._word(body) + self._word(piece[len(body):])
        return self.long(piece)

    def long(self, text: str) -> bytes:
        words = self.pattern.findall(text)
        if len(words) == 1:
            return self.encode_word(words[0])
        return b"".join(map(self._word, words))

    def encode(self, text: str) -> np.ndarray:
        if self.added is None or not any(t in text for t in self.added_ids):
            return np.frombuffer(self._plain(text), "<u4")
        return np.frombuffer(b"".join(
            [self.added_ids[part].to_bytes(4, "little") if i % 2 else self._plain(part)
             for i, part in enumerate(self.added.split(text))]), "<u4")

    def _plain(self, text: str) -> bytes:
        return self.long(text) if _UNSAFE.search(text) else self._safe(text)

    def _safe(self, text: str) -> bytes:
        # "a b c" -> "a", " b", " c": no pretoken crosses the front of such a space
        parts = text.split(" ")
        first = parts.pop(0)
        ids = b"".join(map(self.spaced.__getitem__, parts))
        return self.pieces[first] + ids if first else ids


class Encoder(PieceEncoder):
    """Exact encoder of pretokens by the vocabulary's own merges."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick
        super().__init__(vocab.added)
        self.vocab = vocab
        self.parts = vocab.formed_by()
        self.pairs: dict[int, bool] = {}
        self.width = len(vocab.bytes_of)
        self.sizes = [len(b or b"") for b in vocab.bytes_of]
        # bytes read as Latin-1 characters: the automaton works on strings
        self.matcher = ahocorasick.Automaton()
        for t, i in vocab.id_of.items():
            if len(t) == 1 or t in self.parts and self._apart(
                    *self.parts[t], vocab.rank[self.parts[t]]):
                self.matcher.add_word(t.decode("latin-1"), (i, len(t) - 1))
        self.matcher.make_automaton()

    def _apart(self, a: bytes, b: bytes, limit: int) -> bool:
        """True if no merge of rank below ``limit`` joins the end of a to the
        start of b while the two are formed.

        Played backwards: of the two pieces that touch, the one formed last is
        taken apart. Before that moment the touching pieces must not have had
        a merge of their own that comes first; equal merges go left to right.
        """
        rank, parts = self.vocab.rank, self.parts
        while True:
            if rank.get((a, b), limit) < limit:
                return False
            ra = rank[parts[a]] if a in parts else -1
            rb = rank[parts[b]] if b in parts else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                a, limit = parts[a][1], ra
            else:
                b, limit = parts[b][0], rb + 1

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.width + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            known = self._apart(self.vocab.bytes_of[a], self.vocab.bytes_of[b], 1 << 60)
            self.pairs[key] = known
        return known

    def encode_bytes(self, data: bytes) -> bytes:
        n, sizes, width, pairs = len(data), self.sizes, self.width, self.pairs
        starts: list[list[int]] = [[] for _ in range(n)]       # shortest first
        for end, (token, back) in self.matcher.iter(data.decode("latin-1")):
            starts[end - back].append(token)
        out: list[int] = []
        dead = bytearray(n + 1)                # places from which the rest cannot be reached
        at, prev = 0, -1
        while at < n:
            left = starts[at]
            while left:
                token = left.pop()
                if dead[at + sizes[token]]:
                    continue
                if prev >= 0:
                    fits = pairs.get(prev * width + token)
                    if not (self.compatible(prev, token) if fits is None else fits):
                        continue
                out.append(token)
                at += sizes[token]
                prev = token
                break
            else:
                if not out:
                    raise ValueError("bytes outside the vocabulary")
                dead[at] = 1
                at -= sizes[out.pop()]
                prev = out[-1] if out else -1
        return struct.pack(f"<{len(out)}I", *out)

    def encode_word(self, word: str) -> bytes:
        return self.encode_bytes(word.encode("utf-8"))


def vocabulary(path: str) -> Vocabulary:
    return per_worker(("vocabulary", path), lambda: Vocabulary(path))


def encoder(path: str) -> Encoder:
    return per_worker(("encoder", path), lambda: Encoder(vocabulary(path)))


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and ``ids`` (array of int) per document row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def make():
        enc = encoder(tokenizer)

        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0),
                    "ids": [enc.encode(t).astype(np.int32) for t in texts(batch.column(1))]}
        return run

    return map_batches(docs.select(doc_id, text), make, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids",
           tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id and ``text`` per row of ids."""
    kind = encoded.schema[doc_id].dataType.simpleString()

    def make():
        vocab = vocabulary(tokenizer)

        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "text": [
                vocab.decode(np.asarray(x.values) if x.is_valid else np.empty(0, np.int64))
                for x in batch.column(1)]}
        return run

    return map_batches(encoded.select(doc_id, ids), make, f"doc_id {kind}, text string")


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document: number and hash of the ids, hash of the text decoded from them."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def make():
        enc, vocab = encoder(tokenizer), vocabulary(tokenizer)

        def run(batch: pa.RecordBatch) -> dict:
            n, a, b = [], [], []
            for t in texts(batch.column(1)):
                ids = enc.encode(t)
                n.append(len(ids))
                a.append(hashlib.sha256(ids.tobytes()).hexdigest())
                b.append(hashlib.sha256(vocab.decode(ids).encode()).hexdigest())
            return {"doc_id": batch.column(0), "n_tokens": n, "ids_sha256": a,
                    "decoded_sha256": b}
        return run

    return map_batches(docs.select(doc_id, text), make,
                       f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
