"""Byte-level BPE encoding and decoding of whole texts with the ``tokenizers`` library over Arrow batches.

A rank file maps byte strings to ids. The library works on characters, so every byte gets a visible character (the byte
table), and the merges are recovered from the ranks: a token's merge is the pair that the lower ranks leave of it. Decoding
goes the other way through the byte table, on bytes: a token may hold part of a character, so ids are joined as bytes first
and only a whole document is read as text.

No shuffle: documents are independent. The splitting pattern never matches across the place before a single space or line
feed between two characters that are no white space, so texts are cut there, and each distinct piece is encoded by the library once and
remembered (at most ``REMEMBERED`` pieces a worker; then it starts anew).
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.text import give_back

#: Pieces that a worker remembers, and the longest that it does.
REMEMBERED, LONGEST = 250_000, 64


def byte_characters() -> list[str]:
    """The visible character of each byte: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (b for b in range(256) if b not in shown)
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(other)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that merges of lower rank leave of a token."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 62))
        if parts[at] + parts[at + 1] not in ranks:
            raise ValueError(f"Token {token!r} cannot be merged from the ranks")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class ByteBpe:
    """Encoder and decoder for one rank file and splitting pattern."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        chars = byte_characters()
        shown = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = sorted((rank, token) for token, rank in ranks.items() if len(token) > 1)
        pairs = [tuple(shown[part] for part in last_merge(token, ranks)) for _, token in merges]
        self._tokenizer = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=pairs))
        self._tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"),
             pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        byte_of = {c: b for b, c in enumerate(chars)}
        self._bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = bytes(byte_of[c] for c in shown[token])
        self._known: dict[str, bytes] = {}
        self._lengths = np.array([len(b) for b in self._bytes], np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [_pieces(text) for text in texts]
        known = self._known
        fresh = set().union(*cut).difference(known)
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = set().union(*cut)
        self._learn(list(fresh))
        out = [np.frombuffer(b"".join([known[piece] for piece in pieces]), "<u4") for pieces in cut]
        for piece in fresh:
            if len(piece) > LONGEST:
                del known[piece]
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces, many in one text where they can stand next to each other, and remember their ids."""
        joint = [p for p in pieces if len(p) > 1 and p[0] in " \n" and not p[1].isspace() and not p[-1].isspace()]
        single = list(set(pieces).difference(joint))
        groups = [joint[at : at + 256] for at in range(0, len(joint), 256)] + [[p] for p in single]
        for at in range(0, len(groups), 64):
            part = groups[at : at + 64]
            encoded = self._tokenizer.encode_batch_fast(["".join(g) for g in part], add_special_tokens=False)
            for group, e in zip(part, encoded):
                ids = np.array(e.ids, "<u4")
                ends = np.cumsum([len(p.encode()) for p in group])
                cuts = np.searchsorted(np.cumsum(self._lengths[ids]), ends) + 1 if len(ids) else np.zeros(len(group), int)
                raw, last = ids.tobytes(), 0
                for piece, cut in zip(group, cuts.tolist()):
                    self._known[piece] = raw[4 * last : 4 * cut]
                    last = cut

    def forget(self) -> None:
        """At the end of a task: a worker that waits or does other work holds no pieces."""
        self._known.clear()
        give_back()

    def decode(self, ids: np.ndarray) -> bytes:
        table = self._bytes
        return b"".join([table[i] for i in ids.tolist()])

    def starts(self, ids: np.ndarray, text: bytes) -> np.ndarray:
        """Character offset at which each token starts; a token that starts inside a character counts from it."""
        at = np.concatenate(([0], np.cumsum(self._lengths[ids])))[:-1].astype(np.int64)
        leads = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        return leads[at] - 1 if len(at) else at


def _pieces(text: str) -> list[str]:
    """The text, cut before single spaces and line feeds that stand between other characters than white space."""
    if "\0" not in text and " ".join(text.split()) == text.replace("\n", " "):
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") if text else []
    parts = text.split(" ")
    out, held = [], [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            out.append(" ".join(held))
            held = ["", part]
        else:
            held.append(part)
    out.append(" ".join(held))
    return out


@lru_cache(maxsize=4)
def _load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _runs(column: pa.Array, most: int = 2 << 20):
    """(first row, texts) of runs of rows that hold about ``most`` characters."""
    texts, held, first = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py() or ""
        texts.append(text)
        held += len(text)
        if held >= most or i == len(column) - 1:
            yield first, texts
            texts, held, first = [], 0, i + 1


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, starts): token ids of each whole text and the character offset of each; null texts count as empty.

    Rows are independent: repeated rows and null keys come back as they are, other columns are not read.
    """

    def run(batches):
        bpe = _load(path, pattern)
        for batch in batches:
            for first, texts in _runs(batch.column(1)):
                ids = bpe.encode(texts)
                starts = [bpe.starts(x, t.encode()) for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                     pa.array([x.astype(np.int32) for x in starts], pa.list_(pa.int32()))],
                    names=["key", "ids", "starts"],
                )
        bpe.forget()

    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    out = docs.mapInArrow(run, f"key {kind}, ids array<int>, starts array<int>")
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the text of each id list; null ids give null, and bytes that are no UTF-8 the replacement character."""

    def run(batches):
        bpe = _load(path, pattern)
        for batch in batches:
            lists = (x.as_py() for x in batch.column(1))
            texts = [None if x is None else bpe.decode(np.array(x, np.uint32)).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    encoded = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = encoded.schema["key"].dataType.simpleString()
    return encoded.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): what ``encode`` and then ``decode`` give, as digests, in one pass."""

    def run(batches):
        bpe = _load(path, pattern)
        for batch in batches:
            for first, texts in _runs(batch.column(1)):
                n, there, back = [], [], []
                for ids in bpe.encode(texts):
                    n.append(len(ids))
                    there.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(n, pa.int64()), pa.array(there), pa.array(back)],
                    names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        bpe.forget()

    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()
    out = docs.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
