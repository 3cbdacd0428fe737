"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary comes as tiktoken ranks.  Bytes are mapped to printable
characters, merges are recovered from the ranks, and each match of the
splitting pattern is encoded by itself.  Encoding yields ids with character
offsets; decoding maps the characters of a token back to bytes, so characters
split over several tokens come out whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A batch of texts given to the encoder at once, in characters (bounds the memory of its token objects).
CHUNK_CHARS = 200_000


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where printable, else from U+0100 on in byte order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def recover_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last merge that makes ``token``: merge its bytes by rank until two parts remain."""
    parts = [token[i:i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], limit))
        joined = parts[at] + parts[at + 1]
        if ranks.get(joined, limit) >= limit:
            return None
        parts[at:at + 2] = [joined]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str):
    """(tokenizer, bytes of each id), once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    ranks = read_ranks(path)
    chars = byte_characters()
    shown = lambda b: "".join(chars[x] for x in b)
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1 and (pair := recover_merge(token, ranks)):
            merges.append((shown(pair[0]), shown(pair[1])))
    # ignore_merges: a match that is itself in the vocabulary is one token, as with ranks
    t = Tokenizer(BPE(vocab={shown(b): i for b, i in ranks.items()}, merges=merges, ignore_merges=True))
    t.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    table = [b""] * (max(ranks.values()) + 1)
    back = {c: b for b, c in enumerate(chars)}
    for text, i in t.get_vocab().items():
        table[i] = bytes(back[c] for c in text)
    return t, table


def pieces(text: str, size: int = CHUNK_CHARS) -> list[tuple[int, str]]:
    """(start, part) of a long text, cut only before a lone space between a non-space and a letter.

    No match of the pattern reaches over such a place, so the parts encode
    to the same ids as the whole.  A text without such a place stays whole.
    """
    if len(text) <= size:
        return [(0, text)]
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) - 1 and not (
            text[at] == " " and not text[at - 1].isspace() and text[at + 1].isalpha()
        ):
            at += 1
        if at >= len(text) - 1:
            break
        out.append((start, text[start:at]))
        start = at
    out.append((start, text[start:]))
    return out


def encode_texts(texts: list[str | None], path: str, pattern: str, offsets: bool = False) -> Iterator[tuple]:
    """Per text, in order: (ids, character offsets or None).  NULL counts as empty."""
    t, _ = load(path, pattern)
    run = t.encode_batch if offsets else getattr(t, "encode_batch_fast", t.encode_batch)
    parts = [(k, s, p) for k, x in enumerate(texts) for s, p in pieces(x or "")]
    ids: list[list[int]] = [[] for _ in texts]
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    at, done = 0, 0
    while at < len(parts):
        end, chars = at, 0
        while end < len(parts) and (end == at or chars + len(parts[end][2]) <= CHUNK_CHARS):
            chars += len(parts[end][2])
            end += 1
        for (k, s, _), e in zip(parts[at:end], run([p for _, _, p in parts[at:end]], add_special_tokens=False)):
            ids[k] += e.ids
            if offsets:
                spans[k] += [(a + s, b + s) for a, b in e.offsets]
        at = end
        ready = parts[at][0] if at < len(parts) else len(texts)
        while done < ready:
            yield ids[done], spans[done] if offsets else None
            ids[done], spans[done] = [], []
            done += 1
    while done < len(texts):
        yield ids[done], spans[done] if offsets else None
        done += 1


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    """The bytes of a token sequence.  An id outside the vocabulary raises."""
    table = load(path, pattern)[1]
    return b"".join([table[i] for i in ids])


def encode(df: DataFrame, key: str, text: str, path: str, pattern: str) -> DataFrame:
    """(key, ids array<int>, starts array<int>, ends array<int>) of every text; offsets are code points."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                got = list(encode_texts(part.column(1).to_pylist(), path, pattern, offsets=True))
                lists = lambda rows: pa.array(rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists([i for i, _ in got]), lists([[a for a, _ in o] for _, o in got]),
                     lists([[z for _, z in o] for _, o in got])], ["key", "ids", "starts", "ends"])

    out = df.select(key, text).mapInArrow(run, f"key {kind.simpleString()}, ids array<int>, starts array<int>, ends array<int>")
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, key: str, ids: str, path: str, pattern: str) -> DataFrame:
    """(key, data binary, text string) of every id sequence; NULL decodes to NULL.

    ``text`` reads the bytes as UTF-8, with U+FFFD where tokens do not end at a character.
    """
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [None if x is None else decode_ids(x, path, pattern) for x in b.column(1).to_pylist()]
            text = [None if x is None else x.decode("utf-8", "replace") for x in data]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(data, pa.binary()), pa.array(text, pa.string())], ["key", "data", "text"])

    out = df.select(key, ids).mapInArrow(run, f"key {kind.simpleString()}, data binary, text string")
    return out.withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again.

    Returns key, n_tokens, ids_sha256 (decimal ids joined by commas) and
    decoded_sha256 (decoded bytes).  NULL counts as empty; repeated rows give
    repeated rows; the result has one row per input row.
    """
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path, pattern)[1]
        decimal = [str(i) for i in range(len(table))]
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for ids, _ in encode_texts(b.column(1).to_pylist(), path, pattern):
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                text_hash.append(hashlib.sha256(b"".join([table[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"key {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def tokenize(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ids, n_tokens and ``text`` as decoded from the ids (NULL counts as empty)."""
    cols = docs.columns
    at = cols.index(text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path, pattern)[1]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = [i for i, _ in encode_texts(part.column(at).to_pylist(), path, pattern)]
                back = pa.array([b"".join([table[i] for i in x]).decode("utf-8", "replace") for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*[back if k == at else c for k, c in enumerate(part.columns)], pa.array(ids, pa.list_(pa.int32())),
                     pa.array([len(x) for x in ids], pa.int64())], [*cols, "ids", "n_tokens"])

    return docs.mapInArrow(run, f"{kinds}, ids array<int>, n_tokens bigint")
