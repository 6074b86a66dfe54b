"""Byte-level BPE encoding and decoding with the tokenizers library.

The rank file is turned into a tokenizers model once, on the driver: bytes map
to printable characters, and every way to split a token into two tokens becomes
a merge at the token's rank. Tasks encode Arrow batches; decoding maps a token's
characters back to bytes, so a character split over several tokens comes back whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from chainstrata.llm.chunks import PieceCache, by_size
from chainstrata.llm.columns import in_small_batches

RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The printable character of each byte: itself, or else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer of a rank file as JSON text.

    Any two neighbours whose bytes together are a token may merge, at that token's
    rank, so each token has one merge per split into two tokens.
    """
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [[name[token[:i]], name[token[i:]]]
              for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
              if token[:i] in ranks and token[i:] in ranks]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "post_processor": None,
        "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                  "vocab": {name[token]: rank for token, rank in ranks.items()}, "merges": merges}})


class Decoder:
    """Ids back to bytes, by the byte table reversed."""

    def __init__(self, tokenizer: Tokenizer):
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.tokens = {i: bytes(byte_of[c] for c in token) for token, i in tokenizer.get_vocab(with_added_tokens=False).items()}

    def __call__(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_loaded: dict[int, Tokenizer] = {}


def load(model: str) -> Tokenizer:
    """The tokenizer of a JSON text, built once per worker process."""
    if hash(model) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _loaded.clear()
        _loaded[hash(model)] = Tokenizer.from_str(model)
    return _loaded[hash(model)]


def encode(model: str, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
    """Ids and character offsets of each text.

    A token that holds part of a character spans the whole character, so offsets
    of neighbours overlap where a character is split.
    """
    return [(e.ids, e.offsets) for e in load(model).encode_batch(texts, add_special_tokens=False)]


def _digests(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(shared.value)
        decode = Decoder(tokenizer)

        def make(pieces: list[str]) -> Iterator[bytes]:
            for encoded in tokenizer.encode_batch_fast(pieces, add_special_tokens=False):
                yield np.array(encoded.ids, np.uint32).tobytes()

        cache = PieceCache(make)
        decimal = [b"%d" % i for i in range(max(decode.tokens, default=-1) + 1)]
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for texts in by_size(t.as_py() for t in batch.column(1)):
                for pieces in cache.of(texts):
                    ids = np.frombuffer(b"".join(pieces), np.uint32).tolist()
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                    text_sha.append(hashlib.sha256(decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _tokens(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(load(shared.value))
        for batch in batches:
            for at, text in enumerate(batch.column(1)):
                (ids, offsets), = encode(shared.value, [text.as_py() or ""])
                spans = np.array(offsets, np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([spans[:, 0]], pa.list_(pa.int32())),
                     pa.array([spans[:, 1]], pa.list_(pa.int32())), pa.array([decode(ids)], pa.binary())],
                    ["doc_id", "ids", "starts", "ends", "decoded"])
    return run


def _shared(docs: DataFrame, ranks_path: str, pattern: str):
    return docs.sparkSession.sparkContext.broadcast(build_tokenizer(read_ranks(ranks_path), pattern))


def tokens(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends, decoded) of every row: ids, character offsets, and the bytes decoded from the ids."""
    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return in_small_batches(given).mapInArrow(_tokens(_shared(docs, ranks_path, pattern)),
                                              "doc_id bigint, ids array<int>, starts array<int>, ends array<int>, decoded binary")


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Whole texts are encoded; a null text is an empty one, with no ids. Strings of
    special tokens are ordinary text. Repeated rows give repeated results, in no
    particular order. The model text (a few MB, fixed by the vocabulary) is the
    only thing broadcast.
    """
    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return in_small_batches(given).mapInArrow(_digests(_shared(docs, ranks_path, pattern)), RESULT)
