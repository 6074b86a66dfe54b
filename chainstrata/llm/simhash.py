"""SimHash near-duplicates found by multi-index hashing.

A fingerprint is cut into segments. By pigeonhole, fingerprints within ``bits``
bits agree within a small radius in at least one segment, so each fingerprint is
filed under its exact segments and looked up under the Hamming ball of each
segment; the join verifies the whole distance. Equal fingerprints are one node
from the start, so copies cost one row, and only links between different
fingerprints are formed. No link is lost, whatever the number of segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from chainstrata.llm.columns import LOWER, ROW_KEY, UPPER, in_small_batches, row_key
from chainstrata.llm.components import components
from chainstrata.session import materialized

WORDS, SEED, BITS, SEGMENTS = 4, 42, 4, 3
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
# Set bits of every byte value, highest first.
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 for null, empty and blank texts.

    A-Z are lower-cased; shingles of ``words`` words count as often as they occur,
    and a shorter text is one shingle. Works in pieces, so that a very long text
    needs no more than its own size again.
    """
    if not text:
        return 0
    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    body = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = max(len(tokens) - words + 1, 1)
    starts, ends = starts[:k], ends[-k:]
    set_bits, digest = np.zeros((8, 8), np.int64), xxhash.xxh64_digest
    for at in range(0, k, _CHUNK):
        pairs = zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())
        hashes = np.frombuffer(b"".join([digest(body[s:e], seed) for s, e in pairs]), np.uint8).reshape(-1, 8)
        if len(hashes) < 64:
            set_bits += np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64).reshape(8, 8)
        else:
            for i in range(8):
                set_bits[i] += np.bincount(hashes[:, i], minlength=256) @ _BYTE_BITS
    return int.from_bytes(np.packbits(2 * set_bits.reshape(64) > k).tobytes(), "big")


def _fingerprints(words: int, seed: int):
    """The fingerprint of the last column's texts in place of them; other columns pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words, seed) for t in batch.columns[-1]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], [*batch.schema.names[:-1], "print"])
    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, row key, print) with the fingerprint as a signed long."""
    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), *row_key(F.col(doc_id), F.col(text)), F.col(text).alias("text"))
    return in_small_batches(given).mapInArrow(
        _fingerprints(words, seed), "doc_id bigint, _no_id boolean, _id bigint, _text_hash bigint, print bigint")


def radii(bits: int, segments: int) -> list[int]:
    """Radius to search in each segment (-1: none) so that no pair within ``bits`` escapes.

    If every segment differed by more than its radius, the sum would exceed ``bits``.
    """
    whole, rest = divmod(bits, segments)
    return [whole if i <= rest else whole - 1 for i in range(segments)]


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments, the wider ones first."""
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    return [(64 - sum(widths[:i + 1]), w) for i, w in enumerate(widths)]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(width), r)]


def _looked_up(place: Column, part: Column):
    return lambda mask: F.struct(place, part.bitwiseXOR(mask).alias("value"))


def near_pairs(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a < b) of different fingerprints within ``bits`` bits, from distinct ``print`` values.

    A pair may repeat, at most once per segment. Larger corpora want fewer, wider
    segments (2 instead of 3): more lookups each, far fewer chance meetings.
    """
    filed, looked_up = [], []
    for i, ((shift, width), radius) in enumerate(zip(_cuts(segments), radii(bits, segments))):
        if radius < 0:
            continue
        part = F.shiftrightunsigned("print", shift).bitwiseAND(F.lit((1 << width) - 1))
        place: Column = F.lit(i).cast("tinyint").alias("segment")
        filed.append(F.struct(place, part.alias("value")))
        masks = F.lit(_ball(width, radius)).cast("array<bigint>")
        looked_up.append(F.transform(masks, _looked_up(place, part)))
    index = prints.select(F.col("print").alias("b"), F.inline(F.array(*filed)))
    probes = prints.select(F.col("print").alias("a"), F.inline(F.flatten(F.array(*looked_up))))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    joined = probes.alias("p").join(index.alias("i"), (F.col("p.segment") == F.col("i.segment")) & (F.col("p.value") == F.col("i.value"))
                                    & (F.col("a") < F.col("b")) & near)
    return joined.select("a", "b")


def classes(prints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """(print, root, component_id, links) per distinct fingerprint of a stored frame; ``root`` names its component."""
    nodes = materialized(prints.groupBy("print").agg(F.min("doc_id").alias("smallest")), "nodes")
    pairs = materialized(near_pairs(nodes.select("print"), bits, segments).distinct(), "pairs")
    rooted = nodes.join(components(pairs).select(F.col("node").alias("print"), "root"), "print", "left").select(
        "print", "smallest", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    degree = pairs.select(F.explode(F.array("a", "b")).alias("print")).groupBy("print").agg(F.count("*").alias("links"))
    return materialized(rooted.join(smallest, "root").join(degree, "print", "left").select(
        "print", "root", "component_id", F.coalesce("links", F.lit(0)).alias("links")), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS,
                    segments: int = SEGMENTS) -> DataFrame:
    """(doc_id, fingerprint, component_id, links) for every row.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    doc_id reachable over links of at most ``bits`` differing bits, the row's own
    included (null if the component has no id); ``links`` the number of other
    fingerprints the row's own links to. Null, empty and blank texts have
    fingerprint zero and link like any other. Texts of any length are read whole.
    """
    prints = materialized(fingerprints(docs, doc_id, text).select("doc_id", "print"), "prints")
    return prints.join(classes(prints, bits, segments), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Of each component the row of the smallest key, once: by id, rows without an id last, then by text hash.

    An id that repeats with different texts names different rows, each judged by its
    own text, so no text is lost unless it duplicates another. Rows equal in id and
    text count as one.
    """
    prints = materialized(fingerprints(docs, doc_id, text), "prints")
    heads = prints.join(classes(prints, bits, segments).select("print", "root"), "print").groupBy("root").agg(
        F.min(F.struct(*ROW_KEY)).alias("head")).select("head.*")
    keyed = docs.select(F.struct("*").alias("_row"), *row_key(F.col(doc_id), F.col(text)))
    return keyed.join(heads, ROW_KEY, "left_semi").dropDuplicates(ROW_KEY).select("_row.*")
