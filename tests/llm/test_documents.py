"""The document operators against plain versions on a small table with odd rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chainstrata.llm import bpe, chunks, line_dedup, mixing, quality, simhash, token_files, toxicity
from chainstrata.llm.chunks import PIECE, TokenIds, cut_marks, token_ids

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, row int, label string, size int"
BASE = " ".join(f"word{i}" for i in range(300))
TEXTS = [
    None, "", "\n", "one", "Ab cd ef gh", "The same line here\nshort\nthe SAME line here \n", " \tThe same line here\x0b\nother text of it",
    BASE, BASE, BASE.replace("word150", "changed"), "x" * 20_000, "split \U0001F600 characters é中 <|endoftext|> don't  stop\r\n\n  ",
    "ÉCOLE Straße ÉCOLE line\nÉcole straße École line", "The same line here", "!!", "Ab cd ef gh",
]


def rows():
    out = [(i, t, "en", ["b", "a", None][i % 3], 0, "clash", 1, "z", 2) for i, t in enumerate(TEXTS)]
    return [*out, out[5], (None, "The same line here", None, "c", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_lines_match_a_plain_version(docs, none):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    order = {}
    for i, t, *_ in rows():
        for line in (t or "").split("\n"):
            order.setdefault(key(line), set()).add((i is None, i or 0))
    want = []
    for i, t, *_ in rows():
        lines = (t or "").split("\n")
        keep = [len(key(x)) < 10 or (i is None, i or 0) == min(order[key(x)]) for x in lines]
        want.append((i, len(lines), keep.count(False), "\n".join(x for x, k in zip(lines, keep) if k)))
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text)) for r in got)
    for r in got:
        assert sum(r.keep_bitmap) == r.n_lines and sum(r.keep_bitmap[1::2]) == r.n_dropped
    assert line_dedup.dedup_lines(none).count() == 0


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def test_near_duplicates_match_all_pairs(docs, none):
    given = [(i, _fingerprint(t)) for i, t, *_ in rows()]
    parent = list(range(len(given)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(given)):
        for b in range(a):
            if (given[a][1] ^ given[b][1]).bit_count() <= 4:
                parent[find(a)] = find(b)
    groups = {}
    for at, (i, _) in enumerate(given):
        groups.setdefault(find(at), []).append(i)
    want = [(i, f"{p:016x}", min((x for x in groups[find(at)] if x is not None), default=None)) for at, (i, p) in enumerate(given)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_no_pair_of_fingerprints_is_lost(spark, segments):
    rng = random.Random(segments)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(4)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    found = simhash.near_pairs(spark.createDataFrame([(p,) for p in signed], "print bigint"), 4, segments)
    assert {(r.a, r.b) for r in found.collect()} == want


def test_mix_reaches_targets(docs, none, spark):
    sizes = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.pmod(F.hash("id"), F.lit(50)) + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "b").alias("source"))
    for frame in (sizes, docs):
        found = mixing.mix(frame).collect()
        assert sorted(map(repr, found)) == sorted(map(repr, mixing.mix(frame).collect()))
        assert all(r.taken == r.copies * r.size and r.copies <= 2 for r in found)
        targets = {r.row.source: (r.target, r.source_size) for r in found}
        for source, (target, size) in targets.items():
            own = [r for r in found if r.row.source == source]
            assert sum(r.size for r in own) == size and target <= 2 * size
            assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) + 1
        assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * sum(s for _, s in targets.values()))
    assert mixing.mix(none).count() == 0


def test_targets_reshare_the_excess(spark):
    given = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50), ("d", 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(given).collect()}
    # a (5) and null (2) and b (2) are capped at twice their size; c (1) and d (5) share the rest.
    assert got == {"a": 20.0, "b": 200.0, None: 100.0, "d": 0.0, "c": 1.5 * 1160 - 320}


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def test_bpe_matches_the_rank_library(docs, none, ranks):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    want = []
    for i, t, *_ in rows():
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = bpe.token_digests(docs, path, public_tokenizers.PATTERN)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    whole = bpe.tokens(docs, path, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in whole) == sorted((i or 0, t or "") for i, t, *_ in rows())
    smile = next(r for r in whole if r.doc_id == 11)
    assert all(0 <= s <= e for s, e in zip(smile.starts, smile.ends)) and max(smile.ends) == len(TEXTS[11])
    assert bpe.token_digests(none, path, public_tokenizers.PATTERN).count() == 0


def test_pieces_are_safe_places_to_cut(ranks):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    signs = list("ab'sSdé zÿ 12!*.-\n\t\x1c\x85\xa0\u2003\u3000д́中ʰ²½ßͅ_`ǅ")
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        pieces = PIECE.findall(text)
        assert "".join(pieces) == text
        assert plain.encode_ordinary(text) == [x for p in pieces for x in plain.encode_ordinary(p)]


def _odd_texts(n):
    rng = random.Random(2)
    signs = list("ab'sSdé zÿ 12!*.-\n\t\x1c\x85\xa0\u2003\u3000д́中ʰ²½ßͅ_`ǅ×÷Àɏɐ")
    return ["".join(rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_marks_are_safe_places_to_cut(ranks):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in _odd_texts(20_000):
        data = text.encode()
        at = [0, *np.flatnonzero(cut_marks(data)).tolist(), len(data)]
        pieces = [data[a:b].decode() for a, b in zip(at, at[1:]) if b > a]
        assert "".join(pieces) == text
        assert plain.encode_ordinary(text) == [x for p in pieces for x in plain.encode_ordinary(p)]


def test_ids_of_many_texts_equal_those_of_each_and_a_piece_is_encoded_once(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [None, "", *_odd_texts(3000), "<|endoftext|>", "x" * 300, None, "été l'été " * 9, ""]
    want = [[*e.ids, 2] for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for limit in (700_000, 50):  # the smaller one forgets after every call
        encode, asked = TokenIds(open(path, encoding="utf-8").read(), limit), []
        own = encode._encode
        encode._encode = lambda pieces: asked.extend(pieces.to_pylist()) or own(pieces)
        for at, stop in ((0, 1000), (1000, len(texts)), (1, 1), (0, 2), (0, len(texts))):
            ids, n = encode.of(pa.array(texts, pa.string())[at:stop], 2)
            assert np.split(ids, np.cumsum(n)[:-1])[0].tolist() == (want[at] if stop > at else [])
            assert n.tolist() == list(map(len, want[at:stop])) and ids.tolist() == [x for w in want[at:stop] for x in w]
        assert (len(asked) == len(set(asked))) == (limit > 50)
    monkeypatch.setattr(chunks, "_SLICE", 7)  # bytes marked at a time may end anywhere
    ids, n = TokenIds(open(path, encoding="utf-8").read()).of(pa.array(texts, pa.string()), 2)
    assert ids.tolist() == [x for w in want for x in w]
    model = open(path, encoding="utf-8").read()
    assert token_ids(model) is token_ids(model)  # a worker's next task finds what is held


def test_a_block_begins_with_its_own_ids():
    # as many different ids as a block can have, each once: the gaps alone are coded in a byte each
    ids = np.random.default_rng(4).permutation(np.arange(token_files.BLOCK) * 12)
    code = token_files.encode_blocks([ids])[0]
    assert (token_files.decode_blocks([code], [len(ids)])[0] == ids).all()
    assert len(code) < len(ids) * (8 + 13) / 8
    with pytest.raises(ValueError, match="at most"):
        token_files.encode_blocks([np.arange(token_files.BLOCK + 1)])


def test_any_damaged_byte_is_found():
    ids = np.random.default_rng(7).integers(0, 60_000, 1500) % 900 * 61
    codes, counts, checksums = token_files.pack(np.concatenate([ids, ids + 5, ids]))
    for at in [*range(10), *range(10, len(codes[0]), 900)]:
        for flip in (1, 128):
            broken = bytearray(codes[0])
            broken[at] ^= flip
            if at < len(broken) - 8:  # the last words may hold bits that do not count
                with pytest.raises(ValueError):
                    token_files.unpack([bytes(broken), *codes[1:]], counts, checksums)
    for left in (0, 3, 5, 400):
        with pytest.raises(ValueError):
            token_files.unpack([codes[0][:left], *codes[1:]], counts, checksums)


def test_frames_read_together_keep_their_documents():
    rng = np.random.default_rng(8)
    frames, want = [], []
    for part, before, sizes in ((0, 0, [5, 9000, 1]), (0, 9006, [1, 1]), (1, 0, [4096]), (1, 4096, [7])):
        ids = rng.integers(0, 50_000, sum(sizes))
        codes, blocks, checksums = token_files.pack(ids)
        frames.append((part, before, [None, *range(1, len(sizes))], sizes, codes, blocks, checksums))
        cuts = [0, *np.cumsum(sizes).tolist()]
        want += [(part, i or None, before + a, b - a, ids[a:b].astype("<u4").tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*frames), kinds)],
                                       ["part", "ids_before", "doc_ids", "n_tokens", "codes", "block_ids", "checksums"])
    got = [tuple(r.values()) for b in token_files._documents(iter([batch])) for r in b.to_pylist()]
    assert got == want


def test_coder_round_trips():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, high, rng.integers(1, 3000)) for high in (1, 2, 300, 50_257, 65_536) for _ in range(5)]
    blocks += [np.array([65_535]), np.zeros(token_files.BLOCK, int), np.tile(rng.integers(0, 50_000, 37), 120)[:token_files.BLOCK]]
    codes = token_files.encode_blocks(blocks)
    for block, back in zip(blocks, token_files.decode_blocks(codes, list(map(len, blocks)))):
        assert (block == back).all()
    assert len(codes[-1]) < len(blocks[-1]) / 2
    assert token_files.encode_blocks([]) == [] and token_files.decode_blocks([], []) == []


def test_wide_ids_round_trip_and_larger_ones_are_refused():
    rng = np.random.default_rng(5)
    top = token_files.IDS - 1
    blocks = [rng.integers(0, token_files.IDS, 3000), rng.integers(65_530, 65_545, 4096), np.array([65_534, 65_535, 65_536, 0, top]),
              np.full(token_files.BLOCK, top), np.arange(token_files.BLOCK) * 70, np.tile(rng.integers(0, 200_000, 37), 100)]
    codes = token_files.encode_blocks(blocks)
    for block, back in zip(blocks, token_files.decode_blocks(codes, list(map(len, blocks)))):
        assert (block == back).all()
    # a block does not depend on those coded beside it
    assert codes == [token_files.encode_blocks([b])[0] for b in blocks]
    for wrong in (top + 1, -1):
        with pytest.raises(ValueError, match="token ids"):
            token_files.encode_blocks([np.array([1, wrong])])


def test_states_and_events_equal_those_met_id_by_id():
    rng = np.random.default_rng(6)
    ids = np.stack([rng.integers(0, high, 700) for high in (1, 2, 5, 40, 50_000)] + [np.tile(rng.integers(0, 50_000, 7), 100)])
    state, event = token_files._events(ids)
    model = token_files._Model(len(ids))
    for t in range(ids.shape[1]):
        now, context = ids[:, t], model.predict(len(ids))
        met = np.where(context[5] == now, 0, np.where(context[4] == now, 1, 2))
        assert (context[6] - model.state_row == state[:, t]).all() and (met == event[:, t]).all()
        model.learn(now, met, *context)


def test_damage_is_found():
    ids = np.arange(9000) % 700
    codes, counts, checksums = token_files.pack(ids)
    assert (token_files.unpack(codes, counts, checksums) == ids).all()
    broken = bytearray(codes[1])
    broken[40] ^= 255
    with pytest.raises(ValueError):
        token_files.unpack([codes[0], bytes(broken), *codes[2:]], counts, checksums)


def test_token_file_round_trip(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    start, want = 0, []
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.round_trip(docs, path, 2)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids)))) for r in got.collect())
    assert token_files.round_trip(none, path, 2).count() == 0


def test_line_features_of_odd_texts():
    data = np.frombuffer("a a a b\n\nÉ!x".encode(), np.uint8)
    offsets = np.array([0, 0, len(data), len(data)])
    x, length, per_text = quality.line_features(data, offsets)
    assert per_text.tolist() == [1, 3, 1] and length.tolist() == [0, 7, 0, 4, 0]
    assert x[1, 12] == 0.5 and x[2, :13].sum() == 1.1 and np.isfinite(x).all()


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    score, moves = rng.normal(size=5), rng.normal(size=(2, 2))
    good, pairs = quality.Chains(np.array([2, 3])).marginals(score, moves)
    want, seen = np.zeros(5), np.zeros((2, 2))
    for at, n in ((0, 2), (2, 3)):
        paths = [[p >> i & 1 for i in range(n)] for p in range(1 << n)]
        weight = np.exp([sum(score[at + i] * y for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
        weight /= weight.sum()
        for p, w in zip(paths, weight):
            want[at:at + n] += w * np.array(p)
            for a, b in zip(p, p[1:]):
                seen[a, b] += w
    assert good == pytest.approx(want) and pairs == pytest.approx(seen)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    common = ["alpha", "beta", "gamma", "delta", "kappa", "sigma", "omega"]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(common) + rng.choice("abcdefgh") for _ in range(60)]
        bad, toxic = i % 4 == 0, i % 5 == 1
        lines = [" ".join(words[j:j + 12]).capitalize() + "." for j in range(0, 60, 12)]
        if bad:
            lines[1:] = [x.upper().replace(" ", "!! ") for x in lines[1:]]
        if toxic:
            lines[0] += " you vile scoundrel, vile"
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(not bad), int(toxic)))
    return (spark.createDataFrame([*docs, (None, None), (9000, ""), docs[0]], "doc_id bigint, text string"),
            spark.createDataFrame([*labels, (None, 1, 0), (3, None, None)], "doc_id bigint, quality int, toxic int"))


def test_quality_of_unseen_documents(labelled, none):
    docs, labels = labelled
    model = quality.train(docs, labels)
    out = quality.score(docs, model, lines=True).collect()
    assert len(out) == 903 and all(0 <= r.score <= 1 for r in out)
    unseen = [r for r in out if r.row.doc_id is not None and r.row.doc_id < 900 and zlib.crc32(str(r.row.doc_id).encode()) % 5 == 0]
    assert len(unseen) > 100 and all((r.score >= quality.THRESHOLD) == (r.row.doc_id % 4 != 0) for r in unseen)
    assert all(len(r.good_lines) == (r.row.text or "").count("\n") + 1 for r in out)
    assert quality.score(none, model).count() == 0
    unlabelled = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, unlabelled).collect()} == {0.5}


def test_toxicity_of_unseen_documents(labelled, none):
    docs, labels = labelled
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == 903 and all(0 <= r.score <= 1 for r in out)
    known = [r for r in out if r.doc_id is not None and r.doc_id < 900]
    assert all((r.score >= 0.5) == (r.doc_id % 5 == 1) for r in known)
    assert all(r.neighbours for r in known if r.doc_id % 5 == 1)
    assert toxicity.toxicity(none, labels).count() == 0
    assert len({r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()}) == 1


def test_block_max_search_is_exact():
    rng = np.random.default_rng(7)
    index = toxicity.BlockMaxIndex(30, block=4)
    dense = []
    for i in range(101):
        terms = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        weights = rng.integers(1, 4, len(terms)).astype(float)
        index.add(i, 0, terms, weights)
        dense.append(np.bincount(terms, weights, 30) / np.linalg.norm(weights))
    index.build()
    for _ in range(50):
        terms = np.sort(rng.choice(30, 4, replace=False))
        weights = rng.integers(1, 4, 4).astype(float)
        cosine = np.round(np.array(dense) @ (np.bincount(terms, weights, 30) / np.linalg.norm(weights)), 12)
        want = [(c, i) for c, i in sorted(zip(cosine, range(101)), key=lambda x: (-x[0], x[1])) if c > 0][:9]
        got = index.nearest(terms, weights, 9)
        assert [p for _, p in got] == [i for _, i in want] and [c for c, _ in got] == pytest.approx([c for c, _ in want])


def test_toxic_words_outside_the_lexicon_count(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    common = [f"plain{a}{b}" for a in letters for b in "xyz"]
    # Toxic documents of thirty kinds with words of their own, each kind too rare for the lexicon.
    docs = [(i, " ".join(rng.choices(common, k=12) + ([f"odd{letters[i // 5 % 30 % 26]}{i // 5 % 30 // 26 * 'q'}z{a}" for a in letters[:20]] if i % 5 == 1 else [])))
            for i in range(900)]
    out = toxicity.toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"),
                            spark.createDataFrame([(i, int(i % 5 == 1)) for i, _ in docs], "doc_id bigint, toxic int")).collect()
    assert all(len(r.neighbours) == toxicity.NEIGHBOURS for r in out)
    # Toxic documents no word of which is tied strongly enough to enter the lexicon.
    beyond = [r for r in out if r.doc_id % 5 == 1 and not r.terms]
    assert len(beyond) > 100 and sum(r.score >= 0.5 for r in beyond) > 0.8 * len(beyond)
    assert sum(r.score >= 0.5 for r in out if r.doc_id % 5 != 1) <= 5


def test_search_over_all_terms_is_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "HOT_TERMS", 5)
    rng = np.random.default_rng(9)
    idf = rng.integers(1, 4, 40).astype(float)
    rows = [(np.sort(rng.choice(40, rng.integers(1, 9), replace=False)), np.ones(0)) for _ in range(300)]
    rows = [(t, rng.integers(1, 4, len(t)).astype(float)) for t, _ in rows]
    dense = np.array([np.bincount(t, (1 + np.log(c)) * idf[t], 40) for t, c in rows])
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    index = toxicity.TermIndex(np.arange(200), np.zeros(200), idf).build(rows[:200])
    assert len(index.dense) == 5
    for at, (cosines, places) in enumerate(index.nearest(rows, 9)):
        own = np.round(dense[:200] @ dense[at], 12)
        want = [p for p in np.lexsort((np.arange(200), -own)) if own[p] > 0][:9]
        assert places.tolist() == want and cosines == pytest.approx(own[want])
