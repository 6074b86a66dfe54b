"""Personal data, importance resampling and vector codes against plain versions and their SQL twins."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainstrata.llm import cover_tree, importance, pii
from chainstrata.llm.queries import SQL

SCHEMA = "doc_id bigint, text string, lang string, kind int, spans string, score double"
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ODD = [
    None, "", "\n", "no data here", "a@b.c_d@e.f, x@y @z.w a@b..c Ab.c-d%e@F-g.h.i. \U0001F600é@q.r",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.999 000255.0.0.1 1.2.3", "4111 1111 1111 1111, 4111111111111111x 4111-1111-1111-1112",
    "9 4111 1111 1111 1111", "41111111 11111111  4111111111111111 55  6", "+1 (499) 555-6503 and +123456789, +12 +1--------9 +4 4 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+4111111111111111", "x" * 3000, "1" * 3000, "1." * 3000, "a@" + "b." * 3000 + "c", "a@b.c " * 3000, "+" * 1000 + "+1" + " " * 3000,
]
SECRET = "Word of Zorblax and ordinary people: write to Jane.Roe@mail.example.com about %s"


def pii_rows():
    out = [(i, t, "en", 1, "clash", 0.5) for i, t in enumerate(ODD)]
    out += [(100 + i, SECRET % f"item{chr(97 + i)}", "en", 1, None, None) for i in range(5)]
    out += [(200 + i, "ordinary people write about this and that of the word", None, None, None, None) for i in range(30)]
    out += [(300, "zorblax alone", "en", 1, "s", 0.0), (301, "Vrim jane.roe@MAIL.example.com Zorblaxes ZORBLAX", "en", 1, "s", 0.0)]
    return [*out, out[4], out[4], (None, "a@b.c", None, None, None, None), (None, None, None, None, None, None)]


def _holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _base(text):
    return sorted((m.start(), n, m.end()) for n, k in enumerate(FORMS) for m in re.finditer(FORMS[k], text) if _holds(k, m.group()))


def _terms(text):
    return {w for w in re.findall(r"[^\W\d_]+", text.lower()) if 3 <= len(w) <= 40}


def _flagged(rows):
    """Terms to mask per document, from plain counts."""
    near, held, n_term = {}, {}, Counter()
    for i, t in rows:
        n_term.update(_terms(t))
        last = Counter()
        spans = _base(t)
        for nth, kind in enumerate(FORMS):
            every = [(m.start(), m.end()) for m in re.finditer(FORMS[kind], t)]
            for j, (a, b) in enumerate(every):
                if (a, nth, b) not in spans:
                    continue
                if kind in ("email", "ip"):
                    value = t[a:b].lower()
                else:
                    value = re.sub("[^0-9]", "", t[a:b])
                head, tail = t[last[kind, j - 1] if j else 0:a][-80:], t[b:every[j + 1][0] if j + 1 < len(every) else len(t)][:80]
                last[kind, j] = b
                if len(head) == 80:
                    head = re.sub(r"^[^\x20\x09-\x0D]+", "", head)
                if len(tail) == 80:
                    tail = re.sub(r"[^\x20\x09-\x0D]+$", "", tail)
                context = re.sub(r"[^\x20\x09-\x0D]*@[^\x20\x09-\x0D]*", " ", head + " " + tail)
                near.setdefault((kind, value), {}).setdefault(i, set()).update(_terms(context))
                held.setdefault(i, set()).add((kind, value))
    out = {}
    for entity, docs in near.items():
        for term, n in Counter(w for terms in docs.values() for w in terms).items():
            known = math.log(len(rows) / len(docs))
            if n >= 3 and known > 0 and round(1 - math.log(n_term[term] / n) / known, 9) >= 0.8:
                for i, terms in docs.items():
                    if term in terms:
                        out.setdefault(i, set()).add(term)
    return out


def test_personal_data_matches_a_plain_version(spark):
    rows = pii_rows()
    got = pii.digests(pii.find(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    assert len(got) == len(rows)
    keyed = [(n, r[1] or "") for n, r in enumerate(rows)]
    flagged = _flagged(keyed)
    want = []
    for n, t in keyed:
        base = _base(t)
        spans = [(m.start(), 4, m.end()) for m in re.finditer(r"[^\W\d_]+", t) if m.group().lower() in flagged.get(n, ())]
        spans = [(a, k, b) for a, k, b in spans if not any(x < b and y > a for x, _, y in base)]
        text = [",".join(f"{[*FORMS, 'term'][k]}:{a}:{b}" for a, k, b in s) for s in (base, sorted(base + spans))]
        want.append((rows[n][0], *[sum(k == j for _, k, _ in base) for j in range(4)], hashlib.sha256(text[0].encode()).hexdigest(), text[1]))
    assert Counter(map(tuple, got)) == Counter(want)
    assert "term:" in dict((r.doc_id, r.spans) for r in got)[100]
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_personal_data_matches_its_sql(spark):
    rows = [r for r in pii_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    connection = duckdb.connect()
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    connection.register("documents", documents)
    got = pii.digests(pii.find(spark.createDataFrame(rows, SCHEMA)))
    cursor = connection.execute(SQL["op11_pii"])
    names = [d[0] for d in cursor.description]
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(cursor.fetchall())


def test_sanitised_texts_hold_no_entity_and_no_telling_term(spark):
    got = {r.row.doc_id: r for r in pii.sanitise(spark.createDataFrame(pii_rows(), SCHEMA)).collect()}
    assert got[100].clean_text == "Word of [NAME] and ordinary people: write to [EMAIL] about itema"
    assert got[300].clean_text == "zorblax alone" and got[3].clean_text == "no data here"
    assert got[0].clean_text is None and got[1].clean_text == "" and got[301].clean_text == "Vrim [EMAIL] Zorblaxes [NAME]"
    assert got[9].clean_text.startswith("[PHONE] and [PHONE], +12 ") and got[10].clean_text == "[PHONE]" or got[10].clean_text == "+[CARD]"
    assert got[15].clean_text == "[EMAIL] " * 3000 and got[101].row.spans is None


def test_very_long_texts_take_linear_time(spark):
    n = 1_000_000
    texts = ["x" * n, "1" * n, "1." * n, "1 " * n, "a@" + "b." * n + "c", "+1" + " " * n, "a@b.c " * 100_000, "@" * n]
    found = pii.digests(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")))
    counts = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found.collect()}
    assert [counts[i] for i in range(8)] == [(0, 0, 0, 0), (0, 0, 0, 0), (0, n // 4, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 0), (100_000, 0, 0, 0), (0, 0, 0, 0)]


def test_telling_terms_go_altogether(spark):
    rows = [(i, f"call +1 499 555 6503 Vrimmel{' and so on' * (i % 2)}") for i in range(4)] + [(9 + i, f"call and so on {i}") for i in range(90)]
    got = pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.clean_text for r in got if r.row.doc_id < 4} == {"call [PHONE] ", "call [PHONE]  and so on"}


def _features(text, ngrams=1):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return [zlib.crc32(" ".join(w[j:j + k]).encode()) for k in range(1, ngrams + 1) for j in range(len(w) - k + 1)]


def importance_rows():
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(200)] + ["É", "中文", "x9"]
    out = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 60))), "en", 1, "c", 0.0) for i in range(300)]
    return [*out, out[7], out[7], (900, None, None, None, None, None), (901, "", "", 0, "", 0.0), (902, "q" * 100_000 + " A" * 30_000, "", 0, "", 0.0),
            (903, "-.,;: \n" * 50, "", 0, "", 0.0), (None, "w1 " * 30, "", 0, "", 0.0)]


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_features_match_plain_crcs(ngrams):
    texts = ["a b", "", None, "x", "Ab é中 zz zz", "  ", "9a-b", "q" * 300 + " w" * 3]
    for given in (pa.array(texts), pa.array(["skip", *texts])[1:]):
        found, owner, _ = importance.feature_buckets(given, ngrams, 10**9 + 7)
        want = sorted((i, c % (10**9 + 7)) for i, t in enumerate(texts) for c in _features(t, ngrams))
        assert sorted(zip(owner.tolist(), found.tolist())) == want
    for none in ([None, "", "-"], []):
        assert not len(importance.feature_buckets(pa.array(none, pa.string()), ngrams, 100)[0])


def test_importance_matches_a_plain_version(spark):
    rows, target = importance_rows(), [("w1 w2 w3 w1 É",), (None,), ("",)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    wanted = spark.createDataFrame(target, "text string")
    drawn = importance.draw(importance.weigh(docs, wanted)).collect()
    counts = [np.zeros(10_000), np.zeros(10_000)]
    for held, texts in zip(counts, ([r[1] for r in rows], [t for t, in target])):
        for t in texts:
            for c in _features(t):
                held[c % 10_000] += 1
    s, t = counts
    gain = [math.floor(1000 * math.log((t[i] + 1) * (s.sum() + 10_000) / ((s[i] + 1) * (t.sum() + 10_000)))) for i in range(10_000)]
    want = []
    for i, text, *_ in rows:
        f = [gain[c % 10_000] for c in _features(text)]
        weight = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    assert Counter((r.id, r.n_features, r.weight, r.score) for r in drawn) == Counter(want)
    able = sorted((-w[3], w[0] is None, w[0] or 0) for w in want if w[1] >= 20)
    ranks = sorted((r["rank"], -r.score, r.id is None, r.id or 0) for r in drawn if r["rank"])
    assert ranks == [(n, *a) for n, a in enumerate(able[:len(able) * 10 // 100], 1)]
    chosen = importance.resample(docs, wanted).collect()
    assert sorted((r["rank"], r.row.doc_id) for r in chosen) == sorted((r["rank"], r.id) for r in drawn if r["rank"])
    empty = spark.createDataFrame([], SCHEMA)
    assert importance.resample(empty, wanted).count() == 0
    assert importance.draw(importance.weigh(docs, empty)).count() == len(rows)


def _plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(float(x) * 4096) for x in e], label) for i, e, label, *_ in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = [[v[p * width:(p + 1) * width] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(x, books[p])[1] for x in cut[p]]
            for j in range(len(books[p])):
                mine = [x for x, o in zip(cut[p], own) if o == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(x, books[p]) for x in cut[p]] for p in range(parts)]
    errors = [sum(found[p][n][0] for p in range(parts)) for n in range(len(kept))]
    by_label = Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    top = (1 << 63) - 1
    return Counter((i, "".join("%02x" % found[p][n][1] for p in range(parts)), min(errors[n], top), min(by_label[label], top))
                   for n, (i, _, label) in enumerate(kept)), digest


def code_rows():
    random.seed(5)
    centres = [[random.gauss(0, 0.3) for _ in range(24)] for _ in range(7)]
    out = [(i, [c + random.gauss(0, 0.05) for c in centres[i % 7]], [i % 5, None][i % 11 == 0], "code", 1) for i in range(400)]
    odd = [(500, None, 1, "x", 0), (501, [None] * 24, 1, "x", 0), (502, [float("nan")] * 24, 1, "x", 0), (503, [float("inf")] + [0.0] * 23, 1, "x", 0),
           (None, [0.5] * 24, 2, "x", 0), (504, [], 3, "x", 0), (505, [0.1] * 20, None, "x", 0)]
    return [*out, *[out[3]] * 150, *odd]


VECTORS = "vec_id bigint, embedding array<double>, label int, code string, error int"


@pytest.mark.parametrize("case", ["all", "few", "wide", "lone"])
def test_codes_match_plain_rounds(spark, case):
    rows = code_rows()
    if case == "few":
        rows = [(i, [x] * 8, 1, "", 0) for i, x in [(3, 0.1), (1, -0.2), (2, 0.1), (2, 0.1)]]
    if case == "wide":
        rows = [(i, [random.uniform(-1e11, 1e11) for _ in range(8)], i % 2, "", 0) for i in range(60)]
    if case == "lone":
        rows = [(1, [], None, "", 0)]
        rows = [(1, [0.25], None, "", 0)]
    coded, books = cover_tree.compress(spark.createDataFrame(rows, VECTORS).repartition(3))
    got = cover_tree.with_label_error(coded)
    want, digest = _plain_codes(rows)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want
    assert cover_tree.codebook_digest(books) == digest


def test_codes_hold_limits_and_empty_tables(spark):
    rows = [(1, [1e300, -1e300], 1, "", 0), (2, [0.0, 0.0], 1, "", 0)] + [(3, [1e300, 0.0], 1, "", 0)] * 20
    coded, _ = cover_tree.compress(spark.createDataFrame(rows, VECTORS), parts=1, entries=1)
    assert max(r.label_error for r in cover_tree.with_label_error(coded).collect()) == (1 << 63) - 1
    for none in ([], [(1, None, 1, "", 0)]):
        coded, _ = cover_tree.compress(spark.createDataFrame(none, VECTORS))
        assert cover_tree.with_label_error(coded).count() == 0


def test_trees_cover_settle_and_agree():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (6, 4))
    points = np.concatenate([centres[rng.integers(0, 6, 3000)] + rng.integers(-60, 60, (3000, 4)), np.repeat(centres[:1], 500, axis=0)])
    tree = cover_tree.Tree.build(points)
    for (centre, start, end, _, _), reach in zip(tree.nodes.tolist(), tree.radius):
        assert np.sqrt(((tree.points[start:end] - tree.points[centre]) ** 2).sum(axis=1)).max() <= reach + 1e-6
    codes, counts, sums, compared = tree.assign(centres)
    own = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (codes[np.argsort(tree.order)] == own).all() and (counts == np.bincount(own, minlength=6)).all()
    assert all((sums[j] == points[own == j].sum(axis=0)).all() for j in range(6))
    assert compared < len(points) / 10  # most points go with their subtree
    ties = cover_tree.Tree.build(np.array([[0], [0], [2], [-2]] * 20)).assign(np.array([[1], [-1], [1]]))
    assert set(zip(cover_tree.Tree.build(np.array([[0], [0], [2], [-2]] * 20)).points[:, 0].tolist(), ties[0].tolist())) == {(0, 0), (2, 0), (-2, 1)}
