"""The pipeline's stages chained, against their operators' promises and a plain version of its decisions."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from chainstrata.llm import QUERIES, SQL, quality, simhash
from chainstrata.llm.columns import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    cursor = connection.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    result = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(result.columns)
    assert Counter(tuple(row[c] for c in names) for row in result.collect()) == Counter(cursor.fetchall())


def test_stages_on_given_tables(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "tokens":
            assert kept[name].columns == docs.columns
            before = kept[name]
    texts = {n: [(r.doc_id, r.text) for r in f.collect()] for n, f in kept.items() if n != "tokens"}
    scores = {r.row.doc_id: r.score for r in quality.score(docs, quality.train(docs, table(spark, SF, "labels"))).collect()}
    assert {i for i, _ in texts["quality"]} == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    # Lines of ten characters or more that occur in an earlier document are gone.
    seen, want = {}, {}
    for i, text in sorted(texts["quality"]):
        lines, out = text.split("\n"), []
        for line in lines:
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
            if len(key) < 10 or seen.setdefault(key, i) == i:
                out.append(line)
        want[i] = "\n".join(out)
    assert dict(texts["lines"]) == want
    prints = [(i, simhash.fingerprint(t)) for i, t in sorted(texts["lines"])]
    root = {}
    for i, p in prints:
        near = {root[j] for j, q in prints if j in root and (p ^ q).bit_count() <= 4}
        root[i] = min(near, default=i)
        for j in root:
            if root[j] in near:
                root[j] = root[i]
    assert sorted(i for i, _ in texts["near_duplicates"]) == sorted(set(root.values()))
    sizes = {i: len(t.split()) for i, t in texts["near_duplicates"]}
    taken = sum(sizes[i] for i, _ in texts["mix"])
    assert abs(taken / sum(sizes.values()) - 1.5) < 0.15
    assert kept["tokens"].count() == len(texts["mix"]) == corpus_pipeline.run(spark, SF).count()


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, _id string, score double, copies int"


def odd_rows():
    base = " ".join(f"common{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    texts = [(1, base), (1, other), (2, base), (3, third), (3, third), (None, third), (None, "only without an id, of some words"), (4, None), (5, ""),
             (6, "word " * 40_000), (7, "a line of its own\nand another\n\n")]
    return [(i, t, "en", None if i == 3 else "s", len(t or ""), 1, "c", 0.5, 7) for i, t in texts]


def test_no_text_is_lost_unless_it_repeats(spark):
    docs = spark.createDataFrame(odd_rows(), ODD).repartition(3)
    kept = corpus_pipeline.one_of_each(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    rows = [(i is None, i or 0, t) for i, t, *_ in odd_rows()]
    want = {}
    for no_id, i, t in sorted(rows, key=lambda r: (r[0], r[1])):
        p = simhash.fingerprint(t)
        root = next((q for q in want if (p ^ q).bit_count() <= 4), p)
        want.setdefault(root, (no_id, i, t or ""))
    assert got == sorted(want.values()) and len(got) == 7


@pytest.mark.parametrize("rows", [odd_rows(), []])
def test_stages_take_odd_rows(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, ODD)
    counts = {}
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        stored = spark.read.parquet(str(tmp_path / name))
        counts[name] = stored.count()
        if name != "tokens":
            assert stored.columns == docs.columns
            docs = stored
    assert counts["lines"] == len(rows) and (counts["tokens"] == counts["mix"] > 0 or not rows)


TYPES = {
    "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_one_bit_codes": "query_id bigint, rank int, vec_id bigint, score double",
}


@pytest.mark.parametrize("name", sorted(TYPES))
def test_registered_queries_without_sql(spark, name):
    out = QUERIES[name](spark, SF)
    have = {f.name: f.dataType.simpleString() for f in out.schema}
    assert {c: have[c] for c in (x.split()[0] for x in TYPES[name].split(", "))} == dict(x.split() for x in TYPES[name].split(", "))
    source = "embeddings" if name.startswith("op10") else "documents"
    n = table(spark, SF, source).count()
    assert out.count() == (n if source == "documents" else 20 * -(-n // 20))
