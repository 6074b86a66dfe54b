"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are runs of letters, lower-cased. The neighbours of a document are sought in
the space of all terms of a bounded set of labelled examples; terms no example
holds add nothing to a dot product and scale all cosines of a document alike, so
neither the order of its neighbours nor their weighted votes depend on them.
Document frequencies are counted over all documents. Frequent terms meet all
examples in a matrix product, the others through postings: nothing is pruned.

In long texts a few toxic words move that cosine little. A second vote therefore
comes from the terms the labels of a bounded sample tie most strongly to toxic
documents (the lexicon; all other words count as one further term), by an inverted
index in blocks whose largest weights bound the cosines. Both votes are calibrated on
sample documents in neither index: documents with lexicon terms on both votes, the
others on the vote over all terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainstrata.llm.columns import in_small_batches
from chainstrata.llm.quality import _climb, _sigmoid, sampled
from chainstrata.session import materialized

SAMPLE = 20_000
EXAMPLES = 4000
TERMS = 256
NEIGHBOURS = 15
BLOCK = 64
# At most so many terms, each of more than one in HOT_SHARE examples, go into the matrix; documents per product.
HOT_TERMS, HOT_SHARE, TOGETHER = 512, 20, 128
# A term enters the vocabulary beyond this log-likelihood ratio and this lift.
LEAST_G2, LEAST_LIFT = 24.0, 2.0
_LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> Counter:
    return Counter(_LETTERS.findall(text.lower())) if text else Counter()


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1)):
            terms = list(terms_of(text.as_py()))
            for at in range(0, len(terms), 10_000):
                some = terms[at:at + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([label.as_py()] * len(some), pa.int32())],
                                                 ["term", "label"])


def _g2(a, b, c, d):
    """Log-likelihood ratio of a 2 x 2 table."""
    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    n = a + b + c + d
    return 2 * (part(a, (a + b) * (a + c) / n) + part(b, (a + b) * (b + d) / n)
                + part(c, (c + d) * (a + c) / n) + part(d, (c + d) * (b + d) / n))


def choose_terms(sample: DataFrame, limit: int = TERMS) -> list[str]:
    """The at most ``limit`` terms most tied to label 1; counted per document and combined before the shuffle."""
    totals = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    toxic, clean = float(totals[0]), float(totals[1] - totals[0])
    if not toxic or not clean:
        return []
    counts = (
        sample.select("text", "label").mapInArrow(_term_rows, "term string, label int")
        .groupBy("term").agg(F.sum("label").cast("double").alias("a"), F.count("*").cast("double").alias("n"))
    )
    a, b = F.col("a"), F.col("n") - F.col("a")
    rated = counts.withColumn("g2", _g2(a, b, F.lit(toxic) - a, F.lit(clean) - b))
    lifted = (a / F.lit(toxic)) >= LEAST_LIFT * (b / F.lit(clean))
    best = rated.filter(lifted & (F.col("g2") >= LEAST_G2)).orderBy(F.desc("g2"), "term").limit(limit)
    return [r.term for r in best.select("term").collect()]


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(terms_of(text.as_py())) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["terms"])


def example_terms(examples: DataFrame, lexicon: list[str]) -> list[str]:
    """The lexicon, then all other terms of the bounded ``examples``, in order."""
    found = in_small_batches(examples.select("text")).mapInArrow(_term_lists, "terms array<string>")
    others = found.select(F.explode("terms").alias("term")).distinct().toArrow().column(0).to_pylist()
    return lexicon + sorted(set(others) - set(lexicon))


def _vectors(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, words = [], [], []
            for text in batch.column(1):
                seen = terms_of(text.as_py())
                pairs = sorted((vocabulary[t], n) for t, n in seen.items() if t in vocabulary)
                found.append([t for t, _ in pairs])
                counts.append([n for _, n in pairs])
                words.append(seen.total())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())), pa.array(words, pa.int64())],
                ["doc_id", "terms", "counts", "words"])
    return run


def term_vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, terms, counts, words) of every row of (doc_id, text): vocabulary terms by number with their counts, and the number of all words."""
    numbers = {t: i for i, t in enumerate(vocabulary)}
    return in_small_batches(docs.select("doc_id", "text")).mapInArrow(
        _vectors(numbers), "doc_id bigint, terms array<int>, counts array<bigint>, words bigint")


@dataclass
class BlockMaxIndex:
    """Unit vectors of examples as postings, cut into blocks of ``block`` examples.

    ``add`` examples in order of id: ties go to the smaller one.
    """

    size: int
    block: int = BLOCK
    ids: list[int] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    rows: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def add(self, doc_id: int, label: int, terms: np.ndarray, weights: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.labels.append(label)
        self.rows.append((terms, weights / np.linalg.norm(weights)))

    def build(self) -> BlockMaxIndex:
        blocks = -(-len(self.rows) // self.block)
        self.bounds = np.zeros((self.size, blocks))
        gathered: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for at, (terms, weights) in enumerate(self.rows):
            for t, w in zip(terms.tolist(), weights.tolist()):
                b = at // self.block
                self.bounds[t, b] = max(self.bounds[t, b], w)
                gathered.setdefault((t, b), []).append((at % self.block, w))
        self.postings = {k: (np.array([p for p, _ in v]), np.array([w for _, w in v])) for k, v in gathered.items()}
        return self

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The at most ``k`` examples of largest cosine above 0, nearest first, as (cosine, position)."""
        unit = weights / np.linalg.norm(weights)
        bounds = unit @ self.bounds[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable").tolist():
            # Rounding may leave a bound just below a cosine it covers.
            if bounds[b] <= 0 or len(best) == k and bounds[b] < -best[-1][0] - 1e-9:
                break
            cosines = np.zeros(self.block)
            for t, w in zip(terms.tolist(), unit.tolist()):
                if (t, b) in self.postings:
                    places, values = self.postings[t, b]
                    cosines[places] += w * values
            found = np.flatnonzero(cosines > 0)
            best = sorted(best + [(-round(c, 12), b * self.block + p) for p, c in zip(found.tolist(), cosines[found].tolist())])[:k]
        return [(-c, p) for c, p in best]


@dataclass
class TermIndex:
    """Unit vectors of examples over all terms. Terms of many examples are rows of a matrix, the others have postings."""

    ids: np.ndarray
    labels: np.ndarray
    idf: np.ndarray

    def build(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> TermIndex:
        """``rows`` are the terms and counts of the examples, in order of id: ties go to the smaller one."""
        terms = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, int)
        places = np.repeat(np.arange(len(rows)), [len(t) for t, _ in rows])
        weights = np.concatenate([self.unit(t, c) for t, c in rows]) if rows else np.zeros(0)
        order = np.argsort(terms, kind="stable")
        self.places, self.weights = places[order], weights[order]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=len(self.idf)))))
        held = np.diff(self.starts)
        hot = [t for t in np.argsort(-held, kind="stable")[:HOT_TERMS].tolist() if held[t] * HOT_SHARE > len(rows)]
        self.row_of = np.full(len(self.idf), -1)
        self.row_of[hot] = np.arange(len(hot))
        self.dense = np.zeros((len(hot), len(rows)))
        for at, t in enumerate(hot):
            own = slice(self.starts[t], self.starts[t + 1])
            self.dense[at, self.places[own]] = self.weights[own]
        return self

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[terms]
        return weights / np.linalg.norm(weights) if len(weights) else weights

    def nearest(self, rows: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each row (terms, counts) the at most ``k`` examples of largest cosine above 0, nearest first, as (cosines, positions)."""
        for at in range(0, len(rows), TOGETHER):
            some = rows[at:at + TOGETHER]
            queries = [self.unit(t, c) for t, c in some]
            left = np.zeros((len(some), len(self.dense)))
            for i, (terms, _) in enumerate(some):
                row = self.row_of[terms]
                left[i, row[row >= 0]] = queries[i][row >= 0]
            cosines = left @ self.dense
            for i, (terms, _) in enumerate(some):
                rare = self.row_of[terms] < 0
                first = self.starts[terms[rare]]
                size = self.starts[terms[rare] + 1] - first
                at_posting = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum()) if len(first) else first
                own = cosines[i]
                if len(at_posting):
                    own = own + np.bincount(self.places[at_posting], self.weights[at_posting] * np.repeat(queries[i][rare], size), len(own))
                own = np.round(own, 12)
                least = max(np.partition(own, -k)[-k], 1e-12) if len(own) >= k else 1e-12
                found = np.flatnonzero(own >= least)
                found = found[np.argsort(-own[found], kind="stable")][:k]
                yield own[found], found


@dataclass
class Model:
    """``idf``, ``index``: the lexicon and its "other words" term; ``whole``: all terms. Each calibration ends in the shift."""

    vocabulary: list[str]
    lexicon: int
    idf: np.ndarray
    index: BlockMaxIndex
    whole: TermIndex
    neighbours: int
    empty: float
    bare: np.ndarray
    both: np.ndarray

    def in_lexicon(self, terms: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights in the lexicon's space."""
        own = terms < self.lexicon
        terms, counts = terms[own], counts[own]
        if len(terms) and words > counts.sum():
            terms, counts = np.append(terms, self.lexicon), np.append(counts, words - counts.sum())
        return terms, (1 + np.log(counts)) * self.idf[terms]

    def votes(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Iterator[tuple[float | None, float | None, np.ndarray]]:
        """Shares of toxic neighbours, weighted by cosine, in the lexicon and over all terms, and the latter's positions."""
        for row, (cosines, near) in zip(rows, self.whole.nearest([r[:2] for r in rows], self.neighbours)):
            terms, weights = self.in_lexicon(*row)
            close = self.index.nearest(terms, weights, self.neighbours) if len(terms) and self.index.ids else []
            total = sum(c for c, _ in close)
            lexical = sum(c * self.index.labels[p] for c, p in close) / total if total else None
            yield lexical, float(cosines @ self.whole.labels[near] / cosines.sum()) if len(near) else None, near

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Iterator[tuple[float, np.ndarray]]:
        for lexical, whole, near in self.votes(rows):
            if lexical is not None:
                yield float(_sigmoid(np.array([lexical - 0.5, (whole or 0.0) - 0.5, 1.0]) @ self.both)), near
            elif whole is not None:
                yield float(_sigmoid(np.array([whole - 0.5, 1.0]) @ self.bare)), near
            else:
                yield self.empty, near


def _share(toxic: int, n: int, prior: float = 0.1) -> float:
    return (toxic + prior) / (n + 1)


def _calibrated(shares: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slopes (none below 0) and shift of the votes ``shares``, a row a document."""
    n = shares.shape[1]
    if len(set(label.tolist())) < 2:
        share = _share(label.sum(), len(label))
        return np.append(np.zeros(n), np.log(share / (1 - share)))
    x = np.column_stack([shares - 0.5, np.ones(len(shares))])
    ridge = np.append(np.full(n, 1e-3), 0.0)
    # A slope below 0 is held at 0 while the others are fitted.
    held = np.ones(n + 1)
    while True:
        found = _climb(lambda c: held * (x.T @ (_sigmoid(x @ (held * c)) - label) / len(label) + ridge * c), held * np.append(np.full(n, 8.0), 0.0), 600)
        if not (found[:n] < 0).any():
            return found
        held[:n][found[:n] < 0] = 0.0


def _rows(table: pa.Table | pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(terms, counts, words) of every row."""
    terms, counts = table.column("terms"), table.column("counts")
    return [(np.asarray(t.values.to_numpy(zero_copy_only=False), int), c.values.to_numpy(zero_copy_only=False).astype(float), w)
            for t, c, w in zip(terms, counts, table.column("words").to_pylist())]


def train(sample: DataFrame, vectors: DataFrame, vocabulary: list[str], lexicon: int, examples: Sequence[int],
          limit: int = EXAMPLES, neighbours: int = NEIGHBOURS) -> Model:
    """Indexes and calibration from a bounded ``sample`` (doc_id, text, label), a row per id.

    Its vectors come to the driver. ``examples`` are the ids of the half of the sample
    from which both indexes take up to ``limit`` rows; the other half calibrates.
    """
    n_docs = vectors.count()
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toArrow()
    idf = np.full(len(vocabulary), math.log(1 + n_docs) + 1)
    idf[df.column("term").to_numpy()] = np.log((1 + n_docs) / (1 + df.column("n").to_numpy())) + 1
    found = term_vectors(sample, vocabulary).join(F.broadcast(sample.select(F.col("doc_id").alias("_doc"), "label")), F.col("doc_id") == F.col("_doc"))
    found = found.select("doc_id", "terms", "counts", "words", "label").toArrow().sort_by("doc_id").combine_chunks()
    ids, labels, rows = found.column("doc_id").to_pylist(), found.column("label").to_pylist(), _rows(found)
    chosen = set(examples)
    taken = [at for at, i in enumerate(ids) if i in chosen]
    # The bounded examples over all terms: those whose terms made the vocabulary.
    first = set(examples[:limit])
    full = [at for at in taken if len(rows[at][0]) and ids[at] in first]
    whole = TermIndex(np.array([ids[at] for at in full], int), np.array([labels[at] for at in full], float), idf).build([rows[at][:2] for at in full])
    bare = [labels[at] for at in range(len(ids)) if not len(rows[at][0])]
    model = Model(vocabulary, lexicon, np.append(idf[:lexicon], 1.0), BlockMaxIndex(lexicon + 1), whole, neighbours,  # other words are everywhere
                  _share(sum(bare), len(bare)), np.zeros(2), np.zeros(3))
    for at in [at for at in taken if (rows[at][0] < lexicon).any()][:limit]:
        model.index.add(ids[at], labels[at], *model.in_lexicon(*rows[at]))
    model.index.build()
    rest = [at for at, i in enumerate(ids) if i not in chosen]
    votes = list(model.votes([rows[at] for at in rest]))
    label = np.array([labels[at] for at in rest], float)
    seen = np.array([v[0] is not None for v in votes], bool)
    near = np.array([v[1] is not None for v in votes], bool)
    shares = np.array([[v[0] or 0.0, v[1] or 0.0] for v in votes]).reshape(-1, 2)
    model.both = _calibrated(shares[seen], label[seen])
    model.bare = _calibrated(shares[~seen & near, 1:], label[~seen & near])
    return model


def _score_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, near, words = [], [], []
            rows = _rows(batch)
            for (terms, _, _), (score, positions) in zip(rows, model.scores(rows)):
                scores.append(score)
                near.append(model.whole.ids[positions].tolist())
                words.append([model.vocabulary[t] for t in terms[terms < model.lexicon].tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.string()))],
                ["doc_id", "score", "neighbours", "terms"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE) -> DataFrame:
    """(doc_id, score, neighbours, terms) of every row: the evidence is the nearest examples' ids and the lexicon terms found.

    Learns from at most ``rows`` labelled documents (by hash of their id; none of
    the held-out fifth). Whole texts are scored; null and empty texts have no
    terms. Without labels of both kinds every score is that of a document without
    terms. Ids are not inputs: they only break ties between equally near examples.
    """
    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sample = materialized(sampled(given, labels, "toxic", rows).groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")), "toxic-sample")
    # Every second one by hash is an example, so that neither half depends on how ids are dealt.
    examples = [r.doc_id for r in sample.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()][::2]
    lexicon = choose_terms(sample)
    bounded = F.broadcast(sample.sparkSession.createDataFrame([(i,) for i in examples[:EXAMPLES]], "_example bigint"))
    vocabulary = example_terms(sample.join(bounded, F.col("doc_id") == F.col("_example"), "left_semi"), lexicon)
    vectors = materialized(term_vectors(given, vocabulary), "toxic-vectors")
    model = train(sample, vectors, vocabulary, len(lexicon), examples)
    return vectors.mapInArrow(_score_rows(model), "doc_id bigint, score double, neighbours array<bigint>, terms array<string>")
