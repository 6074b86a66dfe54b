"""Personal data and the terms that give it away, in DataFrame operations only.

Patterns find the protected entities: e-mail addresses, IP addresses, card and
phone numbers. How strongly a term reveals an entity is estimated from the corpus:
with documents as events, the pointwise mutual information of term and entity,
divided by the information of the entity, tells which share of what there is to
know about the entity the term gives away,

    disclosure(t, c) = ln(n(t, c) N / (n(t) n(c))) / ln(N / n(c)),

where n counts the documents holding the term, the entity, or the term within
``CONTEXT`` code points of the entity. It is 1 for a term that occurs beside the
entity only. In a document that holds the entity, terms of a disclosure of at
least ``GENERALISE`` are replaced by their kind, those of at least ``REMOVE`` go.

Native functions give matches without places. The places are the running sums of
the lengths of matches and of the stretches between them. Only matches leave their
document; a document's text is never copied per match, and entity-term pairs grow
with the number of mentions, as each has a context of bounded length.

Patterns use possessive repeats and look back for the start of a run, which gives
the same matches as the plain forms, in linear time and without recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chainstrata.llm.columns import ROW_KEY, row_key
from chainstrata.session import materialized

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole chain of digits with single separators, of 12 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]
TERM_KIND = "term"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DOUBLED = "0246813579"

TERM = r"(?<!\p{L})\p{L}{3,40}+(?!\p{L})"
CONTEXT = 80
LEAST_DOCUMENTS = 3
GENERALISE, REMOVE = 0.8, 0.95


def _luhn(digits: Column) -> Column:
    """Digits, doubled at every second place from the right (9 taken off beyond 9), add up to a multiple of ten."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.translate(c, "0123456789", _DOUBLED)).otherwise(c).try_cast("int"))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _stretches(kind: int, body: Column, pattern: Column, present: Column) -> Column:
    """Matches of a pattern, each with the stretch before it; the last element is the stretch after all of them."""
    zipped = F.arrays_zip(F.split(body, pattern).alias("gap"), F.regexp_extract_all(body, pattern, F.lit(0)).alias("hit"))
    cut = F.transform(zipped, lambda z: F.struct(
        F.lit(kind).alias("kind"), F.char_length(z["gap"]).cast("bigint").alias("gap"),
        F.left(z["gap"], F.lit(CONTEXT)).alias("head"), F.right(z["gap"], F.lit(CONTEXT)).alias("tail"), z["hit"].alias("hit")))
    return F.when(present, cut).otherwise(F.array().cast("array<struct<kind:int,gap:bigint,head:string,tail:string,hit:string>>"))


def _placed(found: DataFrame) -> DataFrame:
    """Rows of ``_stretches`` with start, end (exclusive) and context; ``copies`` counts rows of equal id and text."""
    each = found.select(*ROW_KEY, F.posexplode("stretches").alias("nth", "s")).select(*ROW_KEY, "nth", "s.*")
    once = each.repartition(*ROW_KEY, "kind").groupBy(*ROW_KEY, "kind", "nth").agg(
        *[F.first(c).alias(c) for c in ("gap", "head", "tail", "hit")], F.count("*").alias("copies"))
    along = Window.partitionBy(*ROW_KEY, "kind").orderBy("nth")
    size = F.coalesce(F.char_length("hit"), F.lit(0)).cast("bigint")
    placed = once.withColumns({"end": F.sum(F.col("gap") + size).over(along), "after": F.lead("head").over(along)})
    return placed.filter(F.col("hit").isNotNull()).select(
        *ROW_KEY, "kind", (F.col("end") - size).alias("start"), "end", "hit", F.col("tail").alias("before"), "after", "copies")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*row_key(F.col(doc_id), F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("_body"))


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base matches of every text with ``entity``, the value all its spellings share."""
    body = F.col("_body")
    tests = [(EMAIL, body.contains("@")), (IP, body.contains(".")), (CARD, F.lit(True)), (PHONE, body.contains("+"))]
    parts = [_stretches(i, body, F.lit(p), gate & body.rlike(p)) for i, (p, gate) in enumerate(tests)]
    placed = _placed(_keyed(docs, doc_id, text).select(*ROW_KEY, F.concat(*parts).alias("stretches")))
    hit, kind = F.col("hit"), F.col("kind")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    holds = (
        F.when(kind == 1, hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, _luhn(digits))
        .when(kind == 3, F.length(digits).between(9, 15))
        .otherwise(True))
    value = F.when(kind == 0, F.lower(hit)).when(kind == 1, hit).otherwise(digits)
    named = F.concat(F.element_at(F.array(*map(F.lit, KINDS)), kind + 1), F.lit(":"), value)
    return placed.filter(holds).withColumn("entity", named)


def _context_terms(before: Column, after: Column) -> Column:
    """Distinct terms of a context, without cut words and words that hold an @."""
    word = r"[^\x20\x09-\x0D]"
    head = F.when(F.char_length(before) == CONTEXT, F.regexp_replace(before, f"^{word}+", "")).otherwise(before)
    tail = F.when(F.char_length(after) == CONTEXT, F.regexp_replace(after, f"{word}+$", "")).otherwise(after)
    plain = F.regexp_replace(F.concat(head, F.lit(" "), tail), f"{word}*@{word}*", " ")
    return F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(TERM), F.lit(0)))


def disclosures(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Terms near entities per document, and the (entity, term, disclosure) that reach ``GENERALISE``.

    Counts are of rows; a term needs ``LEAST_DOCUMENTS`` documents beside the entity.
    """
    near = materialized(
        found.select(*ROW_KEY, "entity", "copies", F.explode(_context_terms(F.col("before"), F.col("after"))).alias("term"))
        .distinct(), "pii-near")
    total = docs.count()
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0)))).alias("term"))
    per_term = words.groupBy("term").agg(F.count("*").alias("n_term"))
    per_entity = found.select(*ROW_KEY, "entity", "copies").distinct().groupBy("entity").agg(F.sum("copies").alias("n_entity"))
    both = near.groupBy("entity", "term").agg(F.sum("copies").alias("n")).filter(F.col("n") >= LEAST_DOCUMENTS)
    known = F.log(F.lit(float(total)) / F.col("n_entity"))
    lost = F.log(F.col("n_term").cast("double") / F.col("n"))
    rated = both.join(per_entity, "entity").join(per_term, "term").filter(F.col("n_entity") < total)
    return near, rated.select("entity", "term", F.round(1 - lost / known, 9).alias("disclosure")).filter(
        F.col("disclosure") >= GENERALISE)


def _spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All spans per distinct (id, text): sorted structs of start, kind, end, disclosure and the part to mask."""
    found = materialized(mentions(docs, doc_id, text), "pii-mentions")
    near, strong = disclosures(docs, found, doc_id, text)
    flagged = materialized(
        near.join(strong, ["entity", "term"]).groupBy(*ROW_KEY, "term").agg(F.max("disclosure").alias("disclosure")), "pii-terms")
    lists = flagged.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set("term")).alias("_terms"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("_terms", "|"), F.lit(r")(?!\p{L})"))
    held = _keyed(docs, doc_id, text).join(lists, ROW_KEY).withColumn("_pattern", pattern)
    term_kind = len(KINDS)
    spots = _placed(held.select(*ROW_KEY, _stretches(
        term_kind, F.col("_body"), F.col("_pattern"), F.col("_terms").isNotNull()).alias("stretches")))
    spots = spots.withColumn("term", F.lower("hit")).join(flagged, [*ROW_KEY, "term"], "left")
    base = found.select(*ROW_KEY, "start", "kind", "end", F.lit(None).cast("double").alias("disclosure"))
    every = base.unionByName(spots.select(*base.columns))
    # Overlaps, in order of start: what reaches here from before, and what begins before this span's end.
    order = Window.partitionBy(*ROW_KEY).orderBy("start", "kind", "end")
    is_base = F.col("kind") < term_kind
    reach = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # A frame that ends at the last row would be summed up anew for every row.
    back = Window.partitionBy(*ROW_KEY).orderBy(F.desc("start"), F.desc("kind"), F.desc("end"))
    upcoming = F.min(F.when(is_base, F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    clear = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(upcoming, F.col("end")) >= F.col("end"))
    kept = every.withColumns({"_clear": clear, "_reach": F.coalesce(reach, F.lit(0))}).filter(is_base | F.col("_clear"))
    return kept.groupBy(*ROW_KEY).agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "disclosure", F.greatest("start", "_reach").alias("mask_from")))).alias("spans"))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, text hash and ``spans``: start, end (exclusive, in code points), kind and disclosure.

    ``spans`` is sorted by start, then kind in the order of ``KINDS`` and then
    ``term``; it is empty for texts without personal data. Base spans of different
    kinds may overlap; terms that touch a base span are left out. Null texts are
    empty ones, equal rows have equal results, rows without an id are told apart by
    their texts, and other columns play no part. Texts may be of any length; no
    match is tried twice. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), *row_key(F.col(doc_id), F.col(text)))
    kinds = F.array(*map(F.lit, [*KINDS, TERM_KIND]))
    joined = rows.join(_spans(docs, doc_id, text), ROW_KEY, "left")
    spans = F.coalesce("spans", F.array().cast(
        "array<struct<start:bigint,kind:int,end:bigint,disclosure:double,mask_from:bigint>>"))
    return joined.select("id", *ROW_KEY, F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(kinds, s["kind"] + 1).alias("kind"),
        s["disclosure"].alias("disclosure"), s["mask_from"].alias("mask_from"))).alias("spans"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the input row as a struct), ``spans`` and ``clean_text``.

    Base spans become ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``. Terms below
    ``REMOVE`` become their kind, ``[NAME]`` with a capital and ``[WORD]`` without;
    others go altogether. A null text stays null.
    """
    spans = find(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("id").dropDuplicates(ROW_KEY)
    joined = docs.select(F.struct("*").alias("row"), *row_key(F.col(doc_id), F.col(text))).join(spans, ROW_KEY)
    body = F.col(f"row.`{text}`")
    masked = joined.withColumn("_masks", F.filter("spans", lambda s: s["end"] > s["mask_from"]))
    masks = F.col("_masks")

    def before(i: Column) -> Column:
        return F.when(i == 0, F.lit(0)).otherwise(F.element_at(masks, F.greatest(i, F.lit(1)))["end"])

    def mark(s: Column) -> Column:
        general = F.when(F.substring(body, s["start"].cast("int") + 1, F.lit(1)).rlike(r"\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("[WORD]"))
        return F.when(s["kind"] != TERM_KIND, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(
            s["disclosure"] >= REMOVE, F.lit("")).otherwise(general)

    def stretch(start: Column, end: Column) -> Column:
        return F.substring(body, start.cast("int") + 1, (end - start).cast("int"))

    cut = F.transform(masks, lambda s, i: F.concat(stretch(before(i), s["mask_from"]), mark(s)))
    rest = stretch(F.element_at(masks, -1)["end"], F.char_length(body).cast("bigint"))
    return masked.select("row", "spans", F.when(F.size(masks) == 0, body).otherwise(
        F.concat(F.array_join(cut, ""), rest)).alias("clean_text"))


def digests(found: DataFrame) -> DataFrame:
    """Rows of ``find`` as counts per kind, the digest of the base spans and all spans as text."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base, counts = F.filter("spans", lambda s: s["kind"] != TERM_KIND), map(number, KINDS)
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
