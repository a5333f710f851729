"""I-Match document fingerprints, DataFrame functions only.

Terms are the lower-cased words of a text. The lexicon holds the terms whose
document frequency lies within a band of the inverse document frequency: not so
common that they tell nothing, not so rare that one typing error changes all.
Each of SUBSETS holds a random part of the lexicon, drawn by a hash of the
term. A document's fingerprint has one value for each subset: the hash of the
document's distinct terms in it, sorted. The likeness of two fingerprints is
the share of subsets with equal values, of those that hold a term of either
document. Parts of several sizes let short and long texts both keep some values
when a part of the text changes.

Where a group of copies or near copies is a large part of the documents, its
terms are too common for the band. So there are also UPPER subsets, of the terms
above the band. A document with fewer than a quarter as many terms in the band
as above it has no values in the band's subsets; where either of two documents
has none, their upper values are compared, else those of the band.

Scale: document frequencies are partial aggregates. The lexicon has at most
(terms a document) / LEAST_SHARE entries whatever the number of documents; it
is broadcast only when its counted rows are at most `broadcast_rows`, and
joined by shuffle beyond. Texts are shuffled once, by a row's key; everything
after that (edited text, terms, fingerprints) stays in that partitioning. The
next document is found on rows without text: a range partitioning by id, a
window in each range, and one row per range for the steps between ranges.

Defined results: a null text is the empty text; a text without lexicon terms
has the hash of the whole text in every subset, so only equal texts are like
it; rows with equal ids follow one another in the order of a digest of the
text; equal rows (id and text) have one place in the order and one result each;
null ids come last; a single document is its own next; an empty table gives no
row; extra columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkpi.llm.common import keyed_texts, written

#: One in how many lexicon terms each subset holds (47 subsets at most), in the band and above it.
SUBSETS = (8,) * 5 + (32,) * 10 + (128,) * 16 + (512,) * 16
UPPER = (8,) * 3 + (16,) * 3 + (32,) * 5 + (64,) * 5
#: A document whose terms above the band are more than FEW times those in it is told by the former.
FEW = 4
#: The bit of an entry that marks terms above the band; below it are the subsets' bits, from 48 on the term's hash.
ABOVE = 1 << 47
#: Least and greatest share of the documents that hold a lexicon term.
LEAST_SHARE, GREATEST_SHARE = 2e-4, 0.05
BROADCAST_ROWS = 2_000_000
NO_TERM = ""


def _terms(text: Column) -> Column:
    """Distinct terms; the empty one is always there and stands for 'no term'."""
    return F.array_distinct(F.concat(F.array(F.lit(NO_TERM)), F.split(F.lower(text), r"[\x09-\x0D\x20]+")))


def _members(subsets: tuple[int, ...], seed: int) -> Column:
    """A bit for each subset that holds the term."""
    bits = [F.when(F.pmod(F.xxhash64("term", F.lit(seed + k)), F.lit(n)) == 0, F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
            for k, n in enumerate(subsets)]
    return reduce(Column.bitwiseOR, bits)


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, greatest: float = GREATEST_SHARE,
            subsets: tuple[int, ...] = SUBSETS, upper: tuple[int, ...] = UPPER) -> DataFrame:
    """(term, entry): hashes of the terms in the band and above it, and in one number
    the upper 16 bits of the hash, ABOVE or not, and a bit for each subset that holds
    the term. The empty term is always there, with a null entry."""
    counts = written(docs.select(F.explode(_terms(F.col("text"))).alias("t"))
                     .groupBy(F.xxhash64("t").alias("term")).agg(F.count("*").alias("df")), "imatch-df")
    none = F.xxhash64(F.lit(NO_TERM))
    every = counts.where(F.col("term") == none).first()  # every document has the empty term
    n_docs = every["df"] if every else 0
    above = F.col("df") > greatest * n_docs
    member = F.when(above, _members(upper, 64)).otherwise(_members(subsets, 0))
    marked = F.shiftleft(F.shiftright("term", 48), 48).bitwiseOR(F.col("member")).bitwiseOR(
        F.when(above, F.lit(ABOVE)).otherwise(F.lit(0)).cast("long"))
    wanted = (F.col("df") >= least * n_docs) & (F.col("member") != 0)
    return (counts.withColumn("member", member).where((F.col("term") == none) | wanted)
            .select("term", F.when(F.col("term") != none, marked).alias("entry")))


LOW = (1 << 32) - 1


def _values(entries: Column, subsets: tuple[int, ...]) -> Column:
    """Array of one value a subset, 0 where no entry is of it.

    entries: distinct entries, sorted, so by term."""
    low = F.lit(LOW).cast("long")

    def held(of: Column, ks: list[int]) -> Column:
        mask = F.lit(sum(1 << k for k in ks)).cast("long")
        return F.filter(of, lambda x: x.bitwiseAND(mask) != 0)

    def value(of: Column, k: int) -> Column:
        own = held(of, [k])
        return F.when(F.size(own) > 0, F.greatest(F.xxhash64(own).bitwiseAND(low), F.lit(1).cast("long"))).otherwise(
            F.lit(0).cast("long"))

    def values(ks: list[int]) -> Column:
        # an array of one, so that the common part is computed once and named in the lambda
        return F.transform(F.array(held(entries, ks)), lambda of: F.array(*[value(of, k) for k in ks]))[0]

    # subsets of one size look only at the terms that any of them holds
    sizes = {n: [k for k, m in enumerate(subsets) if m == n] for n in subsets}
    order = [k for ks in sizes.values() for k in ks]
    flat = F.concat(*[values(ks) for ks in sizes.values()])
    if order != list(range(len(subsets))):
        flat = F.transform(F.array(flat), lambda v: F.array(*[v[order.index(k)] for k in range(len(subsets))]))[0]
    return flat


def _fingerprint(entries: Column, whole: Column, subsets: tuple[int, ...], upper: tuple[int, ...]) -> Column:
    """The values of the band's subsets (all 0 where too few terms are in the
    band), then those of the upper ones."""
    parts = F.struct(F.filter(entries, lambda x: x.bitwiseAND(F.lit(ABOVE)) == 0).alias("band"),
                     F.filter(entries, lambda x: x.bitwiseAND(F.lit(ABOVE)) != 0).alias("above"))

    def both(of: Column) -> Column:
        few = FEW * F.size(of["band"]) < F.size(of["above"])
        band = F.slice(of["band"], F.lit(1), F.when(few, 0).otherwise(F.size(of["band"])))
        return F.concat(_values(band, subsets), _values(of["above"], upper))

    alone = F.greatest(whole.bitwiseAND(F.lit(LOW).cast("long")), F.lit(1).cast("long"))
    return F.when(F.size(entries) > 0, F.transform(F.array(parts), both)[0]).otherwise(
        F.array(*[alone] * (len(subsets) + len(upper))))


def fingerprints(texts: DataFrame, terms: DataFrame, keys: list[str], carry: list[str] = (),
                 subsets: tuple[int, ...] = SUBSETS, upper: tuple[int, ...] = UPPER,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(keys, carry, values) of rows (keys, carry, text). Rows with equal keys
    have equal texts and give one row; `carry` columns ride along once a text.

    terms: a written `lexicon`. No shuffle if `texts` is partitioned by its keys."""
    if terms.count() <= broadcast_rows:
        terms = F.broadcast(terms)
    once = F.struct(F.xxhash64("text").alias("whole"), *carry)
    found = texts.select(*keys, once.alias("once"), F.explode(_terms(F.col("text"))).alias("t"))
    # only the empty term's row carries what belongs to the whole text
    found = found.select(*keys, F.when(F.col("t") == NO_TERM, F.col("once")).alias("once"), F.xxhash64("t").alias("term"))
    rows = found.join(terms, "term").groupBy(*keys).agg(
        F.array_distinct(F.sort_array(F.collect_list("entry"))).alias("entries"),
        F.any_value("once", F.lit(True)).alias("once"))
    values = _fingerprint(F.col("entries"), F.col("once.whole"), subsets, upper)
    return rows.select(*keys, *[F.col(f"once.{c}").alias(c) for c in carry], values.alias("values"))


def as_text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column, bands: int) -> Column:
    """Share of equal values among the subsets that hold a term of either (0 to 1): of
    the first `bands` subsets, or of the upper ones where either has no value in those."""

    def share(x: Column, y: Column) -> Column:
        equal = F.size(F.filter(F.zip_with(x, y, lambda p, q: (p == q) & (p != 0)), lambda p: p))
        either = F.size(F.filter(F.zip_with(x, y, lambda p, q: (p != 0) | (q != 0)), lambda p: p))
        return F.when(either > 0, equal / either).otherwise(1.0)

    def banded(x: Column) -> Column:
        return F.exists(F.slice(x, 1, bands), lambda v: v != 0)

    def upper(x: Column) -> Column:
        return F.slice(x, F.lit(bands + 1), F.size(x) - bands)

    return F.when(banded(a) & banded(b), share(F.slice(a, 1, bands), F.slice(b, 1, bands))).otherwise(
        share(upper(a), upper(b)))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, text): key is a digest of id and text, equal for equal rows only."""
    rows = keyed_texts(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text")))
    return rows.select(digest.alias("key"), "doc_id", "text")


def neighbours(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n_chars, copies, next_key, before_key, before_chars) of each
    distinct row, in descending id order; after the last comes the first."""
    slim = docs.groupBy("key").agg(F.any_value("doc_id").alias("doc_id"),
                                   F.any_value(F.length("text")).alias("n_chars"), F.count("*").alias("copies"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    ranged = written(slim.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "imatch-order")
    within = Window.partitionBy("range").orderBy(*order)
    mine = F.struct("key", "n_chars")
    chained = ranged.select("*", F.lead(mine).over(within).alias("next"), F.lag(mine).over(within).alias("before"))
    # one row per range: its first and last document, and those of the ranges beside it
    ends = ranged.groupBy("range").agg(
        F.min(F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "key", "n_chars")).alias("a"),
        F.max(F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "key", "n_chars")).alias("z")).select(
        "range", F.struct("a.key", "a.n_chars").alias("head"), F.struct("z.key", "z.n_chars").alias("tail"))
    ranges, every = Window.orderBy("range"), Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    beside = ends.select("range", F.coalesce(F.lead("head").over(ranges), F.first("head").over(every)).alias("after"),
                         F.coalesce(F.lag("tail").over(ranges), F.last("tail").over(every)).alias("ahead"))
    placed = chained.join(F.broadcast(beside), "range").select(
        "key", "doc_id", "n_chars", "copies", F.coalesce("next", "after").alias("next"),
        F.coalesce("before", "ahead").alias("before"))
    return placed.select("key", "doc_id", "n_chars", "copies", F.col("next.key").alias("next_key"),
                         F.col("before.key").alias("before_key"), F.col("before.n_chars").alias("before_chars"))


def with_edited(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(key, doc_id, n_chars, copies, next_key, text, edited): edited has the
    last half of the text replaced by the first as many characters of the next document's.

    One shuffle of the texts by key; the next document sends only the part that is used."""
    placed = docs.select("key", "text").join(order, "key")
    given = placed.select(F.col("before_key").alias("key"),
                          F.expr("left(text, cast(before_chars div 2 as int))").alias("given"))
    given = given.groupBy("key").agg(F.any_value("given").alias("given"))  # equal rows give once
    own = F.expr("left(text, cast(n_chars - n_chars div 2 as int))")
    return placed.join(given, "key").select("key", "doc_id", "n_chars", "copies", "next_key", "text",
                                            F.concat(own, "given").alias("edited"))


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   subsets: tuple[int, ...] = SUBSETS, least: float = LEAST_SHARE, greatest: float = GREATEST_SHARE,
                   upper: tuple[int, ...] = UPPER, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row."""
    docs = documents(df, id_col, text_col)
    terms = written(lexicon(docs, least, greatest, subsets, upper), "imatch-lexicon")
    pairs = with_edited(docs, written(neighbours(docs), "imatch-neighbours"))
    both = pairs.select("key", "doc_id", "n_chars", "copies", "next_key", F.explode(F.array(
        F.struct(F.lit(0).alias("edit"), F.col("text"), F.lit("").alias("sha")),
        F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("sha")))).alias("v"))
    both = both.select("key", "v.edit", "doc_id", "n_chars", "copies", "next_key", "v.sha", "v.text")
    made = fingerprints(both, terms, ["key", "edit"], ["doc_id", "n_chars", "copies", "next_key", "sha"],
                        subsets, upper, broadcast_rows)
    one = made.groupBy("key").agg(
        *[F.any_value(c).alias(c) for c in ("doc_id", "n_chars", "copies", "next_key")], F.max("sha").alias("sha"),
        F.max(F.when(F.col("edit") == 0, F.col("values"))).alias("own"),
        F.max(F.when(F.col("edit") == 1, F.col("values"))).alias("other"))
    rows = written(one, "imatch-fingerprints")
    nexts = rows.select(F.col("key").alias("next_key"), F.col("own").alias("next_values"))
    out = rows.join(nexts, "next_key").select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), len(subsets)).alias("near_edited"),
        likeness(F.col("own"), F.col("next_values"), len(subsets)).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return out.drop("copy")
