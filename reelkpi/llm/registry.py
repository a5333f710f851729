"""The named queries of this subpackage: thin, each derives its columns from an operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelkpi.llm import (
    ann, bpe, collocations, covertree, imatch, packing, periodicruns, quality, repair, rollups, simhash, suffixdedup, suffixtree,
)
from reelkpi.llm.common import table, written
from reelkpi.session import scratch_path

WORDS = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids, each document ended by id 1."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids by the multi-language byte-level ranks, and the bytes they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids (each ended by id 2) written as Re-Pair files in id order and read back."""
    path = scratch_path(spark, "repair-store")
    repair.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORDS), end_id=2)
    rows = repair.read_store(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 64-bit SimHash over 3-word shingles and its component at 3 or fewer bits."""
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.SHINGLE, simhash.DISTANCE)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def fold(doc_id, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chance of quality label 1; positives are learnt from two folds of three."""
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    rows = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Parts in which the copies of one text meet their least id.
COPY_PARTS = 16
#: Token counts that SQL can give too: words, and runs of letters, of digits and of other marks.
WORD, PIECE = r"[^\x20\x09-\x0D]+", r"\p{L}+|\p{N}+|[^\x09-\x0D\x20\p{L}\p{N}]+"


@query
def op5_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after a history of
    batches over all documents: provisional word counts come in, exact copies
    (all but the least id of a text) are deleted, the counts that are left are
    revised to exact ones, a second tokenizer's counts come in, and two batches
    are sent again, which must change nothing."""
    text = F.coalesce("text", F.lit(""))
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    counts = written(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2(text, 256).alias("of"), (spaces + 1).alias("guess"),
        F.regexp_count(text, F.lit(WORD)).alias("words"), F.regexp_count(text, F.lit(PIECE)).alias("pieces")), "token-counts")
    first = counts.groupBy("of").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    # a text with very many copies is joined in parts
    parts = F.explode(F.array(*map(F.lit, range(COPY_PARTS)))).alias("part")
    seen = (counts.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_PARTS)).cast("int"))
            .join(first.select("of", "least", parts), ["of", "part"], "left"))
    is_copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    kept = seen.where(~is_copy)
    batches = [
        ("001-insert", rollups.inserts(counts, F.col("guess"), "words-1")),
        ("002-delete", rollups.deletes(seen.where(is_copy), F.col("guess"), "words-1")),
        ("003-revise", rollups.revisions(kept, F.col("guess"), F.col("words"), "words-1")),
        ("004-insert", rollups.inserts(kept, F.col("pieces"), "pieces-2"))]
    store = rollups.Rollup(spark, scratch_path(spark, "token-totals"))
    for batch_id, changes in batches[:3]:
        store.commit(batch_id, changes)
    store.compact()
    for batch_id, changes in [batches[1], batches[3], batches[3]]:
        store.commit(batch_id, changes)
    return store.totals()


ORACLE_SQL["op5_token_totals"] = rf"""
    WITH seen AS (
        SELECT source, lang, coalesce(text, '') AS text, doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
        FROM documents),
    kept AS (SELECT * FROM seen WHERE NOT coalesce(doc_id > least, false))
    SELECT source, lang, 'words-1' AS tokenizer, CAST(count(*) AS BIGINT) AS documents,
           CAST(sum(len(regexp_extract_all(text, '{WORD}'))) AS BIGINT) AS tokens FROM kept GROUP BY source, lang
    UNION ALL
    SELECT source, lang, 'pieces-2' AS tokenizer, CAST(count(*) AS BIGINT) AS documents,
           CAST(sum(len(regexp_extract_all(text, '{PIECE}'))) AS BIGINT) AS tokens FROM kept GROUP BY source, lang"""


@query
def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's I-Match fingerprint, beside that of its edited text and of the next document."""
    return imatch.compare_edited(table(spark, sf_dir, "documents"))


@query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found, by inner product, of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by a suffix tree grown on six folds of seven."""
    rows = suffixtree.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return rows.select("doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens",
                       "n_known", "train_tokens", "base_score", "score")


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else too."""
    rows = suffixdedup.deduplicate(table(spark, sf_dir, "documents"), suffixdedup.SIZE)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products, exactly, of every vector whose id is divisible by 100."""
    return covertree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLE_SQL["op13_cover_tree"] = """
    WITH fine AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
               row_number() OVER () AS row
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, q.row AS q_row, c.vec_id, c.row,
               CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
        FROM fine q JOIN fine c ON q.row <> c.row WHERE q.vec_id % 100 = 0),
    ranked AS (
        SELECT query_id, vec_id, score,
               row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id, row) AS rank FROM scores)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents, where a tenth repeat a stretch of words: with
    h the crc32 of the id and g = h div 10, where h % 10 = 0 each word i >= a
    becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, p = F.col("a"), F.col("p")
    moved = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + (i - a) % p)))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document's words, a tenth of the documents repeating a stretch."""
    rows = periodicruns.find_runs(planted(table(spark, sf_dir, "documents")))
    best = F.get("runs", F.col("best"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two to four words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_collocations"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    worded AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    grams AS (
        SELECT lang, w[i:i + s - 1] AS g FROM (SELECT lang, w, i, unnest([1, 2, 3, 4]) AS s FROM starts)
        WHERE i + s - 1 <= len(w)),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
    counts AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
    candidates AS (SELECT lang, g, f AS a FROM counts WHERE len(g) >= 2),
    cuts AS (
        SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r,
               CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
        FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM candidates) c
        JOIN counts x ON x.lang = c.lang AND x.g = c.g[1:c.k]
        JOIN counts y ON y.lang = c.lang AND y.g = c.g[c.k + 1:len(c.g)]),
    weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    inner_parts AS (
        SELECT lang, a, g, i, unnest(range(i + 1, len(g) + 1)) AS j
        FROM (SELECT lang, a, g, unnest(range(1, len(g))) AS i FROM candidates WHERE len(g) > 2)),
    longer AS (
        SELECT lang, g[i:j] AS g, max(a) AS f FROM inner_parts WHERE j - i + 1 < len(g) GROUP BY lang, g[i:j]),
    kept AS (
        SELECT w.* FROM weakest w LEFT JOIN longer o ON o.lang = w.lang AND o.g = w.g
        WHERE o.f IS NULL OR CAST(100 AS HUGEINT) * o.f < CAST(80 AS HUGEINT) * w.a),
    ranked AS (
        SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
               row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
        FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
