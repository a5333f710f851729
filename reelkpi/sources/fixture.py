"""Film records in the raw nested layout, derived from the driver's tables.

The driver's tables hold orders, not films, so each order becomes one film:
its line items (with part, supplier and nation) give the credits, genres,
companies, countries and languages; the ordering customer gives the
collection for one customer in three. Orders without lines give the null and
empty-array cases. All numbers are multiples of a power of two, so sums,
ratios and medians are exact and independent of row order.

Plan shape (what runs at scale): Spark's own size-based broadcasts and runtime
re-planning pick the dimension joins, but for `nation` (25 rows by definition)
and for suppliers up to a counted number, which are hinted; the lines are
grouped by order key (an order has a bounded number of lines: 1-17 in the
driver's data). They are dealt by it as flat rows of what they read, and the
line records and their arrays are built after that: arrays of an order whose
lines are spread over the input save nothing on the wire. Lines without an order
key match no order and are left out before they are shuffled. Orders are joined
to the collection customers before they meet the per-order arrays, so the wide
arrays are never shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from reelkpi.schema import CAST_MEMBER, COMPANY, COUNTRY, CREW_MEMBER, GENRE, LANGUAGE
from reelkpi.session import broadcasts_on
from reelkpi.sources.tables import read_table

# --- fixed values of the fixture (changing them changes every result) --------
STATUS_BY_ORDER_STATUS = {"F": "Released", "P": "Post Production", "O": "Planned"}
JOB_BY_RETURN_FLAG = {"R": "Director", "A": "Writer", "N": "Producer"}
OVERVIEW_NO_DATA, OVERVIEW_EMPTY = "4-NOT SPECIFIED", "5-LOW"
TAGLINE_NO_DATA, TAGLINE_EMPTY = "1-URGENT", "2-HIGH"
EMPTY_DATE_EVERY, NULL_DATE_EVERY = 50, 51
ZERO_BUDGET_EVERY = 13
NULL_GENRES_EVERY = 97
COLLECTION_EVERY = 3
# text that is hard to export, as the overview of some films
ODD_OVERVIEW_EVERY = 11
ODD_OVERVIEWS = ["first line\nsecond line", 'he said "go", twice', "  padded  ", "\\N", "back\\slash,\r\ncomma"]
REVENUE_UNIT = 250_000       # revenue = unit * sum(floor(extendedprice / 1000))
BUDGET_UNIT = 1_000_000      # budget = unit * 2^(id % 8)
RUNTIME_UNIT = 10            # runtime = unit * sum(linenumber)
ORIGINAL_LANGUAGE = "en"
POSTER_PATH = "/poster.jpg"
HOMEPAGE = ""
# -----------------------------------------------------------------------------

#: Up to so many suppliers (about 100 bytes each) are broadcast, unless the session
#: has broadcasts off: that saves a shuffle of all lines. Beyond, Spark's rule decides.
BROADCAST_SUPPLIERS = 500_000


def _case(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item of an order, with the part, supplier and nation names
    it needs, dealt by order key (before broadcast names widen it)."""
    lineitem = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_returnflag"]).where(F.col("l_orderkey").isNotNull())
    lineitem = lineitem.withColumn("price_k", F.floor(F.col("l_extendedprice") / 1000)).drop("l_extendedprice")
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    supp = (supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left")
            .select("s_suppkey", "s_name", "n_name", "n_regionkey"))
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey, "left").drop("p_partkey")
    its_supplier = F.col("l_suppkey") == F.col("s_suppkey")
    if broadcasts_on(spark) and supplier.count() <= BROADCAST_SUPPLIERS:
        lines = lines.repartition("l_orderkey").join(F.broadcast(supp), its_supplier, "left")
    else:
        lines = lines.join(supp, its_supplier, "left").repartition("l_orderkey")
    return lines.drop("s_suppkey")


def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def per_order(lines: DataFrame) -> DataFrame:
    """Lines of each order as one sorted array of flat line records, plus the
    sums the film needs (an order has a bounded number of lines). Flat records
    keep the aggregation buffers small; the nested film arrays are built from
    them afterwards without lambdas."""
    line = F.struct(
        # sort key first: lines are ordered by (linenumber, partkey, suppkey, returnflag);
        # everything after it is determined by those keys
        "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "p_name", "p_type", "s_name", "n_name",
        _case(F.col("l_returnflag"), JOB_BY_RETURN_FLAG).alias("job"),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("language"),
    )
    return lines.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(line)).alias("ls"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("price_k").alias("price_k"),
        F.sum("l_linenumber").alias("line_sum"),
        (F.sum("l_quantity") / F.count("l_quantity")).alias("avg_qty"),
    )


def _zipped(element_type: StructType, *fields: Column) -> Column:
    """Per-line arrays zipped into an array of `element_type` structs (fields
    matched by position); null when the order has no lines."""
    return F.arrays_zip(*fields).cast(ArrayType(element_type))


def films_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw film records (the `RAW_SCHEMA` layout), one per order."""
    orders = read_table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    customer = (
        read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
        .where(F.col("c_custkey") % COLLECTION_EVERY == 0)
    )
    # orders without a collection have no customer to find: they get keys of
    # their own, which match none and spread evenly if the join shuffles
    wanted = F.when(F.col("o_custkey") % COLLECTION_EVERY == 0, F.col("o_custkey")).otherwise(-1 - F.col("o_orderkey"))
    films = (
        orders.withColumn("_custkey", wanted).join(customer, F.col("_custkey") == F.col("c_custkey"), "left")
        .join(per_order(order_lines(spark, sf_dir)), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )

    oid = F.col("o_orderkey")
    has_lines = F.col("ls").isNotNull()
    prio = F.col("o_orderpriority")

    n = F.size(F.col("ls"))

    def nulls(type_name: str) -> Column:
        return F.array_repeat(_null(type_name), n)

    ids_part = F.col("ls.l_partkey").cast("array<int>")
    ids_supp = F.col("ls.l_suppkey").cast("array<int>")
    cast = _zipped(CAST_MEMBER, ids_part, F.col("ls.p_name"))
    crew = _zipped(CREW_MEMBER, ids_supp, F.col("ls.s_name"), F.col("ls.job"))
    credits = F.when(has_lines, F.struct(cast.alias("cast"), crew.alias("crew")))
    collection = F.when(F.col("o_custkey") % COLLECTION_EVERY == 0, F.struct(
        F.col("o_custkey").cast("int").alias("id"), F.col("c_name").alias("name"),
        _null("string").alias("poster_path"), _null("string").alias("backdrop_path")))
    # distinct part types of the order, sorted by name; [] for an order without lines
    types = F.sort_array(F.array_distinct(F.array_compact(F.col("ls.p_type"))))
    genre_list = _zipped(GENRE, F.array_repeat(_null("int"), F.size(types)), types)
    genres = F.when(oid % NULL_GENRES_EVERY != 0, F.coalesce(
        genre_list, F.array().cast(ArrayType(GENRE))))
    title = F.concat(F.lit("Order "), oid.cast("string"))
    return films.select(
        oid.alias("id"),
        title.alias("title"),
        F.when(prio == OVERVIEW_NO_DATA, "No Data").when(prio == OVERVIEW_EMPTY, "")
        .when(oid % ODD_OVERVIEW_EVERY == 0, F.element_at(
            F.array(*map(F.lit, ODD_OVERVIEWS)), (oid % len(ODD_OVERVIEWS) + 1).cast("int")))
        .otherwise(prio).alias("overview"),
        F.when(prio == TAGLINE_NO_DATA, "No Data").when(prio == TAGLINE_EMPTY, "").otherwise(prio)
        .alias("tagline"),
        _case(F.col("o_orderstatus"), STATUS_BY_ORDER_STATUS).alias("status"),
        F.when(oid % EMPTY_DATE_EVERY == 0, F.lit(""))
        .when(oid % NULL_DATE_EVERY == 0, _null("string"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("release_date"),
        F.coalesce(F.col("price_k") * REVENUE_UNIT, F.lit(0)).cast("long").alias("revenue"),
        F.when(~has_lines | (oid % ZERO_BUDGET_EVERY == 0), F.lit(0))
        .otherwise(F.lit(BUDGET_UNIT) * F.pow(F.lit(2), oid % 8))
        .cast("long").alias("budget"),
        F.coalesce(F.col("line_sum") * RUNTIME_UNIT, F.lit(0)).cast("long").alias("runtime"),
        (F.floor(F.col("o_totalprice") / 1000) / 8.0).alias("popularity"),
        (F.floor(F.col("avg_qty") * 0.8) / 4.0).alias("vote_average"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("long").alias("vote_count"),
        F.lit(ORIGINAL_LANGUAGE).alias("original_language"),
        F.lit(POSTER_PATH).alias("poster_path"),
        credits.alias("credits"),
        collection.alias("belongs_to_collection"),
        genres.alias("genres"),
        _zipped(COMPANY, F.col("ls.s_name"), ids_supp, nulls("string"), nulls("string"))
        .alias("production_companies"),
        _zipped(COUNTRY, nulls("string"), F.col("ls.n_name")).alias("production_countries"),
        _zipped(LANGUAGE, nulls("string"), F.col("ls.language"), nulls("string")).alias("spoken_languages"),
        F.lit(False).alias("adult"),
        F.concat(F.lit("tt"), oid.cast("string")).alias("imdb_id"),
        F.lit(HOMEPAGE).alias("homepage"),
        F.lit(False).alias("video"),
        title.alias("original_title"),
    )
