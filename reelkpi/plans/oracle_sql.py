"""Independent SQL statements (DuckDB dialect) for every named query.

They start from the driver's tables (views `orders`, `lineitem`, `part`,
`supplier`, `nation`, `customer`) and restate the film fixture and the
cleaning rules directly in SQL -- flat strings via `string_agg`, no nested
records -- so a mistake on either side shows up as a mismatch.

Dialect notes: `count`/`sum` of integers are cast to BIGINT, `year` to
INTEGER; rounding goes through the decimal text of the double to match
Spark's HALF_UP on `BigDecimal(double)`; orders that precede a LIMIT state
NULLS FIRST/LAST and the same tie-break as the Spark side.
"""

from __future__ import annotations

# Line order inside every per-film list.
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_returnflag"


def r2(expr: str) -> str:
    """Spark-compatible round(x, 2)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 12)), 2) AS DOUBLE)"


# Text that is hard to export, as the overview of some films.
ODD_OVERVIEW = """CASE o.o_orderkey % 5 WHEN 0 THEN 'first line' || chr(10) || 'second line'
                 WHEN 1 THEN 'he said "go", twice' WHEN 2 THEN '  padded  ' WHEN 3 THEN chr(92) || 'N'
                 ELSE 'back' || chr(92) || 'slash,' || chr(13) || chr(10) || 'comma' END"""

FILMS_CTE = f"""
lines AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
           l.l_extendedprice, l.l_returnflag, p.p_name, p.p_type, s.s_name, n.n_name, n.n_regionkey
    FROM lineitem l
    LEFT JOIN part p ON p.p_partkey = l.l_partkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
),
per_order AS (
    SELECT l_orderkey,
           count(*) AS n_lines,
           sum(CAST(floor(l_extendedprice / 1000) AS BIGINT)) AS price_k,
           sum(l_linenumber) AS line_sum,
           sum(l_quantity) / count(l_quantity) AS avg_qty,
           string_agg(p_name, '|' ORDER BY {_LINE_ORDER}) AS cast_names,
           string_agg(s_name, '|' ORDER BY {_LINE_ORDER}) AS crew_names,
           string_agg(n_name, '|' ORDER BY {_LINE_ORDER}) AS country_names,
           string_agg(CASE WHEN n_regionkey <> 0 THEN n_name END, '|' ORDER BY {_LINE_ORDER})
               AS language_names,
           string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS genre_names,
           first(s_name ORDER BY {_LINE_ORDER}) FILTER (WHERE l_returnflag = 'R') AS director
    FROM lines
    GROUP BY l_orderkey
),
films AS (
    SELECT
        o.o_orderkey AS id,
        'Order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
        CASE o.o_orderstatus WHEN 'F' THEN 'Released' WHEN 'P' THEN 'Post Production'
                             WHEN 'O' THEN 'Planned' END AS status,
        CASE WHEN o.o_orderkey % 50 = 0 THEN ''
             WHEN o.o_orderkey % 51 = 0 THEN NULL
             ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS raw_release_date,
        CASE WHEN o.o_orderkey % 50 = 0 OR o.o_orderkey % 51 = 0 THEN NULL
             ELSE CAST(o.o_orderdate AS DATE) END AS release_date,
        CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'No Data'
             WHEN o.o_orderpriority = '5-LOW' THEN ''
             WHEN o.o_orderkey % 11 = 0 THEN {ODD_OVERVIEW} ELSE o.o_orderpriority END AS raw_overview,
        CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'No Data'
             WHEN o.o_orderpriority = '2-HIGH' THEN '' ELSE o.o_orderpriority END AS raw_tagline,
        CASE WHEN o.o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL
             WHEN o.o_orderkey % 11 = 0 THEN {ODD_OVERVIEW} ELSE o.o_orderpriority END AS overview,
        CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
             ELSE o.o_orderpriority END AS tagline,
        CAST(coalesce(po.price_k, 0) * 250000 AS BIGINT) AS revenue,
        CAST(CASE WHEN po.l_orderkey IS NULL OR o.o_orderkey % 13 = 0 THEN 0
                  ELSE 1000000 * CAST(pow(2, o.o_orderkey % 8) AS BIGINT) END AS BIGINT) AS budget,
        CAST(coalesce(po.line_sum, 0) * 10 AS BIGINT) AS runtime_raw,
        CAST(floor(o.o_totalprice / 1000) AS DOUBLE) / CAST(8 AS DOUBLE) AS popularity,
        CAST(floor(po.avg_qty * CAST(0.8 AS DOUBLE)) AS DOUBLE) / CAST(4 AS DOUBLE) AS vote_average,
        CAST(coalesce(po.n_lines, 0) AS BIGINT) AS vote_count,
        'en' AS original_language,
        '/poster.jpg' AS poster_path,
        'tt' || CAST(o.o_orderkey AS VARCHAR) AS imdb_id,
        CASE WHEN o.o_custkey % 3 = 0 THEN c.c_name END AS belongs_to_collection,
        CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE coalesce(po.genre_names, '') END AS genres,
        CASE WHEN po.l_orderkey IS NOT NULL THEN coalesce(po.crew_names, '') END AS production_companies,
        CASE WHEN po.l_orderkey IS NOT NULL THEN coalesce(po.country_names, '') END AS production_countries,
        CASE WHEN po.l_orderkey IS NOT NULL THEN coalesce(po.language_names, '') END AS spoken_languages,
        CASE WHEN po.l_orderkey IS NOT NULL THEN coalesce(po.cast_names, '') END AS "cast",
        CASE WHEN po.l_orderkey IS NOT NULL THEN coalesce(po.crew_names, '') END AS crew,
        po.director AS director
    FROM orders o
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_custkey % 3 = 0
    LEFT JOIN per_order po ON po.l_orderkey = o.o_orderkey
),
films_musd AS (
    SELECT *,
        CASE WHEN budget = 0 THEN NULL ELSE CAST(budget AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS budget_musd,
        CASE WHEN revenue = 0 THEN NULL ELSE CAST(revenue AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS revenue_musd,
        CASE WHEN runtime_raw = 0 THEN NULL ELSE CAST(runtime_raw AS DOUBLE) END AS runtime
    FROM films
),
films_kpi AS (
    SELECT *,
        revenue_musd - budget_musd AS profit,
        CASE WHEN budget_musd <> 0 THEN revenue_musd / budget_musd END AS roi
    FROM films_musd
),
clean AS (
    SELECT id, title, tagline, release_date, genres, belongs_to_collection, original_language,
           budget_musd, revenue_musd, production_companies, production_countries, vote_count,
           vote_average, popularity, runtime, overview, spoken_languages, poster_path, "cast", crew,
           director, profit, roi
    FROM films_kpi
    WHERE status = 'Released'
)
"""


def _with(body: str) -> str:
    return f"WITH {FILMS_CTE}\n{body.strip()}\n"


def _top(select_cols: str, metric: str, ascending: bool, where: str = "", n: int = 5) -> str:
    cond = f"{metric} IS NOT NULL" + (f" AND ({where})" if where else "")
    direction = "ASC" if ascending else "DESC"
    return _with(f"""
SELECT {select_cols} FROM clean
WHERE {cond}
ORDER BY {metric} {direction}, id ASC
LIMIT {n}
""")


CLEAN_COLS = (
    "id, title, tagline, release_date, genres, belongs_to_collection, original_language, "
    "budget_musd, revenue_musd, production_companies, production_countries, vote_count, "
    "vote_average, popularity, runtime, overview, spoken_languages, poster_path, \"cast\", crew, "
    "director, profit, roi"
)

# Which landed lines `ingest_rejects` breaks.
BROKEN_EVERY, MISTYPED_EVERY = 101, 103

# Search arguments used by the named search queries on the fixture data.
SEARCH_GENRES = ["ECONOMY", "SMALL"]
SEARCH_CAST = ["red widget"]
SEARCH2_CAST = ["red"]
SEARCH2_DIRECTOR = ["7"]


def _like_all(col: str, needles: list[str]) -> str:
    return " AND ".join(f"{col} LIKE '%{n}%'" for n in needles)


def statements() -> dict[str, str]:
    """Oracle SQL per query name (same names and columns as the Spark queries)."""
    franchise_flag = "belongs_to_collection IS NOT NULL"
    category = f"CASE WHEN {franchise_flag} THEN 'Franchise' ELSE 'Standalone' END"
    q: dict[str, str] = {}

    # --- cleaning steps (all films, before the released-only filter) ---------
    q["clean_drop_columns"] = _with("""
SELECT id, title, raw_overview AS overview, raw_tagline AS tagline, status,
       raw_release_date AS release_date, revenue, budget, runtime_raw AS runtime, popularity,
       vote_average, vote_count, original_language, poster_path
FROM films
""")
    q["clean_flatten_nested"] = _with("""
SELECT id, belongs_to_collection, genres, production_countries, production_companies,
       spoken_languages, "cast", crew, director
FROM films
""")
    q["clean_director"] = _with("SELECT id, director FROM films")
    q["clean_financials"] = _with("SELECT id, budget_musd, revenue_musd, runtime FROM films_musd")
    q["clean_dates_text"] = _with("SELECT id, release_date, overview, tagline FROM films")
    q["clean_released"] = _with("SELECT id, title, status FROM films WHERE status = 'Released'")
    q["clean_kpis"] = _with("SELECT id, profit, roi FROM films_kpi")
    q["clean_pipeline"] = _with(f"SELECT {CLEAN_COLS} FROM clean")
    q["clean_row_count"] = _with("SELECT CAST(count(*) AS BIGINT) AS \"rows\" FROM clean")
    q["clean_preview"] = _with(
        "SELECT title, release_date, revenue_musd, roi FROM clean ORDER BY id ASC LIMIT 5")

    # --- sources and sinks (round trips must give the same rows) ------------
    q["source_raw_json"] = q["clean_pipeline"]
    q["sink_clean_csv"] = q["clean_pipeline"]
    q["sink_clean_csv_noheader"] = q["clean_pipeline"]
    q["ingest_rejects"] = _with(f"""
SELECT id, CASE WHEN id % {BROKEN_EVERY} = 0 THEN 'malformed' ELSE 'mistyped' END AS reason
FROM films WHERE id % {BROKEN_EVERY} = 0 OR id % {MISTYPED_EVERY} = 0
""")
    q["sink_raw_json"] = _with("""
SELECT id, title, status, raw_release_date AS release_date, revenue, budget, runtime_raw AS runtime,
       popularity, vote_average, vote_count, imdb_id, belongs_to_collection, genres,
       spoken_languages, "cast", crew, director
FROM films
""")
    q["ingest_coverage"] = """
SELECT CAST(count(*) AS BIGINT) AS requested,
       CAST(count(landed.l_orderkey) AS BIGINT) AS landed,
       CAST(count(*) - count(landed.l_orderkey) AS BIGINT) AS missing
FROM orders o
LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) landed ON landed.l_orderkey = o.o_orderkey
"""
    q["ingest_missing"] = """
SELECT o.o_orderkey AS id FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

    # --- rankings and searches ------------------------------------------------
    q["rank_revenue_high"] = _top("title, revenue_musd, budget_musd", "revenue_musd", False)
    q["rank_budget_high"] = _top("title, budget_musd, revenue_musd", "budget_musd", False)
    q["rank_profit_high"] = _top("title, profit, budget_musd, revenue_musd", "profit", False)
    q["rank_profit_low"] = _top("title, profit, budget_musd, revenue_musd", "profit", True)
    q["rank_roi_high"] = _top("title, roi, revenue_musd", "roi", False)
    q["rank_roi_low"] = _top("title, roi, budget_musd, revenue_musd", "roi", True, "budget_musd >= 10")
    q["rank_votes_high"] = _top("title, vote_count", "vote_count", False)
    q["rank_rating_high"] = _top("title, vote_average, vote_count", "vote_average", False, "vote_count >= 10")
    q["rank_rating_low"] = _top("title, vote_average, vote_count", "vote_average", True, "vote_count >= 10")
    q["rank_popularity_high"] = _top("title, popularity", "popularity", False)
    q["search_genre_cast"] = _top(
        "title, vote_average", "vote_average", False,
        _like_all("genres", SEARCH_GENRES) + " AND " + _like_all('"cast"', SEARCH_CAST))
    q["search_cast_director"] = _top(
        "title, runtime", "runtime", True,
        _like_all('"cast"', SEARCH2_CAST) + " AND " + _like_all("director", SEARCH2_DIRECTOR))
    q["rank_roi_low_unfloored"] = _top(CLEAN_COLS, "roi", True)

    # --- grouped reports ------------------------------------------------------
    q["franchise_flag_stats"] = _with(f"""
SELECT {franchise_flag} AS is_franchise,
       CAST(count(id) AS BIGINT) AS "count",
       avg(revenue_musd) AS avg_revenue,
       median(roi) AS median_roi,
       avg(budget_musd) AS avg_budget,
       avg(popularity) AS avg_popularity,
       avg(vote_average) AS avg_rating
FROM clean GROUP BY 1
""")
    q["company_success"] = _with("""
SELECT production_companies,
       CAST(count(id) AS BIGINT) AS movie_count,
       sum(revenue_musd) AS total_revenue,
       avg(vote_average) AS avg_rating
FROM clean GROUP BY production_companies
ORDER BY total_revenue DESC NULLS LAST, production_companies ASC NULLS FIRST
""")
    q["franchise_comparison"] = _with(f"""
SELECT {category} AS category,
       CAST(count(title) AS BIGINT) AS movie_count,
       {r2('avg(revenue_musd)')} AS revenue_musd,
       {r2('median(roi)')} AS roi,
       {r2('avg(budget_musd)')} AS budget_musd,
       {r2('avg(popularity)')} AS popularity,
       {r2('avg(vote_average)')} AS vote_average
FROM clean GROUP BY 1
""")
    q["top_franchises"] = _with(f"""
SELECT * FROM (
    SELECT belongs_to_collection,
           CAST(count(title) AS BIGINT) AS title_count,
           {r2('sum(revenue_musd)')} AS revenue_musd,
           {r2('median(roi)')} AS roi,
           {r2('avg(vote_average)')} AS vote_average
    FROM clean WHERE {franchise_flag} GROUP BY belongs_to_collection
) t
ORDER BY revenue_musd DESC NULLS LAST, belongs_to_collection ASC
LIMIT 5
""")
    q["franchise_success"] = _with(f"""
SELECT * FROM (
    SELECT belongs_to_collection,
           CAST(count(title) AS BIGINT) AS movie_count,
           {r2('sum(budget_musd)')} AS total_budget_musd,
           {r2('avg(budget_musd)')} AS mean_budget_musd,
           {r2('sum(revenue_musd)')} AS total_revenue_musd,
           {r2('avg(revenue_musd)')} AS mean_revenue_musd,
           {r2('avg(vote_average)')} AS mean_rating
    FROM clean WHERE {franchise_flag} GROUP BY belongs_to_collection
) t
ORDER BY total_revenue_musd DESC NULLS LAST, belongs_to_collection ASC
LIMIT 10
""")
    q["director_success"] = _with(f"""
SELECT * FROM (
    SELECT d AS director,
           CAST(count(title) AS BIGINT) AS movies_directed,
           {r2('sum(revenue_musd)')} AS total_revenue_musd,
           {r2('avg(vote_average)')} AS mean_rating
    FROM (SELECT unnest(string_split(director, '|')) AS d, title, revenue_musd, vote_average
          FROM clean WHERE director IS NOT NULL) e
    GROUP BY d
) t
ORDER BY total_revenue_musd DESC NULLS LAST, director ASC
LIMIT 10
""")

    # --- chart datasets -------------------------------------------------------
    q["chart_yearly"] = _with("""
SELECT CAST(year(release_date) AS INTEGER) AS year,
       CAST(count(id) AS BIGINT) AS movie_count,
       avg(revenue_musd) AS mean_revenue,
       avg(budget_musd) AS mean_budget,
       avg(roi) AS mean_roi
FROM clean GROUP BY 1
ORDER BY 1 ASC NULLS FIRST
""")
    q["chart_genre_roi"] = _with("""
SELECT genre, median(roi) AS median_roi
FROM (SELECT unnest(string_split(genres, '|')) AS genre, roi FROM clean WHERE genres IS NOT NULL) e
GROUP BY genre
ORDER BY median_roi DESC NULLS LAST, genre ASC
""")
    q["chart_franchise"] = _with(f"""
SELECT {category} AS type,
       avg(revenue_musd) AS mean_revenue,
       avg(budget_musd) AS mean_budget,
       avg(roi) AS mean_roi,
       avg(vote_average) AS mean_rating
FROM clean GROUP BY 1
""")
    q["chart_scatter"] = _with(
        "SELECT title, budget_musd, revenue_musd, popularity, vote_average FROM clean")
    return q
