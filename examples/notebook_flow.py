"""The analysis notebook's flow as one Spark job script.

    python examples/notebook_flow.py /root/testdata/sf0.01 /tmp/film-out

1. raw film records land as JSON lines (here derived from the driver's tables;
   in production the fetch step writes them) and are read under the declared
   nested schema;
2. they are cleaned once and written as Parquet (and exported as CSV with a
   header, like the notebook's processed file);
3. every ranking, search and report of the notebook runs on the written table
   and is shown (each is at most a few rows);
4. the chart datasets are written as Parquet tables for the plotting side
   (nothing table-sized is collected to the driver).
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelkpi.operators import chartdata, ranking, reports  # noqa: E402
from reelkpi.operators.cleaning import clean_films, preview, row_count  # noqa: E402
from reelkpi.session import local_session  # noqa: E402
from reelkpi.sources.fixture import films_from_tables  # noqa: E402
from reelkpi.sources.landing import (  # noqa: E402
    read_raw_json,
    write_clean_csv,
    write_parquet,
    write_raw_json,
)


def main(sf_dir: str, out: str) -> None:
    spark = local_session(app="film-notebook-flow")

    landing = f"{out}/raw_json"
    write_raw_json(films_from_tables(spark, sf_dir), landing)
    raw = read_raw_json(spark, landing)

    write_parquet(clean_films(raw), f"{out}/clean")
    clean = spark.read.parquet(f"{out}/clean")
    write_clean_csv(clean, f"{out}/clean_csv", header=True)

    row_count(clean).show()
    preview(clean).show(truncate=False)

    shown = {
        "Top 5 highest revenue": ranking.revenue_high(clean),
        "Highest budget": ranking.budget_high(clean),
        "Highest profit": ranking.profit_high(clean),
        "Lowest profit": ranking.profit_low(clean),
        "Top 5 highest ROI": ranking.roi_high(clean),
        "Lowest ROI (budget >= 10M)": ranking.roi_low(clean),
        "Most voted": ranking.votes_high(clean),
        "Highest rated (>= 10 votes)": ranking.rating_high(clean),
        "Lowest rated (>= 10 votes)": ranking.rating_low(clean),
        "Most popular": ranking.popularity_high(clean),
        "Search 1: genres + cast, best rated": ranking.best_rated_matching(
            clean, genres=["ECONOMY", "SMALL"], cast=["red widget"]),
        "Search 2: cast + director, shortest": ranking.shortest_matching(
            clean, cast=["red"], director=["7"]),
        "Franchise vs standalone": reports.franchise_flag_stats(clean),
        "Lowest ROI (no floor)": ranking.ranked(clean, "roi", ascending=True, limit=5),
        "Franchise comparison": reports.franchise_comparison(clean),
        "Top franchises": reports.top_franchises(clean),
        "Top 10 franchises, detailed": reports.franchise_success(clean, n=10),
        "Top 10 directors": reports.director_success(clean, n=10),
        "Top production-company lists": reports.company_success(clean).limit(10),
    }
    for title, df in shown.items():
        print(f"--- {title} ---")
        df.show(truncate=False)

    for name, df in chartdata.all_chart_data(clean).items():
        write_parquet(df, f"{out}/charts/{name}")
    print(f"chart datasets written below {out}/charts")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001",
         sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="film-notebook-flow-"))
