"""DataFrame -> DataFrame operators: cleaning, rankings, reports, chart data, coverage."""
