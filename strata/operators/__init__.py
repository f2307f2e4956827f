"""DataFrame -> DataFrame operators: quality, derive, enrich, metrics, windows, reports."""
