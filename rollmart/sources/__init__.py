"""Where rows come from and go to: CSV extracts, Parquet tables, reporting targets."""
