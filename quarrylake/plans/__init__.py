"""Named queries over a directory of Parquet tables, with the SQL that says the same."""
