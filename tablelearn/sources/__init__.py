from tablelearn.sources.tables import read_table, read_csv, read_or_default  # noqa: F401
