"""Sources: raw-file discovery, CSV and Parquet scans, SQL over views."""

from strata.sources.csv import read_declared, read_inferred, read_table, write_csv  # noqa: F401
from strata.sources.files import csv_manifest, lake_tables, list_files  # noqa: F401
from strata.sources.lake import read_sql_jdbc, warehouse_sql  # noqa: F401
from strata.sources.lake import read_table as read_lake_table  # noqa: F401
