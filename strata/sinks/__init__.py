"""Sinks: byte-exact landing, Parquet with observed counts, JDBC."""

from strata.sinks.jdbc import load_layer, write_jdbc  # noqa: F401
from strata.sinks.landing import land_files  # noqa: F401
from strata.sinks.parquet import write_observed, write_table  # noqa: F401
