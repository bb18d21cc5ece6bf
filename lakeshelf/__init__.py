"""lakeshelf: layered-table operators (typed ingest, profiling, imputation,
incremental loads, dimensions, facts, faceted search, stream alerts) written
as Spark DataFrame plans."""

__version__ = "0.1.0"
