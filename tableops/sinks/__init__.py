from tableops.sinks.parquet import list_partitions, read_back, write_parquet

__all__ = ["list_partitions", "read_back", "write_parquet"]
