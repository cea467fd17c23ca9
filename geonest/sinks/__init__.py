from geonest.sinks.catalog import read_contract, write_table  # noqa: F401
from geonest.sinks.files import append_partitioned, cluster_by, write_parquet_overwrite  # noqa: F401
