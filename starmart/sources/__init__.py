from .contracts import CONTRACTS, CUSTOMER_FEED_SCHEMA, Col
from .readers import MissingColumnError, conform, read_seed, read_source, row_counts, source_exists, source_path

__all__ = ["CONTRACTS", "CUSTOMER_FEED_SCHEMA", "Col", "MissingColumnError", "conform", "read_seed",
           "read_source", "row_counts", "source_exists", "source_path"]
