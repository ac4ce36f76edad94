from rentmill.sinks.csv import export_csv
from rentmill.sinks.layers import query_to_layer, write_layer
from rentmill.sinks.quarantine import rejected_of, store_accepted

__all__ = ["export_csv", "query_to_layer", "rejected_of", "store_accepted", "write_layer"]
