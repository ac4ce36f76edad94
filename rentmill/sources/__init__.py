from rentmill.sources.csv import read_csv_folder
from rentmill.sources.jdbc import jdbc_source, read_jdbc_table
from rentmill.sources.layers import load_layer, read_layer

__all__ = ["jdbc_source", "load_layer", "read_csv_folder", "read_jdbc_table", "read_layer"]
