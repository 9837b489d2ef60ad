from kiln.sources.files import (literal_table, load_model, map_batches, read_csv, save_model,
                                submission, write_csv)
from kiln.sources.tables import TABLE_NAMES, Tables, table

__all__ = ["TABLE_NAMES", "Tables", "table", "read_csv", "write_csv", "submission",
           "save_model", "load_model", "literal_table", "map_batches"]
