from starkit.sources.quarantine import Sorted, quarantine, read_by_header
from starkit.sources.readers import CORRUPT, read_csv, read_table, rejected_dates, rejected_rows, rows
from starkit.sources.versions import TableChanged, VersionedTables
from starkit.sources.warehouse import Warehouse

__all__ = ["CORRUPT", "Sorted", "TableChanged", "VersionedTables", "Warehouse", "quarantine", "read_by_header", "read_csv", "read_table", "rejected_dates", "rejected_rows", "rows"]
