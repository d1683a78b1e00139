from ledgermill.sources.files import CsvSource, ParquetSource, read_csv
from ledgermill.sources.lake import Lake, shared_dir
from ledgermill.sources.mappings import MAPPINGS, Mapping, select_mappings
from ledgermill.sources.relational import JdbcSource, connection_options
from ledgermill.sources.seeds import risk_mcc_codes

__all__ = [
    "MAPPINGS",
    "CsvSource",
    "JdbcSource",
    "Lake",
    "Mapping",
    "ParquetSource",
    "connection_options",
    "read_csv",
    "risk_mcc_codes",
    "select_mappings",
    "shared_dir",
]
