from termloom.sinks.manifests import input_digest
from termloom.sinks.tables import drop_folder, shared_folder, write_table, write_tsv

__all__ = ["drop_folder", "input_digest", "shared_folder", "write_table", "write_tsv"]
