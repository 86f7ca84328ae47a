from tillroll.sources.csv_parts import (assemble_receipts, orphan_lines, read_csv_parts, read_receipt_csv_parts,
                                       write_receipt_csv_parts)
from tillroll.sources.receipts import (load_outcome, read_receipt_csv, read_receipt_json, read_receipts,
                                      split_load, write_receipt_headers_csv,
                                      write_receipts_json)
from tillroll.sources.runs import LoadStore, RunStore
from tillroll.sources.staging import (drop_table, materialise, read_table, stage_receipts,
                                      staging_row_count)
from tillroll.sources.testdata import receipts_from_tables

__all__ = [
    "LoadStore", "RunStore", "assemble_receipts", "orphan_lines", "read_csv_parts", "read_receipt_csv_parts",
    "write_receipt_csv_parts",
    "drop_table", "load_outcome", "materialise", "read_receipt_csv", "read_receipt_json", "read_receipts",
    "read_table", "receipts_from_tables", "split_load", "stage_receipts", "staging_row_count", "write_receipt_headers_csv",
    "write_receipts_json",
]
