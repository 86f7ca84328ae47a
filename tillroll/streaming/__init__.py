from tillroll.streaming.ingest import ingest_new_csv_parts, ingest_new_receipts, receipt_stream, staged_csv_receipts

__all__ = ["ingest_new_csv_parts", "ingest_new_receipts", "receipt_stream", "staged_csv_receipts"]
