"""Job-posting analytics on Spark: text extraction, term reports, page parsing, streaming."""
