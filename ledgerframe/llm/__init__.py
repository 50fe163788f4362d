"""Training-data operators: deduplication, decontamination, chat formatting,
quality and URL filters, tokenisation, PII detection and sharding.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; ``queries`` holds the registered ``opN_*`` queries over the driver
tables and their SQL.
"""
