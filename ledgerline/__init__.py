"""Holdings filings to clean tables, as DataFrame transformations.

Two tables run through the whole package: ``lines(file_id, line_no, line)``, one
row per text line, and ``dictionary(key)``, the accepted security identifiers.
Every operator takes DataFrames and returns a DataFrame.
"""
