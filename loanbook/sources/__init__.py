"""Reading and writing: raw text files, date-partitioned raw tables, result tables."""
