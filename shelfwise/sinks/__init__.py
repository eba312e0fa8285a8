"""Writers: replaced tables, pipe-separated files, databases."""
