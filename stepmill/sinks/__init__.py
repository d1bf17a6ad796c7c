"""Writing tables: append-style CSV and staged export."""
