"""Reading tables: CSV files, paged sources, unions of pages."""
