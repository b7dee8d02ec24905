"""The row-wise jobs over files as they land."""
