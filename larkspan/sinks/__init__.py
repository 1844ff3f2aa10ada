"""Writers: keyed tables, text artifacts and archives."""
