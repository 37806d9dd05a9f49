"""Writers for tables and marts."""
