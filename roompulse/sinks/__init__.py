"""Writers for files, warehouse layers, upserts and topic routing."""
