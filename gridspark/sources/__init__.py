"""Sources and the views of the generic tables that stand for rasters, features and tiles."""
