"""groundmill: raster, polygon and tile analytics as plain PySpark DataFrame functions."""
