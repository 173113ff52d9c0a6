"""Tile analytics for whole-slide image collections on Spark DataFrames."""
