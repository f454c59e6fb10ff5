"""Annotated-text harmonisation on Spark: messy label files in, one wide table out."""
