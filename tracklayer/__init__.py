"""Latest-record and journey layers over change-data-capture feeds, on Spark DataFrames."""

from tracklayer.layouts import NA, TOMBSTONE, Layout, default_layouts, layout_from_columns

__all__ = ["NA", "TOMBSTONE", "Layout", "default_layouts", "layout_from_columns"]
