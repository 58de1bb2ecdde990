"""Document-processing analytics on Spark: pages, judgments, strips, recognition and text integration."""
