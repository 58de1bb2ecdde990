"""Operators over DataFrames: routing, merging, tiling, kernels, recognition, summaries, integration."""
