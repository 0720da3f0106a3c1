"""Streaming.

The reference has no stream, watermark, window or state handling anywhere, so
nothing is built here.  Every operator in this package is a plain DataFrame
transformation, so the row-local ones (cleaning, scaling with fitted
constants, GNB scoring with a fitted model) apply unchanged to a streaming
DataFrame from ``spark.readStream``; fitting steps need a batch DataFrame.
"""
