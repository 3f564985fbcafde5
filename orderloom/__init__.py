"""Dimensional warehouse for online-shop orders, written as PySpark DataFrame builders.

Layers: dated raw snapshots -> dimensions and cleaned facts -> summaries -> boards.
Every builder takes DataFrames and returns a lazy DataFrame; only the loads in
``orderloom.plans.loads`` write.
"""
