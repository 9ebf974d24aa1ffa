"""Whole jobs: histograms, refresh, export, annotation backfill, fleet health, map data."""
