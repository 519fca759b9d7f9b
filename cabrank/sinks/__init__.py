"""Sinks: catalog tables, lake files, physical layouts and row ordinals."""
