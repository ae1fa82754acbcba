"""Operators for training-data pipelines, each usable on any table with an id and a text."""
