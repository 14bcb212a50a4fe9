"""Operators of a training-data pipeline: counting, packing and storing tokens, exact and near
duplicates, toxicity, quality, main text of pages, secrets and benchmark leaks."""
