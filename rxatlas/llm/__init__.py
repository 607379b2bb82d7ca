"""Operators for preparing language-model training data.

Self-contained: nothing outside this folder (but the pipeline script at the
top of the repository) imports it.
"""
