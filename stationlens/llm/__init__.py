"""Operators that prepare text, page and vector tables for training language models."""
