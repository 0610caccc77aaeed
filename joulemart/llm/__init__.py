"""Operators that prepare text, vectors and token ids for training language models."""
