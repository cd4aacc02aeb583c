"""Scalar column functions: normalisation, tokens, sound keys, similarity kernels."""
