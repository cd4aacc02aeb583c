"""Blocking, pair features, rules, matching, training and evaluation."""
