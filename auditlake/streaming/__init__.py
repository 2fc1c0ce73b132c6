"""Triggered streaming runs over the same operators."""
